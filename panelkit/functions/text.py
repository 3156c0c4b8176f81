"""STR-* / MTH-*: string and arithmetic helpers as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

__all__ = [
    "norm_text", "repair_text", "contains_text", "regex_find", "regex_find_all",
    "title_label", "round_to", "case_label", "MOJIBAKE_FIXES", "safe_div", "has_prefix", "has_suffix",
    "pct_change",
]

# UTF-8 text that was decoded as cp1252, mapped back, longest first.
MOJIBAKE_FIXES = [
    ("â€™", "'"),
    ("â€˜", "'"),
    ("â€œ", '"'),
    ("â€\u009d", '"'),
    ("â€“", "-"),
    ("â€”", "-"),
    ("â€¦", "..."),
    ("Â£", "£"),
    ("Â ", " "),
    ("Ã©", "é"),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c) -> Column:
    """STR-1: trim + lower."""
    return F.lower(F.trim(_c(c)))


def repair_text(c, replacements=MOJIBAKE_FIXES) -> Column:
    """STR-2: ordered literal replacements, then trim; missing -> ''."""
    out = F.coalesce(_c(c), F.lit(""))
    out = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), replacements, out)
    return F.trim(out)


def contains_text(c, s: str) -> Column:
    """STR-3: literal (not regex) containment."""
    return F.contains(_c(c), F.lit(s))


def regex_find(c, pattern: str, group: int = 0) -> Column:
    """STR-4: first match (or capture group); '' when none."""
    return F.regexp_extract(_c(c), pattern, group)


def regex_find_all(c, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(pattern), group)


def title_label(c) -> Column:
    """STR-6: 'random_forest' -> 'Random Forest'."""
    return F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def round_to(c, n: int) -> Column:
    """MTH-1: HALF_UP on the decimal text (documented deviation at exact ties)."""
    return F.round(_c(c), n)


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of raising under ANSI mode."""
    return F.try_divide(_c(a), _c(b))


def case_label(score, hi: float, lo: float, above: str, below: str, middle: str = "neutral",
               inclusive: bool = False) -> Column:
    """MTH-3 / TXT-2 / TXT-3: three-way label of a score.

    ``inclusive=False``: score > hi -> above, score < lo -> below (dead zone);
    ``inclusive=True``: score >= hi -> above, score <= lo -> below.
    """
    s = _c(score)
    up = s >= hi if inclusive else s > hi
    down = s <= lo if inclusive else s < lo
    return F.when(up, above).when(down, below).when(s.isNotNull(), middle)


def has_prefix(c, s: str) -> Column:
    """STR-5."""
    return F.startswith(_c(c), F.lit(s))


def has_suffix(c, s: str) -> Column:
    """STR-5 (file extensions are compared case-insensitively by callers)."""
    return F.endswith(_c(c), F.lit(s))


def pct_change(c, prev) -> Column:
    """MTH-2: (x / previous - 1) x 100, NULL on a zero or missing previous."""
    return (F.try_divide(_c(c), _c(prev)) - 1) * 100
