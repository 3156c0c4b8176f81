"""DT-*: date parsing and formatting as pure Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "parse_month_label", "parse_dayfirst", "parse_year_month", "year_month",
    "month_end", "quarter_label", "month_ordinal", "day_ordinal",
    "fiscal_period_end", "fiscal_period_start", "stamp_to_date", "iso_date",
    "month_start", "pivot_two_digit_year", "year_of", "require_dates",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pivot_two_digit_year(d: Column) -> Column:
    """Spark reads ``yy`` into 2000-2099; the C library pivots 69-99 to 19xx."""
    return F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)


def _when_shape(s: Column, shape: str, fmt: str) -> Column:
    # a failed parse costs an exception inside try_to_date; a shape test
    # first keeps the common mismatch cheap (same result either way)
    return F.when(s.rlike(shape), F.try_to_date(s, fmt))


def parse_month_label(c) -> Column:
    """DT-1: '2023 JAN' (any case) -> first day of month; unparsable -> NULL."""
    s = F.initcap(F.trim(_c(c)))
    return _when_shape(s, r"^\d{4} [A-Za-z]{3}$", "yyyy MMM")


# Month names in day-first dates.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_SHORT = "".join(m[:3] for m in MONTHS)
#: DT-2 layouts in one shape: day, month and year with one separator, or year first.
_DAYFIRST = r"^\d{1,2}([/ -])([A-Za-z]{3,9}|\d{1,2})\1(\d{4}|\d{2})$|^\d{4}-\d{1,2}-\d{1,2}$"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_dayfirst(c) -> Column:
    """DT-2: day-first dates in the layouts statistical releases use (one or
    two digit days and months, month names, two or four digit years, ISO
    dates), with a time of day after the date ignored; else NULL.

    One shape test and one split give three parts; the date is put together as
    ISO text and cast once."""
    def date(s: Column, p: Column) -> Column:
        first, second, third = (F.get(p, F.lit(i)) for i in range(3))
        sep = F.substring(s, F.length(first) + 1, F.lit(1))
        iso, short, long_year = F.length(first) == 4, F.length(second) == 3, F.length(third) == 4
        at = F.instr(F.lit(_SHORT), F.initcap(F.substring(second, 1, 3)))
        named = F.when((at % 3 == 1) & (short | (F.initcap(second).isin(MONTHS) & (sep == " ") & long_year)), (at + 2) / 3).cast("int")
        # a slash takes any year, a dash only four digits, a space no number as month
        number = F.when((sep == "/") | ((sep == "-") & long_year), second.try_cast("int"))
        month = F.when(second.rlike("^[0-9]"), number).otherwise(named)
        year = third.try_cast("int") + F.when(long_year, 0).when(third.try_cast("int") >= 69, 1900).otherwise(2000)
        text = F.when(iso, s).otherwise(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), first))
        ok = iso | (month.isNotNull() & (year > 0))
        return F.when(ok, text.try_cast("date"))

    raw = F.trim(_c(c))
    timed = F.regexp_replace(raw, r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?Z?$", "")
    clean = F.regexp_replace(F.when(F.contains(raw, F.lit(":")), timed).otherwise(raw), r"\s+", " ")
    return _let(clean, lambda s: F.when(s.rlike(_DAYFIRST), _let(F.split(s, "[/ -]"), lambda p: date(s, p))))


def parse_year_month(c) -> Column:
    """DT-3: strict 'yyyy-MM'; '2021-13' -> NULL."""
    return _when_shape(_c(c), r"^\d{4}-\d{2}$", "yyyy-MM")


def year_month(c) -> Column:
    """DT-4: 'yyyy-MM' text key (string order = time order)."""
    return F.date_format(_c(c), "yyyy-MM")


def month_start(c) -> Column:
    return F.trunc(F.to_date(_c(c)), "month")


def month_end(c) -> Column:
    """DT-5: last day of the month (midnight)."""
    return F.last_day(_c(c))


def year_of(c) -> Column:
    """DT-6: calendar year."""
    return F.year(_c(c))


def quarter_label(c) -> Column:
    """DT-7: '2025Q1'."""
    d = _c(c)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_ordinal(c) -> Column:
    """DT-8: months since year 0, for gap checks."""
    d = _c(c)
    return F.year(d) * 12 + F.month(d)


def day_ordinal(c) -> Column:
    return F.datediff(F.to_date(_c(c)), F.lit("1970-01-01").cast("date"))


# Fiscal labels: '2017-18', '2017/18', '2017-2018' and '2018' all end in March.
_FISCAL = r"^\s*(\d{4})(?:\s*[-/]\s*(\d{2,4}))?\s*$"


def fiscal_period_end(c, end_month: int = 3) -> Column:
    """DT-9: fiscal label -> 'yyyy-MM' of the period end.

    A two-digit end rolls into the next century when it is below the start's
    last two digits ('1999-00' -> '2000-03').
    """
    s = _c(c)
    start = F.regexp_extract(s, _FISCAL, 1)
    end = F.regexp_extract(s, _FISCAL, 2)
    start_i = start.cast("int")
    two = end.cast("int")
    century = (start_i / 100).cast("int") * 100
    end_two = century + two + F.when(two < start_i % 100, 100).otherwise(0)
    end_year = (F.when(F.length(end) == 4, end.cast("int"))
                .when(F.length(end) == 2, end_two)
                .when(F.length(end) == 0, start_i))
    out = F.concat(end_year.cast("string"), F.lit("-"), F.lpad(F.lit(str(end_month)), 2, "0"))
    return F.when(F.length(start) == 4, out)


def fiscal_period_start(c) -> Column:
    """DT-10: start year of a period label, used as its sort key."""
    return F.regexp_extract(_c(c), r"^\s*(\d{4})", 1).try_cast("int")


def stamp_to_date(c, strict: bool = False, default: Column | None = None) -> Column:
    """DT-11: '_20260414' in a file name -> date; otherwise ``default`` (run date).

    ``strict`` requires the stamp just before the extension.
    """
    pat = r"_(\d{8})(?=\.[^.]+$)" if strict else r"_(\d{8})"
    stamp = F.regexp_extract(_c(c), pat, 1)
    d = F.try_to_date(F.nullif(stamp, F.lit("")), "yyyyMMdd")
    return d if strict else F.coalesce(d, default if default is not None else F.current_date())


def iso_date(c) -> Column:
    """DT-12: published date (date or timestamp text) -> 'yyyy-MM-dd'."""
    s = F.trim(_c(c).cast("string"))
    d = F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")
    return F.date_format(d, "yyyy-MM-dd")


def require_dates(df, col: str, parser=parse_dayfirst, limit: int = 5):
    """DT-2 raising variant: every non-empty value must parse; otherwise a
    ValueError lists up to ``limit`` offending values (one small job)."""
    c = F.col(col)
    bad = df.where(F.coalesce(F.trim(c), F.lit("")) != "").where(parser(c).isNull()).select(col).limit(limit)
    rows = [r[0] for r in bad.collect()]
    if rows:
        raise ValueError(f"unparsable dates in {col}: {rows}")
    return df
