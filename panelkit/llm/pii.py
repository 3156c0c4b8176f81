"""Personal data in texts, in DataFrame functions.

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod-97 for IBANs, part and digit counts for addresses and phones), and words
near a span (or before the list of spans that it continues) move its score. Email, ip, card and phone spans that pass their
check are always reported; IBANs and social security numbers only from
``min_score`` on, so that an unconfirmed number needs context.

Positions are code points, end exclusive. They come from the pieces between the
matches: the start of match i is the length of everything before it.

The expressions find exactly the leftmost non-overlapping matches of the plain
patterns in their comments. Possessive repeats and look-behinds only keep the
scan linear and free of recursion on very long runs of one character class.

Defined results: a null text counts as empty and has no spans; every row gives
one row, whatever its id; repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# IBAN lengths by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """Two letters, two digits and groups of four, of just the length of their
    country, so that a word behind is no part of it; of other countries up to 34."""
    known, tails = [], []
    for n, countries in IBAN_LENGTHS.items():
        known += countries.split()
        fours, rest = divmod(n - 4, 4)
        tail = rf"(?:\x20?[A-Z0-9]{{4}}){{{fours}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else "")
        tails.append(rf"(?:{'|'.join(countries.split())})[0-9]{{2}}{tail}")
    other = rf"(?!{'|'.join(known)})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*tails, other])})(?![A-Za-z0-9])"


# The kinds, in the order of ties, with their patterns.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = KINDS[:4]
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ ; runs of under 14 digits fail the length check anyway
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    # as it stands: no plus sign can follow inside the run
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": iban_pattern(),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this has no match of the kind; spares most texts the scan.
GUARDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9][\\x20-]?[0-9][\\x20-]?[0-9]",
          "phone": "\\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "-[0-9]{2}-"}
CONTEXT = {
    "email": "mail|contact|write|address", "ip": "ip|host|server|addr", "card": "card|visa|credit|payment|cc",
    "phone": "phone|call|tel|mobile|fax|contact", "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|tax",
}
#: Score of a span whose check passed, before its context is looked at.
CONFIRMED = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT_BONUS = 0.1
SSN_BONUS = 0.4
CONTEXT_CHARS = 48
LIST_GAP = 16  # characters between two matches of a list under one label
#: The fewest characters of a match: how many neighbours the context can hold.
LEAST = {"email": 5, "ip": 7, "card": 14, "phone": 4, "iban": 12, "ssn": 11}
BLOCK = 64


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(acc, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces has the remainder 1."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    def add(acc, c):
        a = F.ascii(c)
        return F.when(a < 58, acc * 10 + a - 48).otherwise(acc * 100 + a - 55) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _confirm(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(m, " ", ""))
    if kind == "ssn":
        return ~F.substring(m, 1, 3).isin("000", "666") & (F.substring(m, 1, 1) != "9") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    return F.lit(True)


def _score(kind: str, near: Column) -> Column:
    bonus = SSN_BONUS if kind == "ssn" else CONTEXT_BONUS
    return F.lit(CONFIRMED[kind]) + F.when(near, F.lit(bonus)).otherwise(0.0)


def find(docs: DataFrame, text_col: str = "text", min_score: float = 0.75) -> DataFrame:
    """docs' rows as (row, spans): ``spans`` is an array of structs (start,
    kind_no, kind, end, score), sorted by start and then kind."""
    t = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    t = t.select("row", "t", *[
        F.when(F.col("t").rlike(GUARDS[k]), F.regexp_extract_all("t", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"m_{k}")
        for k in KINDS])
    # gaps around the matches, then what each match adds to the position of the next
    t = t.select("row", *[f"m_{k}" for k in KINDS], *[
        F.when(F.size(f"m_{k}") > 0, F.split("t", PATTERNS[k], -1)).otherwise(none).alias(f"g_{k}") for k in KINDS])
    def steps(k: str) -> Column:
        return F.transform(f"g_{k}", lambda g, i: F.length(g) + F.coalesce(F.length(F.get(f"m_{k}", i - 1)), F.lit(0)))

    def total(array: str, first: Column, last: Column) -> Column:
        """Sum of the elements from first to last, one by one: slice() would
        copy the whole array each time."""
        return F.aggregate(F.sequence(first, last), F.lit(0), lambda a, j: a + F.coalesce(F.get(array, j), F.lit(0)))

    def block_sums(k: str) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(f"w_{k}") / BLOCK).cast("int"))
        return F.transform(blocks, lambda b: total(f"w_{k}", b * BLOCK, b * BLOCK + BLOCK - 1))

    t = t.select("*", *[steps(k).alias(f"w_{k}") for k in KINDS])
    t = t.select("*", *[block_sums(k).alias(f"b_{k}") for k in KINDS])
    t = t.select("*", *[F.transform(f"b_{k}", lambda b, i: F.when(i > 0, total(f"b_{k}", F.lit(0), i - 1)).otherwise(0)).alias(f"o_{k}") for k in KINDS])

    # CONTEXT_CHARS on either side of a match come from the ends of the gaps and the neighbouring matches
    t = t.select("*", *[F.transform(f"g_{k}", lambda g: F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS)).alias(f"e_{k}") for k in KINDS],
                 *[F.transform(f"g_{k}", lambda g: F.substring(g, 1, CONTEXT_CHARS)).alias(f"s_{k}") for k in KINDS])

    def labels(k: str) -> Column:
        """L for each match with a context word, c for others close behind the
        one before them, x for the rest; a label then goes on to all c's."""
        depth, text = CONTEXT_CHARS // LEAST[k], lambda a, j: F.when(j >= 0, F.coalesce(F.get(f"{a}_{k}", j), F.lit(""))).otherwise("")
        def one(m, i):
            before = F.concat(*[x for d in range(depth, 0, -1) for x in (text("e", i - d), text("m", i - d))], text("e", i))
            after = F.concat(text("s", i + 1), *[x for d in range(1, depth + 1) for x in (text("m", i + d), text("s", i + 1 + d))])
            context = F.concat_ws(" ", F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS), F.substring(after, 1, CONTEXT_CHARS))
            near = F.lower(context).rlike(rf"\b(?:{CONTEXT[k]})")
            return F.when(near, "L").when((i > 0) & (F.length(F.get(f"g_{k}", i)) <= LIST_GAP), "c").otherwise("x")
        return F.split(F.regexp_replace(F.array_join(F.transform(f"m_{k}", one), ""), r"(?:(?<=L)|\G(?!^))c", "L"), "")

    t = t.select("*", *[F.when(F.size(f"m_{k}") > 0, labels(k)).otherwise(none).alias(f"l_{k}") for k in KINDS])
    # an array that one lambda looks up would be copied into it by the optimiser and computed
    # anew for every element: projections do not merge across a filter on a row number
    t = t.withColumn("fence", F.monotonically_increasing_id()).filter("fence >= 0")

    def spans(k: str) -> Column:
        def one(m, i):
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(f"o_{k}", block) + total(f"w_{k}", block * BLOCK, i)
            return F.struct(start.alias("start"), F.lit(KINDS.index(k)).alias("kind_no"), F.lit(k).alias("kind"),
                            (start + F.length(m)).alias("end"), F.round(_score(k, F.get(f"l_{k}", i) == "L"), 2).alias("score"),
                            _confirm(k, m).alias("ok"))
        keep = lambda s: s.ok if k in BASE_KINDS else s.ok & (s.score >= min_score)
        return F.filter(F.transform(f"m_{k}", one), keep)

    found = F.sort_array(F.concat(*[spans(k) for k in KINDS]))
    return t.select("row", F.transform(found, lambda s: s.dropFields("ok")).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of each kind, the digest of the base spans, all
    spans and their scores as text."""
    f = find(docs, text_col)
    base = F.filter("spans", lambda s: s.kind_no < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return f.select(F.col(f"row.`{id_col}`").alias("doc_id"), *[count(k) for k in BASE_KINDS],
                    F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                    *[count(k) for k in KINDS if k not in BASE_KINDS],
                    F.array_join(F.transform("spans", lambda s: s.score.cast("string")), ",").alias("scores"))
