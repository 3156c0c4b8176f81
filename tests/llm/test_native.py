"""Personal data, exact de-duplication and quality rules against plain Python."""

import collections
import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from panelkit.llm import bloom, exact_dedup, pii, quality_rules


def luhn(digits):
    t = 0
    for i, c in enumerate(reversed(digits)):
        c = int(c) * (2 if i % 2 else 1)
        t += c - 9 if c > 9 else c
    return t % 10 == 0


def plain_pii(x):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{a}:{e}" for a, _, k, e in sorted(out))


def pii_texts():
    rnd = random.Random(5)
    parts = ["a.b@c.de", "x@y", "u%v@w-1.co.uk_z@q.rs", "@", "..@a.b", "10.0.0.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "0300.1.01.2",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "378282246310005", "+49 (30) 123456-78", "+1", "++442071234567",
             "+1 2", "é", "😀", "\n", "ssn 123-45-6789", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765433", "a", "5", " ", "-", "."]
    return ["".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(0, 30))) for _ in range(400)]


def test_pii_matches_plain_patterns(spark):
    texts = pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest(df).collect():
        want = plain_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id]
        own = [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE_KINDS]
        assert ",".join(own) == want and r.n_email == want.count("email:") and r.n_card == want.count("card:")


def test_pii_added_kinds_and_positions(spark):
    texts = ["my ssn is 123-45-6789 ok", "part 123-45-6789 ok", "é pay GB82 WEST 1234 5698 7654 32 now", "pay GB82 WEST 1234 5698 7654 33 now"]
    got = {r.doc_id: r for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].spans == "ssn:10:21" and got[1].spans == ""
    a, b = map(int, got[2].spans.split(":")[1:])
    assert texts[2][a:b] == "GB82 WEST 1234 5698 7654 32" and got[3].n_iban == 0


def test_pii_lists_under_one_label(spark):
    some = [f"{n}-45-6789" for n in range(123, 153)]
    texts = ["SSN: 123-45-6789, 219-09-8888", "SSN\n" + "\n".join(some), "part " + ", ".join(some), ", ".join(some[:3]) + " (ssn)",
             "SSN 123-45-6789 and, as an aside, " + "x" * 60 + " part 219-09-8888"]
    got = {r.doc_id: r.n_ssn for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 2, 1: 30, 2: 0, 3: 3, 4: 1}


def test_pii_many_matches(spark):
    text = "a@b.cd " * 5000  # many blocks of positions
    r = pii.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.n_email == 5000 and r.base_sha256 == hashlib.sha256(plain_pii(text).encode()).hexdigest()


def test_pii_time_is_linear_in_the_matches(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, "a@b.cd " * n + "SSN 123-45-6789, " * n + "BE68 5390 0754 7034 " * n)], "doc_id long, text string")
        start = time.monotonic()
        r = pii.digest(df).first()
        assert r.n_email == r.n_ssn == r.n_iban == n
        return time.monotonic() - start

    fixed = seconds(1)  # planning and compiling
    assert seconds(20_000) < fixed + 30


def test_pii_labels_are_computed_once(spark):
    plan = pii.digest(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    for k, words in pii.CONTEXT.items():
        assert plan.count(f"(?:{words})") == 1, k
    final = plan.split("Filter")[0]  # spans look arrays up that are columns there
    assert "(?:" not in final and "fence" in plan


def test_iban_before_other_words(spark):
    good = ["BE68 5390 0754 7034", "BE68539007547034", "DE89 3704 0044 0532 0130 00", "NO9386011117947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "GB29NWBK60161331926819"]
    tails = [" AND", " X1", ".", " 1234", " BE68", "", "\n", ", IBAN", " A"]
    texts = [f"Pay {g}{t}" for g in good for t in tails] + ["BE68 5390 0754 7034 BE68539007547034", "BE69 5390 0754 7034", "XBE68 5390 0754 7034", "BE68 5390 0754 70345"]
    got = [r.n_iban for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [1] * (len(good) * len(tails)) + [2, 0, 0, 0]


def test_pii_odd_rows(odd, empty):
    got = pii.digest(odd).collect()
    assert len(got) == 12 and all(r.spans == "" for r in got)
    assert pii.digest(empty).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    bits = bloom.filter_bits(5000, 1 << 31)
    maps = bloom.build(keys, F.col("k"), bits)
    hit = bloom.probe(spark.range(20_000).withColumnRenamed("id", "k"), F.col("k"), maps, bits)
    assert hit.filter("k < 5000 and not maybe").count() == 0
    assert hit.filter("k >= 5000 and maybe").count() < 0.05 * 15_000


def test_exact_dedup_with_a_hot_group_and_a_full_filter(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 700}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {}
    for i, t in rows:
        want.setdefault(t, []).append(i)
    for bits in (1 << 31, bloom.BITMAP_BITS):
        got = exact_dedup.decide(df, max_filter_bits=bits).collect()
        assert len(got) == 6000
        for r in got:
            own = want[rows[r.doc_id][1]]
            assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))


def test_exact_dedup_odd_rows(odd, empty):
    got = exact_dedup.decide(odd).collect()
    assert len(got) == 12 and sum(r.kept for r in got) == len({bytes(r.sha) for r in got}) == 9
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == 9
    assert sorted(r.doc_id for r in kept.filter("doc_id < 4").collect()) == [2, 3]
    assert exact_dedup.decide(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def plain_measures(x):
    w = re.findall(r"[^\x20\x09-\x0d]+", x)
    lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0d]", y)]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["a", "b", "é", "😀", " ", " ", "\n", "\t", "#", "\x0b", " "]) for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    texts += ["a b c d e a b c d e", "a a a a a a a a", "x\n\n x\nx\nx \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.measure(df.select("doc_id", "text"), F.col("text")).collect():
        assert tuple(r[m] for m in quality_rules.MEASURES) == plain_measures(texts[r.doc_id])


def test_quality_thresholds_adapt_to_the_group(spark):
    rnd = random.Random(3)

    def text(symbols):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7))) for _ in range(60)]
        return " ".join(w + ("#" if rnd.random() < symbols else "") for w in words)

    rows = [(i, text(0.0), "en", "prose") for i in range(300)] + [(300 + i, text(0.3 * rnd.random()), "en", "code") for i in range(300)]
    rows += [(900, text(0.9), "en", "prose"), (901, text(0.3), "en", "code"), (902, text(0.5), "xx", "rare")]
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[900] and got[901] and sum(got.values()) >= 601


def test_quality_odd_rows(odd, empty):
    got = quality_rules.judge(odd).collect()
    assert len(got) == 12 and all(not r.kept for r in got if r.n_words < 10)
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0
