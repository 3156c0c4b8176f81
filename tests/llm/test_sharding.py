"""The external shuffle: whole rows, even shards, gapless slots, the same order again."""

import zlib
from collections import Counter

import numpy as np

from panelkit.llm import sharding


def rows(df):
    return [r.asDict() for r in df.collect()]


def check(got, texts, shards=sharding.SHARDS):
    """got: result rows; texts: (doc_id, text) of the input."""
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)


def test_shards_are_even_and_whole(spark):
    texts = [(i, f"text {i} " * (i % 17)) for i in range(1003)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(sharding.round_trip(df))
    check(got, texts)
    key = lambda r: r["doc_id"]
    again = rows(sharding.round_trip(df.repartition(7)))
    assert sorted(got, key=key) == sorted(again, key=key)  # whatever the order of the input
    other = rows(sharding.round_trip(df, seed=5))
    assert sorted(got, key=key) != sorted(other, key=key)
    place = np.array([r["shard"] for r in sorted(got, key=key)])
    assert abs(np.corrcoef(place, np.arange(len(place)))[0, 1]) < 0.15  # the input's order is gone
    assert all(len(set(place[i:i + 100])) > 18 for i in range(0, 900, 100))


def test_shuffle_reaches_all_orders(spark):
    """All orders of four records, about equally often over the seeds."""
    seen = Counter()
    for seed in range(240):
        h = np.random.default_rng([seed, 0]).permutation(4)
        seen[tuple(h)] += 1
    assert len(seen) == 24 and max(seen.values()) < 30


def test_hot_repeated_row_is_split(spark):
    text = "x" * 4000
    texts = [(7, text)] * 300 + [(i, f"t{i}") for i in range(100, 700)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    small = sharding.scatter(df, 40, bucket_bytes=100_000)
    by = {r["bucket"]: r["n"] for r in small.filter("row.doc_id = 7").groupBy("bucket").count().withColumnRenamed("count", "n").collect()}
    assert len(by) > 30 and max(by.values()) < 25
    whole = sharding.scatter(df, 40)  # it fits in one bucket: not split
    assert whole.filter("row.doc_id = 7").select("bucket").distinct().count() == 1
    check(rows(sharding.round_trip(df)), texts)


def test_place():
    for total in (0, 1, 23, 24, 25, 1000):
        shard, slot = sharding.place(np.arange(total), total, 24)
        n = np.bincount(shard, minlength=24)
        assert n.max() - n.min() <= 1 and sorted(zip(shard, slot)) == list(zip(shard, slot))


def test_odd_rows(odd, empty, spark, tmp_path):
    check(rows(sharding.round_trip(odd)), [(r.doc_id, r.text) for r in odd.collect()])
    assert sharding.round_trip(empty).count() == 0
    path = str(tmp_path / "shards")
    sharding.write(odd, path, shards=3)
    back = sharding.read(spark, path, odd)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, back.select("row.*").collect())) == sorted(map(key, odd.collect()))
