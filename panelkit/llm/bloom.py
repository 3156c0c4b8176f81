"""Bloom filters as tables of 4 KB bitmaps, built and probed by DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITMAP_BITS = 32768  # bits of one bitmap of bitmap_construct_agg
BITS_PER_KEY = 16
HASHES = 2


def filter_bits(n_keys: int, max_filter_bits: int) -> int:
    """Filter size for n_keys, which is also what bounds the broadcast."""
    bits = BITMAP_BITS
    while bits < BITS_PER_KEY * n_keys and bits < max_filter_bits:
        bits *= 2
    return bits


def positions(key: Column, bits: int) -> list[Column]:
    """The Bloom positions of a key, one per hash seed."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def build(keys: DataFrame, key: Column, bits: int, hits: int = 1) -> DataFrame:
    """(bucket, bitmap) of the positions that were hit at least ``hits`` times."""
    return (keys.select(F.explode(F.array(*positions(key, bits))).alias("p"))
            .groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= hits)
            .groupBy((F.col("p") / BITMAP_BITS).cast("long").alias("bucket"))
            .agg(F.bitmap_construct_agg((F.col("p") % BITMAP_BITS)).alias("bitmap")))


def probe(rows: DataFrame, key: Column, bitmaps: DataFrame, bits: int) -> DataFrame:
    """rows plus ``maybe``: false means that not all of the key's positions are
    in the filter. The broadcast holds at most bits / 8 bytes."""
    out = rows.select("*", *[p.alias(f"_p{i}") for i, p in enumerate(positions(key, bits))])
    hit = F.lit(True)
    for i in range(HASHES):
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"_k{i}"), F.col("bitmap").alias(f"_m{i}")))
        out = out.join(side, (F.col(f"_p{i}") / BITMAP_BITS).cast("long") == F.col(f"_k{i}"), "left")
        low = (F.col(f"_p{i}") % BITMAP_BITS).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"_m{i}"), F.floor(low / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & F.coalesce(F.getbit(byte, low % 8) == 1, F.lit(False))
    return out.select(*rows.columns, hit.alias("maybe"))
