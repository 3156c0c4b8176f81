"""Language identification with character language models.

One interpolated Kneser-Ney model of character 4-grams per language. Words are
maximal letter runs, lower-cased, padded with a boundary; n-grams stay inside a
word, so a word's log-probabilities do not depend on its neighbours and each
distinct word of a batch is scored once.

A 4-gram packs into 64 bits (16 a character; letters past the basic plane share
one code). The packed value goes through a bijective mix, so the hash arrays have
no collisions; they are sorted and looked up by binary search. A row holds the
log-probability in every language, with languages that lack the gram backed off
when the model is built. A gram that no language has is backed off when scored.

The prediction is the language with the lowest cross-entropy per character. Its
score is a softmax over -T * cross-entropy, T fitted on labelled documents that
were kept out of the counts; ``accepted`` is false below the score that all but
``reject_share`` of the correctly predicted ones reach.

The models are fitted on a bounded sample: about ``per_lang`` labelled documents
of each language, picked by a hash of the id. Everything else covers all rows.

Defined results: null text, or text without a letter, gives ``und`` with score 0;
with no labelled documents every row gives ``und``; equal entropies go to the
smaller language name; a null id counts as the empty id (not held out); rows
repeat as they come; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm.common import small_batches

ORDER = 4
PAD = 32  # the boundary character
OTHER = 0xFFFF
UNIFORM = 1.0 / 65536
WORD = re.compile(r"[^\W\d_]+")
FEW = 8  # labelled documents outside the hold-out
UNKNOWN = "und"


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of the words, one for each letter and one for the closing
    boundary, and the offset where each word's grams begin."""
    pad = " " * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(words) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes > 0xFFFF, OTHER, codes).astype(np.uint64)
    n = len(codes) - (ORDER - 1)
    packed = np.zeros(n, np.uint64)
    for k in range(ORDER):
        packed = (packed << np.uint64(16)) | codes[k:k + n]
    last, before = codes[ORDER - 1:], codes[ORDER - 2:-1]
    packed = packed[(last != PAD) | (before != PAD)]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return packed, np.concatenate([[0], np.cumsum(sizes)[:-1]])


def text_words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Model:
    """Sorted hash arrays of an interpolated Kneser-Ney model for each of
    several languages.

    counts: language -> (packed 4-grams, their counts).
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], temperature: float = 1.0, accept_from: float = 0.0):
        self.langs = sorted(counts)
        self.temperature, self.accept_from = temperature, accept_from
        own = [self._orders(*counts[lang]) for lang in self.langs]
        self.keys, self.logp, self.ctx_keys, self.backoff = {}, {}, {}, {}
        if not own:  # no language: everything is unknown
            return
        for n in range(1, ORDER + 1):
            every = np.unique(np.concatenate([o[n]["gram"] for o in own]))
            ctxs = np.unique(np.concatenate([o[n]["ctx"] for o in own]))
            p, b = np.empty((len(every), len(own))), np.zeros((len(ctxs), len(own)))
            for i, o in enumerate(own):
                b[np.searchsorted(ctxs, o[n]["ctx"]), i] = np.log(o[n]["weight"])
                lower = np.full(len(every), np.log(UNIFORM)) if n == 1 else self._plain[n - 1][1][
                    np.searchsorted(self._plain[n - 1][0], every & np.uint64((1 << 16 * (n - 1)) - 1)), i]
                backed = b[np.searchsorted(ctxs, every >> np.uint64(16)).clip(0, len(ctxs) - 1), i]
                known = np.isin(every >> np.uint64(16), o[n]["ctx"])
                p[:, i] = lower + np.where(known, backed, 0.0)
                at = np.searchsorted(every, o[n]["gram"])
                p[at, i] = np.log(o[n]["own"] + np.exp(p[at, i]))
            if n == 1:
                self._plain = {}
            self._plain[n] = (every, p)
            for keys, values, to_keys, to_values in ((every, p, self.keys, self.logp), (ctxs, b, self.ctx_keys, self.backoff)):
                h = mix(keys)
                order = np.argsort(h)
                to_keys[n], to_values[n] = h[order], values[order].astype(np.float32)
        del self._plain

    @staticmethod
    def _orders(gram: np.ndarray, count: np.ndarray) -> dict:
        """By order: grams, contexts, each gram's own discounted share and each
        context's weight for the next lower order. Below the highest order,
        counts are of distinct left neighbours."""
        out = {}
        for n in range(ORDER, 0, -1):
            ctx, where = np.unique(gram >> np.uint64(16), return_inverse=True)
            total, types = np.bincount(where, count), np.bincount(where)
            ones, twos = np.sum(count == 1), np.sum(count == 2)
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            out[n] = {"gram": gram, "ctx": ctx, "own": np.maximum(count - d, 0) / total[where], "weight": d * types / total}
            if n > 1:
                gram, count = np.unique(gram & np.uint64((1 << 16 * (n - 1)) - 1), return_counts=True)
        return out

    def _lookup(self, keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(packed)
        at = np.searchsorted(keys, h).clip(0, len(keys) - 1)
        return at, keys[at] == h

    def gram_logp(self, packed: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of each gram's last character in each language."""
        at, found = self._lookup(self.keys[n], packed)
        out = self.logp[n][at]
        if not found.all():
            rest = packed[~found]
            ctx_at, ctx_found = self._lookup(self.ctx_keys[n], rest >> np.uint64(16))
            back = np.where(ctx_found[:, None], self.backoff[n][ctx_at], np.float32(0))
            lower = np.float32(np.log(UNIFORM)) if n == 1 else self.gram_logp(rest & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
            out[~found] = back + lower
        return out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: cross-entropy per character in each language, and the
        number of characters scored (0: no letter)."""
        per_text = [text_words(t) for t in texts]
        index: dict[str, int] = {}
        for ws in per_text:
            for w in set(ws):
                index.setdefault(w, len(index))
        out, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        if not index or not self.langs:
            return out, n
        packed, starts = grams(list(index))
        table = np.add.reduceat(self.gram_logp(packed).astype(np.float64), starts, axis=0)
        sizes = np.diff(np.concatenate([starts, [len(packed)]]))
        letters = np.fromiter((any(map(str.isalpha, w)) for w in index), bool, len(index))
        table[~letters], sizes[~letters] = 0, 0
        for i, ws in enumerate(per_text):
            if ws:
                at = np.fromiter(map(index.__getitem__, ws), np.int64, len(ws))
                n[i] = sizes[at].sum()
                out[i] = -table[at].sum(axis=0) / max(n[i], 1)
        return out, n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        ce, n = self.score(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = ce.argmin(axis=1)
        share = np.exp(-self.temperature * (ce - ce.min(axis=1, keepdims=True)))
        conf = np.where(n > 0, 1 / share.sum(axis=1), 0.0)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], conf


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4: 2 is held out, 3 only calibrates
    (and counts into the model too where a language has under FEW documents)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4


def labelled_sample(docs: DataFrame, per_lang: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text, r, few): about per_lang labelled documents of each language,
    all of those with under FEW; few tells these languages."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    d = d.withColumn("r", remainder(F.col("id"))).filter((F.col("r") != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = d.groupBy("lang").count().collect()  # one row per language
    share = F.lit(0.0)
    for s in sizes:
        share = F.when(F.col("lang") == s["lang"], F.lit(min(1.0, max(per_lang, FEW) / s["count"]))).otherwise(share)
    few = F.col("lang").isin([s["lang"] for s in sizes if s["count"] < FEW])
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    return d.filter(draw < share).select("lang", "text", "r", few.alias("few"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
            own = words[lang]
            for w in text_words(text):
                own[w] += 1
        for lang, own in words.items():
            if own:
                packed, starts = grams(list(own))
                times = np.repeat(np.fromiter(own.values(), np.int64, len(own)), np.diff(np.concatenate([starts, [len(packed)]])))
                gram, where = np.unique(packed, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(np.bincount(where, times).astype(np.int64))],
                                                 names=["lang", "gram", "n"])


def fit(docs: DataFrame, per_lang: int = 1500, reject_share: float = 0.01, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Models of the sampled documents; counts are summed by Spark, and what
    reaches the driver is bounded by the sample."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, per_lang, id_col, text_col, lang_col)
    counted = (sample.filter("r != 3 or few").select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    counts = {lang: (g["gram"].to_numpy().view(np.uint64), g["n"].to_numpy()) for lang, g in counted.sort_values("gram").groupby("lang")}
    counts = {lang: (gram[o], n[o]) for lang, (gram, n) in counts.items() for o in [np.argsort(gram)]}
    model = Model(counts) if counts else Model({})
    if model.langs:
        held = sample.filter("r = 3")  # documents that the model has counted only if there are no others
        others = held.filter("not few")
        calibrate(model, (held if others.isEmpty() else others).select("lang", "text"), reject_share)
    return model


def calibrate(model: Model, sample: DataFrame, reject_share: float) -> None:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ce, n = shared.value.score(b["text"].to_pylist())
            keep = n > 0
            yield pa.RecordBatch.from_arrays([b["lang"].filter(pa.array(keep)), pa.array(list(ce[keep]), pa.list_(pa.float64()))], names=["lang", "ce"])

    rows = sample.mapInArrow(entropies, "lang string, ce array<double>").collect()  # bounded by the sample
    rows = [r for r in rows if r["lang"] in model.langs]
    if not rows:
        return
    ce = np.array([r["ce"] for r in rows])
    truth = np.array([model.langs.index(r["lang"]) for r in rows])
    gap = ce - ce.min(axis=1, keepdims=True)
    loss = {}
    for t in np.geomspace(0.25, 256, 41):
        z = -t * gap
        loss[t] = np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth])
    model.temperature = min(loss, key=loss.get)
    conf = 1 / np.exp(-model.temperature * gap).sum(axis=1)
    right = conf[ce.argmin(axis=1) == truth]
    model.accept_from = float(np.quantile(right, reject_share)) if len(right) else 0.0


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, lang_pred, score, accepted."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, conf = shared.value.predict(b["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["id"], b["held_out"], pa.array(lang, pa.string()), pa.array(conf, pa.float64()),
                                              pa.array((conf >= shared.value.accept_from) & (conf > 0))],
                                             names=["id", "held_out", "lang_pred", "score", "accepted"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), (remainder(F.col(f"`{id_col}`")) == 2).alias("held_out"),
                    F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_col)
