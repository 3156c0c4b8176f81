"""Alignment of the tokens of two tokenizers by sparse products.

A text is encoded by both. A token-byte incidence matrix has one row per token and
a one in the column of each of its bytes; the Gustavson row product A * B^T counts
the bytes that a token of A shares with one of B: the overlap links. Bytes after
which tokens of both end cut the text into groups; the product of the token-group
incidence matrices gives the links inside groups. Overlap links whose ends agree
are the links that ``pair counts`` count over the corpus. The matrices are
compressed sparse rows, built and multiplied here (``CSR``).

Neither tokenizer has a token that goes across a single space or line end that
stands between two other characters, or across the end of a word that one mark
follows (checked when they are loaded), so the matrices are block diagonal over
the chunks between such places. A worker multiplies each distinct chunk once and
lays the blocks together per text; vocabularies for which the check fails have
one chunk per text.

Of a pair that ends together, one token's bytes end with the other's. So the two
vocabularies bound the number of distinct pairs, by all suffixes of their tokens
(about 550 000 here) whatever the corpus: the table of their counts is broadcast.
Counting combines inside map tasks first.

Defined results: null and empty texts, and texts whose bytes one of the encoders
does not give back (as with a marker character in the text), have no tokens and
no links; rows repeat; null ids stay; a table without tokens has no counts; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from panelkit.llm.chunks import batches_of_chars, joined
from panelkit.llm.common import small_batches
from panelkit.llm.token_files import byte_letters
from panelkit.session import cut_lineage

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARKER = "▁"
MOST_CHUNKS = 400_000  # kept by a worker
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
#: Before a single space or line end between two characters that are not white
#: space, and between a letter and a mark that ends a word.
CUT = re.compile(rf"(?<=\S)(?=[ \n]\S)|(?<=[{LETTERS}])(?=[{MARKS}](?:[ \n]|\Z))")
WORD = re.compile(rf" ?[{LETTERS}]+")


# ------------------------------------------------------------- sparse matrices
class CSR:
    """Compressed sparse rows: columns and values of row i are at
    ptr[i]:ptr[i + 1]. Values default to ones."""

    def __init__(self, ptr: np.ndarray, col: np.ndarray, width: int, val: np.ndarray | None = None):
        self.ptr, self.col, self.width = ptr, col, width
        self.val = np.ones(len(col), np.int64) if val is None else val

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transpose(self) -> CSR:
        """By counting: entries ordered by column, rows ascending inside."""
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.col, minlength=self.width))])
        order = np.argsort(self.col, kind="stable")
        return CSR(ptr, self.rows()[order], len(self.ptr) - 1, self.val[order])

    def times(self, b: CSR) -> CSR:
        """Gustavson's product: row i is the sum of the rows of ``b`` that the
        entries of row i choose. All rows are expanded at once; entries of
        one row and column are then added up."""
        many = b.ptr[self.col + 1] - b.ptr[self.col]
        ends = np.cumsum(many)
        at = np.repeat(b.ptr[self.col] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
        key = np.repeat(self.rows(), many) * b.width + b.col[at]
        val = np.repeat(self.val, many) * b.val[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        row, col = np.divmod(key[first], max(b.width, 1))
        ptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.ptr) - 1))])
        return CSR(ptr, col, b.width, np.add.reduceat(val, first) if len(first) else np.zeros(0, np.int64))


def token_bytes(length: np.ndarray) -> CSR:
    """Incidence of tokens that stand one after the other, by byte length."""
    ptr = np.concatenate([[0], np.cumsum(length)])
    return CSR(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def token_groups(end: np.ndarray, cuts: np.ndarray) -> CSR:
    """Incidence of tokens with the groups that end at ``cuts``."""
    return CSR(np.arange(len(end) + 1), np.searchsorted(cuts, end), len(cuts))


# ------------------------------------------------------------------ the encoders
class Surface:
    """Bytes of all ids of a vocabulary one after the other."""

    def __init__(self, entries: list[bytes]):
        self.length = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        ends = np.cumsum(n)
        return self.data[np.repeat(self.start[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


class ByteEncoder:
    """Byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings are plain text
        with open(path) as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        #: the usual split puts a lone space or line end at the head of a token
        self.cuts = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        self.letters = byte_letters()
        code = {c: b for b, c in self.letters.items()}
        named = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        size = max([*spec["model"]["vocab"].values(), *named], default=-1) + 1
        entries = [b""] * size
        for piece, i in spec["model"]["vocab"].items():
            entries[i] = named.get(i) or bytes(code[c] for c in piece)
        self.surface = Surface(entries)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words go to the merge model directly: each is one piece of the split."""
        out: list = [None] * len(chunks)
        other = []
        for i, c in enumerate(chunks):
            if self.cuts and WORD.fullmatch(c):
                out[i] = [t.id for t in self.tok.model.tokenize(c.encode().decode("latin-1").translate(self.letters))]
            else:
                other.append(i)
        for i, e in zip(other, self.tok.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return joined(out)


class PieceEncoder:
    """SentencePiece. Chunks begin with the space that the encoder adds; others
    are encoded after a line end, whose ids are dropped."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        across = re.compile(rf"\n|[^{MARKER}]{MARKER}|[{LETTERS}][{MARKS}]")
        self.lead = self.sp.encode("\n")  # a marker and the line end
        self.cuts = not any(across.search(p) for p in pieces) and self.lead[:1] == [self.sp.piece_to_id(MARKER)]
        byte = re.compile("<0x([0-9A-F]{2})>")
        entries = []
        for i, p in enumerate(pieces):
            m = byte.fullmatch(p) if self.sp.is_byte(i) else None
            entries.append(bytes([int(m[1], 16)]) if m else p.replace(MARKER, " ").encode())
        self.surface = Surface(entries)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.sp.encode([c[1:] if c[0] == " " else c if c[0] == "\n" else "\n" + c for c in chunks], num_threads=1)
        skip = {" ": 0, "\n": 1}
        return joined([i[skip.get(c[0], len(self.lead)):] for c, i in zip(chunks, ids, strict=True)])


# ------------------------------------------------------------------- per worker
class Aligner:
    """Alignments of chunks, kept between the batches of a worker."""

    def __init__(self, a: ByteEncoder, b: PieceEncoder, limit: int = MOST_CHUNKS):
        self.a, self.b, self.limit = a, b, limit
        self.cuts = a.cuts and b.cuts
        self.n_b = len(b.surface.length)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 5), np.int64)  # good, n_a, n_b, n_groups, n_links
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def products(self, chunks: list[str]) -> dict[str, np.ndarray]:
        """Tokens and links of chunks laid one after the other; tokens of
        chunks that do not come back byte for byte are left out."""
        data = [c.encode("utf-8", "surrogatepass") for c in chunks]
        want, flat = np.fromiter(map(len, data), np.int64, len(data)), np.frombuffer(b"".join(data), np.uint8)
        (a, na), (b, nb) = self.a.encode(chunks), self.b.encode(chunks)
        good = same_bytes(self.a.surface, a, na, flat, want) & same_bytes(self.b.surface, b, nb, flat, want)
        a, b = a[np.repeat(good, na)], b[np.repeat(good, nb)]
        na, nb = np.where(good, na, 0), np.where(good, nb, 0)
        la, lb = self.a.surface.length[a], self.b.surface.length[b]
        end_a, end_b = np.cumsum(la), np.cumsum(lb)
        overlap = token_bytes(la).times(token_bytes(lb).transpose())
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        ga, gb = token_groups(end_a, cuts), token_groups(end_b, cuts)
        shared = ga.times(gb.transpose())
        return {"good": good, "a": a, "b": b, "na": na, "nb": nb, "end_a": end_a, "end_b": end_b, "group_a": ga.col, "group_b": gb.col,
                "overlap_a": overlap.rows(), "overlap_b": overlap.col, "overlap_bytes": overlap.val, "shared_a": shared.rows(), "shared_b": shared.col}

    def learn(self, chunks: list[str]) -> None:
        new = set(chunks).difference(self.index)
        if new and len(self.index) + len(new) > self.limit:
            self.clear()
            new = set(chunks)
        if not new:
            return
        new = list(new)
        p = self.products(new)
        chunk_a = np.repeat(np.arange(len(new)), p["na"])
        ends = p["end_a"][p["overlap_a"]] == p["end_b"][p["overlap_b"]]
        la, lb = p["overlap_a"][ends], p["overlap_b"][ends]  # links that end together
        n_links = np.bincount(chunk_a[la], minlength=len(new))
        last = np.concatenate([[-1], p["group_a"][np.cumsum(p["na"]) - 1]]) if len(p["a"]) else np.full(len(new) + 1, -1)
        last = np.maximum.accumulate(np.where(np.concatenate([[0], p["na"]]) > 0, last, -1))
        n_groups = np.diff(last)
        self.groups += group_texts(p, n_groups)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        own = np.stack([p["good"].astype(np.int64), p["na"], p["nb"], n_groups, n_links], axis=1)
        start = len(self.pairs) + np.cumsum(n_links) - n_links
        self.counts = np.concatenate([self.counts, own])
        self.starts = np.concatenate([self.starts, start])
        self.pairs = np.concatenate([self.pairs, p["a"][la].astype(np.int64) * self.n_b + p["b"][lb]])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts per text (n_a, n_b, n_groups, n_links), digests of the groups, and each
        text's distinct pairs: how many there are, the pairs, their counts."""
        per_text = [self.chunks(t) if t else [] for t in texts]
        every = list(chain.from_iterable(per_text))
        self.learn(every)
        at = np.fromiter(map(self.index.__getitem__, every), np.int64, len(every))
        sizes = np.fromiter(map(len, per_text), np.int64, len(per_text))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[at], axis=0)])
        total = np.diff(sums[bounds], axis=0)
        good = (total[:, 0] == sizes) & (sizes > 0)
        total = np.where(good[:, None], total, 0)[:, 1:]
        digests = []
        for i, (first, end) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            text = ";".join([self.groups[k] for k in at[first:end]]) if good[i] else ""
            digests.append(hashlib.sha256(text.encode()).hexdigest() if good[i] else "")
        doc = np.repeat(np.arange(len(texts)), sizes)
        used = good[doc]
        n, start, doc = self.counts[at[used], 4], self.starts[at[used]], doc[used]
        ends = np.cumsum(n)
        pair = self.pairs[np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        most = len(self.a.surface.length) * self.n_b
        key, count = np.unique(np.repeat(doc, n) * most + pair, return_counts=True)
        doc, pair = np.divmod(key, most)
        return total, digests, np.bincount(doc, minlength=len(texts)), pair, count


def same_bytes(surface: Surface, ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Which chunks the ids give back byte for byte."""
    length = np.concatenate([[0], np.cumsum(surface.length[ids])])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    own = length[bounds[1:]] - length[bounds[:-1]]
    fit = own == want
    got, at = surface.join(ids[np.repeat(fit, sizes)]), flat[np.repeat(fit, want)]
    wrong = np.concatenate([[0], np.cumsum(got != at)])
    edges = np.concatenate([[0], np.cumsum(np.where(fit, want, 0))])
    return fit & (wrong[edges[1:]] == wrong[edges[:-1]])


def group_texts(p: dict[str, np.ndarray], n_groups: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each chunk, '' of one without tokens."""
    n = int(n_groups.sum())

    def listed(ids: np.ndarray, group: np.ndarray) -> list[str]:
        values, which = np.unique(ids, return_inverse=True)
        text = np.array(list(map(str, values.tolist())), object)[which].tolist()
        bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n))]).tolist()
        return [text[i] if j == i + 1 else ",".join(text[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    both = [f"{x}|{y}" for x, y in zip(listed(p["a"], p["group_a"]), listed(p["b"], p["group_b"]), strict=True)]
    bounds = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
    return [";".join(both[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(maxsize=1)
def aligner(a_vocabulary: str, b_vocabulary: str) -> Aligner:
    import public_tokenizers

    return Aligner(ByteEncoder(public_tokenizers.path(a_vocabulary)), PieceEncoder(public_tokenizers.path(b_vocabulary)))


# --------------------------------------------------------------------- the plans
def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def align(docs: DataFrame, a_vocabulary: str = A_VOCABULARY, b_vocabulary: str = B_VOCABULARY, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document, written once: rid, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256 and pairs, its distinct (pair, n) of links that end together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_vocabulary, b_vocabulary)
        for batch in batches:
            texts = batch["text"]
            for first, end in batches_of_chars(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 2_000_000):
                total, sha, n, pair, count = own.align(texts[first:end].to_pylist())
                pairs = pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(count, pa.int32())], names=["pair", "n"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["rid"][first:end], batch["doc_id"][first:end], *[pa.array(total[:, i]) for i in range(4)], pa.array(sha, pa.string()),
                     pa.ListArray.from_arrays(offsets, pairs)],
                    names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return cut_lineage(_texts(docs, id_col, text_col).mapInArrow(
        run, "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<pair: long, n: int>>"))


def links(docs: DataFrame, kind: str = "overlap", a_vocabulary: str = A_VOCABULARY, b_vocabulary: str = B_VOCABULARY,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The links themselves, one row each: rid, doc_id, a_at, b_at (token
    numbers in the text), a_id, b_id, bytes (shared; null for kind "group")."""
    schema = "rid long, doc_id long, a_at long, b_at long, a_id long, b_id long, bytes long"
    which = {"overlap": "overlap", "group": "shared"}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_vocabulary, b_vocabulary)
        for batch in batches:
            for rid, doc_id, text in zip(*[batch[c].to_pylist() for c in ("rid", "doc_id", "text")], strict=True):
                p = own.products(own.chunks(text)) if text else {"good": np.array([False])}
                if p["good"].all():
                    a, b = p[f"{which}_a"], p[f"{which}_b"]
                    shared = pa.array(p["overlap_bytes"]) if kind == "overlap" else pa.nulls(len(a), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(a), rid)), pa.array([doc_id] * len(a), pa.int64()), pa.array(a), pa.array(b),
                         pa.array(p["a"][a].astype(np.int64)), pa.array(p["b"][b].astype(np.int64)), shared],
                        names=["rid", "doc_id", "a_at", "b_at", "a_id", "b_id", "bytes"])

    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, total, best): links of each id pair in the corpus, and whether
    no pair with the same id of B has more."""
    c = cut_lineage(aligned.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("total")))
    c = c.withColumn("b_id", F.col("pair") % n_b)
    top = c.groupBy("b_id").agg(F.max("total").alias("most"))
    return cut_lineage(c.join(top, "b_id").select("pair", "total", (F.col("total") == F.col("most")).alias("best")))


def digest(docs: DataFrame, a_vocabulary: str = A_VOCABULARY, b_vocabulary: str = B_VOCABULARY) -> DataFrame:
    """Per document: tokens, groups, links, and their counts in the corpus."""
    facts = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    aligned = align(docs, a_vocabulary, b_vocabulary)
    counts = pair_counts(aligned, len(aligner(a_vocabulary, b_vocabulary).b.surface.length))
    each = aligned.select(*facts, F.explode_outer("pairs").alias("p")).select(*facts, F.col("p.pair").alias("pair"), F.col("p.n").alias("n"))
    scored = each.join(F.broadcast(counts), "pair", "left").groupBy(*facts).agg(  # bounded by the vocabularies
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("total")), F.lit(0)).cast("long").alias("count_sum"))
    return scored.select(*facts[1:6], "n_best", "count_sum", "groups_sha256")
