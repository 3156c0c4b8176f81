"""SentencePiece encoding and decoding with a unigram Viterbi search.

Pieces and log scores come from a SentencePiece model file. A double-array trie
over the pieces' UTF-8 bytes finds every piece that starts at a position; the
Viterbi search takes the segmentation with the highest score. A character that
no piece covers costs the lowest score less ten and becomes its byte pieces.
Spaces become the marker (U+2581) and a marker goes in front; decoding joins the
pieces, reads byte runs as UTF-8 and turns markers back into spaces.

No piece of the usual models has a marker after another character, so the search
is independent between such places: texts are cut there, and each distinct chunk
of a batch is searched once (checked when the model is loaded; models where it
does not hold are searched text by text).

Defined results: null and empty texts have no ids and decode to an empty text; a
marker character in a text decodes as a space, as the format has it; ids and
further columns are carried; rows repeat as they come.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.llm.chunks import ChunkIds, batches_of_chars
from panelkit.llm.common import small_batches

MARKER = "▁"
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
SEARCH_BLOCK = 8192  # chunks searched together
LONG_CHUNK = 64  # bytes; longer chunks are searched alone


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            x = b[at]
            at += 1
            out |= (x & 0x7F) << shift
            if x < 0x80:
                return out
            shift += 7

    while at < len(b):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, b[at:at + size]
            at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    dummy_prefix: bool = True

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            data = f.read()
        m = cls()
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                m.pieces.append(own.get(1, b"").decode())
                m.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                m.types.append(own.get(3, NORMAL))
            elif number == 3:
                norm = dict(fields(value))
                if norm.get(2) or norm.get(4, 1):
                    raise ValueError("only models without character maps and white space removal are supported")
                m.dummy_prefix = bool(norm.get(3, 1))
        return m


class DoubleArray:
    """Trie in two arrays: the child of state s by byte c is base[s] + c + 1,
    if check[] of that is s. ``value`` is the piece's index, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, v in keys:
            s = 0
            for c in key:
                if c not in children[s]:
                    children[s][c] = len(children)
                    children.append({})
                    ends.append(-1)
                s = children[s][c]
            ends[s] = v
        spans = sum(max(kids) - min(kids) + 1 for kids in children if kids)
        size = 257 + spans + 257
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        top, queue = 257, [(0, 0)]  # the children of a state take the span from their least to their greatest byte
        for node, state in queue:
            kids = children[node]
            if not kids:
                continue
            base = self.base[state] = top - min(kids) - 1
            top += max(kids) - min(kids) + 1
            for c, child in kids.items():
                self.check[base + c + 1], self.value[base + c + 1] = state, ends[child]
                queue.append((child, base + c + 1))


class Encoder:
    def __init__(self, model: PieceModel):
        self.model = model
        searched = [(p.encode(), i) for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t in (NORMAL, USER) and p]
        self.trie = DoubleArray(searched)
        self.bytes = {int(model.pieces[i][3:5], 16): i for i, t in enumerate(model.types) if t == BYTE}
        self.unknown = next((i for i, t in enumerate(model.types) if t == UNKNOWN), 0)
        self.penalty = min((s for s, t in zip(model.scores, model.types, strict=True) if t == NORMAL), default=0.0) - UNKNOWN_PENALTY
        inside = [p.decode() for p, _ in searched]
        self.cuts_at_marker = not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in inside)
        self.cuts_at_newline = not any("\n" in p and len(p) > 1 for p in inside)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.byte_ids = np.array([self.bytes.get(b, self.unknown) for b in range(256)], np.int32)
        t = self.trie
        self.arrays = np.array(t.base), np.array(t.check), np.array(t.value), np.array(model.scores)

    def chunks(self, text: str | None) -> list[str]:
        """Parts whose best segmentations join to that of the whole."""
        if not text:
            return []
        s = (MARKER if self.model.dummy_prefix else "") + text.replace(" ", MARKER)
        if not self.cuts_at_marker:
            return [s]
        rest = r"[^▁\n]+" if self.cuts_at_newline else r"[^▁]+"
        return re.findall(rf"▁*{rest}|▁+|\n", s)

    def search(self, chunk: str) -> list[int]:
        """Ids of the best segmentation. Of equal scores the first found in
        order of the piece's start stays."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        score, size = self.model.scores, len(self.trie.check)
        b = chunk.encode("utf-8", "surrogatepass")
        n = len(b)
        best, back, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here is None:
                continue
            s, j, whole = 0, i, False
            c = b[i]
            char = i + (1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4)
            while j < n:
                t = base[s] + b[j] + 1
                if t >= size or check[t] != s:
                    break
                s = t
                j += 1
                v = value[s]
                if v >= 0:
                    whole = whole or j == char
                    new = here + score[v]
                    if best[j] is None or new > best[j]:
                        best[j], back[j], piece[j] = new, i, v
            if not whole:
                new = here + self.penalty
                if best[char] is None or new > best[char]:
                    best[char], back[char], piece[char] = new, i, -1
        out, at = [], n
        while at > 0:
            i = back[at]
            if piece[at] >= 0:
                out.append(piece[at])
            elif self.bytes:
                out.extend(self.bytes[x] for x in reversed(b[i:at]))
            else:
                out.append(self.unknown)
            at = i
        out.reverse()
        return out

    def search_many(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many chunks one after the other, and how many each has: the
        same search, advanced for all chunks of a block together. Blocks hold
        chunks of similar length; very long chunks are searched one by one."""
        data = [c.encode("utf-8", "surrogatepass") for c in chunks]
        length = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(length, kind="stable")
        many = order[length[order] <= LONG_CHUNK]
        flats, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for first in range(0, len(many), SEARCH_BLOCK):
            block = many[first:first + SEARCH_BLOCK]
            flat, size = self._search_block([data[i] for i in block], length[block])
            flats.append(flat)
            sizes.append(size)
        for i in order[len(many):]:
            flats.append(np.asarray(self.search(chunks[i]), np.int32))
            sizes.append(np.array([len(flats[-1])]))
        flat, size = np.concatenate(flats), np.concatenate(sizes)
        place = np.argsort(order)  # back to the order of the chunks
        start, size = (np.cumsum(size) - size)[place], size[place]
        return flat[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(flat))], size

    def _search_block(self, data: list[bytes], length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base, check, value, score = self.arrays
        n, width = len(data), int(length.max())
        text = np.zeros((n, width), np.uint8)
        text[np.arange(width) < length[:, None]] = np.frombuffer(b"".join(data), np.uint8)
        char = np.ones(256, np.int64)
        char[0xC0:], char[0xE0:], char[0xF0:] = 2, 3, 4
        best = np.full((n, width + 1), -np.inf)
        back, piece = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        best[:, 0] = 0.0

        def offer(rows: np.ndarray, end: np.ndarray | int, new: np.ndarray, begin: int, which: np.ndarray | int) -> None:
            better = new > best[rows, end]
            r, e = rows[better], end[better] if isinstance(end, np.ndarray) else end
            best[r, e], back[r, e] = new[better], begin
            piece[r, e] = which[better] if isinstance(which, np.ndarray) else which

        for i in range(width):
            rows = np.flatnonzero((length > i) & (best[:, i] > -np.inf))
            if not len(rows):
                continue
            here = best[:, i]
            end_of_char = i + char[text[:, i]]
            whole = np.zeros(n, bool)
            at, state = rows, np.zeros(len(rows), np.int64)
            for j in range(i, width):
                on = length[at] > j
                at, state = at[on], state[on]
                t = base[state] + text[at, j] + 1
                on = check[t] == state
                at, state = at[on], t[on]
                if not len(at):
                    break
                v = value[state]
                has = v >= 0
                r, v = at[has], v[has]
                whole[r[end_of_char[r] == j + 1]] = True
                offer(r, j + 1, here[r] + score[v], i, v)
            r = rows[~whole[rows]]
            offer(r, end_of_char[r], here[r] + self.penalty, i, -1)

        found = []  # (chunk, begin, end, piece), from the last piece to the first
        rows, at = np.arange(n), length.copy()
        while len(rows):
            begin = back[rows, at]
            found.append((rows, begin, at, piece[rows, at]))
            on = begin > 0
            rows, at = rows[on], begin[on].astype(np.int64)
        row, begin, end, which = (np.concatenate(x) for x in zip(*found))
        o = np.lexsort((begin, row))
        row, begin, end, which = row[o], begin[o].astype(np.int64), end[o], which[o]
        size = np.where((which < 0) & bool(self.bytes), end - begin, 1)
        ids = np.repeat(np.where(which < 0, self.unknown, which), size).astype(np.int32)
        if self.bytes:
            spot = np.repeat(begin, size) + np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
            byte = np.repeat(which < 0, size)
            ids[byte] = self.byte_ids[text[np.repeat(row, size)[byte], spot[byte]]]
        return ids, np.bincount(row, size, n).astype(np.int64)

    def encode(self, text: str | None) -> list[int]:
        return [i for c in self.chunks(text) for i in self.search(c)]

    @property
    def table(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Surface bytes of all ids one after the other, starts and sizes."""
        if not hasattr(self, "_table"):
            surface = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if t == CONTROL else p.replace(MARKER, " ").encode()
                       for i, (p, t) in enumerate(zip(self.model.pieces, self.model.types, strict=True))]
            sizes = np.array([len(x) for x in surface])
            self._table = np.frombuffer(b"".join(surface), np.uint8), np.cumsum(sizes) - sizes, sizes
        return self._table

    def decode_many(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive id lists."""
        surface, starts, sizes = self.table
        size = sizes[flat]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = surface[np.repeat(starts[flat] - (ends - size), size) + np.arange(total)].tobytes()
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        out = [data[a:z].decode("utf-8", "replace") for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
        return [t[1:] if self.model.dummy_prefix and t[:1] == " " else t for t in out]

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(np.asarray(ids, np.int64), np.array([len(ids)]))[0]


@lru_cache(maxsize=2)
def encoder(path: str | None, vocabulary: str) -> tuple[Encoder, ChunkIds]:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
    e = Encoder(PieceModel.load(path))
    return e, ChunkIds(e.search_many)


def encode_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str = "piece_bpe_32k.model", path: str | None = None) -> DataFrame:
    """(id, n_tokens, n_byte_tokens, round_trip, ids_crc32, ids) per document.
    ``round_trip``: decoding the ids gave the text again (markers as spaces)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, store = encoder(path, vocabulary)
        is_byte = np.isin(np.arange(len(enc.model.pieces)), list(enc.byte_of))
        for b in batches:
            texts = b["text"].to_pylist()
            for first, end in batches_of_chars([len(t or "") for t in texts], 2_000_000):
                part = texts[first:end]
                flat, n = store.ids([enc.chunks(t) for t in part])
                offsets = np.concatenate([[0], np.cumsum(n)])
                back = enc.decode_many(flat, n)
                same = [x == (t or "").replace(MARKER, " ") for x, t in zip(back, part, strict=True)]
                byte_sum = np.concatenate([[0], np.cumsum(is_byte[flat])])
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in np.split(flat, offsets[1:-1])]
                yield pa.RecordBatch.from_arrays(
                    [b["id"][first:end], pa.array(n), pa.array(np.diff(byte_sum[offsets])), pa.array(same), pa.array(crc, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))],
                    names=["id", "n_tokens", "n_byte_tokens", "round_trip", "ids_crc32", "ids"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(run, "id long, n_tokens long, n_byte_tokens long, round_trip boolean, ids_crc32 long, ids array<int>").withColumnRenamed("id", id_col)


def decode_docs(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
                vocabulary: str = "piece_bpe_32k.model", path: str | None = None) -> DataFrame:
    """(id, text) of encoded documents; a null id list gives an empty text."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, _ = encoder(path, vocabulary)
        for b in batches:
            ids = b["ids"]
            n = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(enc.decode_many(ids.flatten().to_numpy(zero_copy_only=False), n), pa.string())], names=["id", "text"])

    d = encoded.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return d.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
