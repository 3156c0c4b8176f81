"""Near-duplicates by a chosen-path set similarity join.

Documents are sets of 5-word shingles, linked from a Jaccard similarity of 0.75.

1. Every document gets its set's size, a signature of SIGNATURE minwise tokens
   and a digest of its words. Documents with equal words are one class.
2. TREES independent trees branch the classes: a node holds those that agree on
   the minwise tokens chosen on its path. A tree starts with a path of ROOT
   tokens. Near copies do not part on further tokens, so a node of more than NODE
   classes is flooded first: about PIVOTS of its classes meet all others, block by
   block. Most of a family then is one candidate cluster; only the classes outside
   the node's largest cluster still have to meet all others. If these are more
   than NODE too, the node branches, into one child by
   a next chosen token and, for a third of the nodes, a second one (4/3 = 1 /
   0.75 children keep a pair at the threshold together with constant chance).
   Classes of nodes that branch get MORE_TREES further trees, which enter one
   level later. Nodes still too large after DEEPER levels, and large nodes in
   which the classes of another one meet again, so that tokens do not part them,
   do not branch: all that is outside their largest cluster meets all others.
3. Small nodes are compared exhaustively on the signatures. A pair whose
   agreement reaches SIFT joins two classes of one candidate cluster; SIFT lies
   4.4 standard deviations under the threshold. A node reports one edge per
   class, not its pairs.
4. Links are confirmed on the full sets. A candidate cluster of one block (at most
   GROUP classes, CLUSTER_SHINGLES in memory, CLUSTER_WORK steps) is compared
   exhaustively; a larger one is flooded in the same way: pivots meet all blocks,
   then all classes outside the largest linked part do. Every pair that the two
   passes leave out is inside one linked part already, so no link is lost.
   Both report one edge per class that is linked, and the components of
   those edges are the result.

A pair at exactly 0.75 agrees on all ROOT tokens of a tree with chance 0.42, so
TREES trees miss it with 2.4e-8 if no node branches. A node that branches keeps it
together to the end with chance 0.53 (one level later: 0.60): if all nodes it meets
in branch, the first TREES trees miss it with 2.9e-4, and with the further ones 2.9e-8
in all. Blocks miss nothing. These figures are for the expected agreement of 96 of
128 tokens; averaged over the agreement of such a pair they are 1.4e-6 without and
1.2e-5 with branching. More similar pairs are missed even less.

Defined results: a null or empty text has an empty set and is its own component;
nulls among ids are larger than any id, so a component's id is its smallest id,
and null only if it has none; the row kept is the one with that id (the earliest
read among equal ids); an empty table gives an empty result; further columns of
any name are carried by ``keep_one`` and ignored by ``decide``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm import bloom
from panelkit.llm.chunks import batches_of_chars
from panelkit.llm.common import hot_cold_join, small_batches
from panelkit.session import cut_lineage

WORDS = 5
PERCENT = 75
SIGNATURE = 128
TREES = 32
MORE_TREES = 38  # for classes of nodes that branch
ROOT = 3
NODE = 1024
DEEPER = 4
PIVOTS = 16  # expected number in a flooded group
LEADS = 512  # classes that meet a block together in the second pass
GROUP = 128  # classes of a block when links are confirmed
SIFT = 0.58
CLUSTER_SHINGLES = 4_000_000
CLUSTER_WORK = 4_000_000_000  # classes times shingles
MAX_WORD_CACHE = 300_000


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32))


def text_words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased: bytes split at just the white
    space that separates words, and lower-case only these letters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes:
    """64-bit hashes of words, kept for a bounded number of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > MAX_WORD_CACHE:
            self.known.clear()
            new = set(words)
        self.known.update(zip(new, map(xxhash.xxh3_64_intdigest, new)))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


_hashes = WordHashes()


def shingles(per_text: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts one after the other (repeats included), and
    how many each text has. Fewer than WORDS words are one shingle."""
    sizes = np.fromiter(map(len, per_text), np.int64, len(per_text))
    h = _hashes([w for one in per_text for w in one])
    k = constants(WORDS, 5) | np.uint64(1)
    whole = np.zeros(max(len(h) - WORDS + 1, 0), np.uint64)
    for i in range(WORDS):
        whole += h[i:i + len(whole)] * k[i]
    ends = np.cumsum(sizes)
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, (sizes > 0).astype(np.int64))
    at = np.repeat(ends - sizes - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    short = np.repeat((sizes > 0) & (sizes < WORDS), counts)
    out = np.zeros(len(at), np.uint64)
    out[~short] = mix64(whole[at[~short]])
    for j in np.flatnonzero(short):
        doc = per_text[int(np.searchsorted(np.cumsum(counts), j, side="right"))]
        out[j] = xxhash.xxh3_64_intdigest(b"\x00" + b" ".join(doc))  # no word begins like this
    return out, counts


def signatures(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SIGNATURE minwise tokens (16 bits) for each run of hashes."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    a, b = (constants(SIGNATURE, s).astype(np.uint32) | np.uint32(1) for s in (7, 8))
    out = np.empty((len(starts), SIGNATURE), np.uint16)
    y = np.empty_like(x)
    for i in range(SIGNATURE):
        np.multiply(x, a[i], out=y)
        y ^= y >> np.uint32(15)
        y *= b[i]
        out[:, i] = np.minimum.reduceat(y, starts).astype(np.uint16)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the words, set size and signature of every text."""
    for b in batches:
        texts = b["text"].to_pylist()
        for first, end in batches_of_chars([len(t or "") for t in texts], 1_500_000):
            per_text = [text_words(t) for t in texts[first:end]]
            h, counts = shingles(per_text)
            starts = np.cumsum(counts) - counts
            size = [len(np.unique(h[s:s + n])) for s, n in zip(starts, counts)]
            some = counts > 0
            sig: list[bytes | None] = [None] * len(counts)
            if some.any():
                for i, row in zip(np.flatnonzero(some), signatures(h, starts[some])):
                    sig[i] = row.tobytes()
            key = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in per_text]
            yield pa.RecordBatch.from_arrays(
                [*[b[c][first:end] for c in ("rid", "doc_id", "ukey")], pa.array(key), pa.array(size, pa.int64()), pa.array(sig, pa.binary())],
                names=["rid", "doc_id", "ukey", "key", "n", "sig"])


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    i, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    d = docs.select(F.monotonically_increasing_id().alias("rid"), i.alias("doc_id"), row_key(i, t).alias("ukey"), t.alias("text"))
    return cut_lineage(d.mapInArrow(_describe, "rid long, doc_id long, ukey long, key binary, n long, sig binary"))


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


# ---------------------------------------------------------------- the trees
def tree_paths() -> np.ndarray:
    """The ROOT chosen coordinates of every tree."""
    rng = np.random.default_rng(20)
    return np.stack([rng.choice(SIGNATURE, ROOT, replace=False) for _ in range(TREES + MORE_TREES)])


def roots(reps: DataFrame, trees: range) -> DataFrame:
    """(node, rep): the first node of every class in each of the trees."""
    paths, number = tree_paths()[trees.start:trees.stop], np.array(trees, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint16).reshape(-1, SIGNATURE).astype(np.uint64)
            node = np.broadcast_to(number, (len(sig), len(number))).copy()
            for k in range(ROOT):
                node = (node << np.uint64(16)) | sig[:, paths[:, k]]
            rep = np.repeat(b["rep"].to_numpy(), len(number))
            yield pa.RecordBatch.from_arrays([pa.array(mix64(node.ravel()).view(np.int64)), pa.array(rep)], names=["node", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "node long, rep long")


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One or two children of each (node, class): the node chooses a
    coordinate, the class's token there chooses the child."""
    for b in batches:
        sig = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint16).reshape(-1, SIGNATURE).astype(np.uint64)
        node, rep = b["node"].to_numpy().view(np.uint64), b["rep"].to_numpy()
        for child in range(2):
            draw = mix64(node ^ constants(1, 40 + child)[0])
            on = np.ones(len(node), bool) if child == 0 else (draw >> np.uint64(32)) % np.uint64(3) == 0
            coord = (draw % np.uint64(SIGNATURE)).astype(np.int64)
            value = sig[np.arange(len(node)), coord]
            down = mix64(draw + (value << np.uint64(1)) + np.uint64(child))[on]
            yield pa.RecordBatch.from_arrays([pa.array(down.view(np.int64)), pa.array(rep[on])], names=["node", "rep"])


def counted(members: DataFrame) -> DataFrame:
    """Nodes of two or more classes, with their size. Of nodes that hold the same
    classes one is left, with ``again`` their number: enough if it is compared
    exhaustively, so it must not branch."""
    c = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rep")).alias("x"),
                                    F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("size > 1")
    return cut_lineage(c.groupBy("size", "x", "lo", "hi").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("again"))
                       .select("node", "size", "again"))


def leaves(reps: DataFrame, settle: Callable[[DataFrame, Column], DataFrame] | None = None) -> DataFrame:
    """(node, rep): nodes small enough to be compared exhaustively. ``settle``
    gets the large nodes and which of them must not branch, and returns
    those that have to; without it the former are cut into pairs of blocks."""
    members = roots(reps, range(TREES))
    out = []
    for level in range(DEEPER + 1):
        sizes = counted(members)
        out.append(members.join(sizes.filter(F.col("size") <= NODE), "node").select("node", "rep"))
        large = sizes.filter(F.col("size") > NODE)
        if large.isEmpty():
            break
        inside = cut_lineage(members.join(large, "node").select("node", "rep", "size", "again"))
        whole = (F.col("again") > 1) | F.lit(level == DEEPER)
        if settle:
            branch = settle(inside, whole)
            if branch.isEmpty():
                break
        else:
            out.append(blocks(inside.filter(whole)))
            branch = inside.filter(~whole)
        members = branch.join(reps.select("rep", "sig"), "rep").select("node", "rep", "sig").mapInArrow(_children, "node long, rep long")
        if level == 0:
            crowded = reps.join(branch.select("rep").distinct(), "rep", "left_semi")
            members = members.unionByName(roots(crowded, range(TREES, TREES + MORE_TREES)))
        members = cut_lineage(members)
    return _all(out)


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return cut_lineage(whole)


def blocks(members: DataFrame) -> DataFrame:
    """Every pair of blocks of a large node as a node of its own."""
    n = F.ceil(F.col("size") / (NODE // 2)).cast("int")
    own = members.select("node", "rep", n.alias("n"), F.pmod(F.xxhash64("rep", "node"), n.cast("long")).cast("int").alias("b"))
    pairs = own.select("node", "rep", "b", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    return pairs.select(F.xxhash64("node", F.least("b", "o"), F.greatest("b", "o")).alias("node"), "rep")


# ---------------------------------------------------- comparing inside groups
def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        k = b[key].to_numpy()
        cut = int(np.searchsorted(k, k[-1]))  # where the last, perhaps unfinished group begins
        if cut or k[-1] != held[0][key][-1].as_py():
            head = [*held[:-1], b.slice(0, cut)]
            yield pa.Table.from_batches(head)
            held = [b.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def clusters(n: int, linked: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Label (the smallest index) of each of n items, given a function that
    tells which of some items are linked with any of a few others. Items that
    have been reached leave the comparison."""
    label, left = np.arange(n), np.arange(n)
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            few, front = front[:16], front[16:]
            hit = linked(few, left)
            label[left[hit]] = root
            front, left = np.concatenate([front, left[hit]]), left[~hit]
    return label


def edges_of(rep: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = label != np.arange(len(label))
    return rep[other], rep[label[other]]


def _edge_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([cat(a), cat(b)], names=["a", "b"])


Hits = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _signature_hits(t: pa.Table) -> Hits:
    """Candidates by agreement of 8-bit tokens and sizes: a matrix (few, left)."""
    most = int(np.ceil(SIFT * SIGNATURE))
    z, s = t["n"].to_numpy(), np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)

    def hits(few: np.ndarray, left: np.ndarray) -> np.ndarray:
        same = np.count_nonzero(s[few][:, None, :] == s[left][None, :, :], axis=2)
        lo, hi = np.minimum(z[few][:, None], z[left][None]), np.maximum(z[few][:, None], z[left][None])
        return (same >= most) & (100 * lo >= PERCENT * hi)

    return hits


def _set_hits(t: pa.Table) -> Hits:
    """Links on full sets."""
    own = [np.frombuffer(x, np.uint64) for x in t["set"].to_pylist()]
    sizes = np.array([len(x) for x in own])
    values, flat = np.unique(np.concatenate(own), return_inverse=True)
    starts = np.cumsum(sizes) - sizes

    def hits(few: np.ndarray, left: np.ndarray) -> np.ndarray:
        begin, n = starts[left], sizes[left]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ids, heads = flat[at], np.cumsum(n) - n
        out = np.zeros((len(few), len(left)), bool)
        for j, i in enumerate(few):
            mark = np.zeros(len(values), np.int32)
            mark[flat[starts[i]:starts[i] + sizes[i]]] = 1
            both = np.add.reduceat(mark[ids], heads)
            out[j] = 100 * both >= PERCENT * (sizes[i] + n - both)
        return out

    return hits


def met(lead: np.ndarray, hits: Hits) -> np.ndarray:
    """Label of each item when only the leads are compared, with all items."""
    label, every = np.arange(len(lead)), np.arange(len(lead))
    leads = np.flatnonzero(lead)
    for few in np.array_split(leads, -(-len(leads) // 16)) if len(leads) else []:
        for i, hit in zip(few, hits(few, every)):
            hit[i] = True
            found = np.unique(label[hit])
            to = every.copy()
            to[found] = found[0]
            label = to[label]
    return label


def _edges(batches: Iterator[pa.RecordBatch], hits_of: Callable[[pa.Table], Hits]) -> Iterator[pa.RecordBatch]:
    """Edges inside each node: all items against each other, or, where the rows
    say who leads, the leads against all."""
    for t in grouped(batches, "node"):
        node, rep = t["node"].to_numpy(), t["rep"].to_numpy()
        cuts = np.flatnonzero(np.diff(node)) + 1
        a, b = [], []
        for first, end in zip([0, *cuts], [*cuts, len(node)]):
            own = t.slice(first, end - first)
            hits = hits_of(own)
            label = (met(own["lead"].to_numpy(zero_copy_only=False), hits) if "lead" in t.column_names
                     else clusters(end - first, lambda few, left: hits(few, left).any(axis=0)))  # noqa: B023
            x, y = edges_of(rep[first:end], label)
            a.append(x)
            b.append(y)
        yield _edge_batch(a, b)


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _edges(batches, _signature_hits)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _edges(batches, _set_hits)


def by_node(rows: DataFrame, fn: Callable) -> DataFrame:
    """Distinct edges that ``fn`` finds inside the nodes."""
    small_batches(rows.sparkSession)
    return cut_lineage(rows.repartition("node").sortWithinPartitions("node").mapInArrow(fn, "a long, b long").distinct())


def flood(members: DataFrame) -> DataFrame:
    """First pass over large groups (node, rep, size, blocks): (node, rep, lead)
    rows in which the pivots, drawn by a hash, meet each block of their group."""
    own = F.pmod(F.xxhash64("rep", "node"), F.col("blocks")).cast("int")
    lead = F.pmod(F.xxhash64("node", "rep", F.lit(7)), F.col("size")) < PIVOTS
    parts = F.when(lead, F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).otherwise(F.array(own))
    m = members.select("node", "rep", lead.alias("lead"), F.explode(parts).alias("b"))
    return m.select(F.xxhash64("node", "b").alias("node"), "rep", "lead")


def outside(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Classes that the edges do not join to their group's largest part: the
    group's columns, rep and n_out, the number of them in the group."""
    label = components(edges).withColumnRenamed("v", "rep")
    m = cut_lineage(members.join(label, "rep", "left").withColumn("root", F.coalesce("root", "rep")))
    parts = m.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n"))
    top = cut_lineage(parts.groupBy("node").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("rows")))
    n = m.count()
    rest = cut_lineage(hot_cold_join(m, top, ["node"], "rows", n).filter(F.col("root") != F.col("top.root")).select(*members.columns))
    many = cut_lineage(rest.groupBy("node").agg(F.count(F.lit(1)).alias("n_out")))
    return cut_lineage(hot_cold_join(rest, many, ["node"], "n_out", n))


def second(members: DataFrame, rest: DataFrame) -> DataFrame:
    """Second pass: the rest (members with n_out) leads against all blocks of its
    group, in portions of LEADS."""
    many = cut_lineage(rest.groupBy("node").agg(F.max("n_out").alias("n_out"), F.max("size").alias("size")))
    every = hot_cold_join(members.drop("size"), many, ["node"], "size", members.count())
    own = F.pmod(F.xxhash64("rep", "node"), F.col("blocks")).cast("int")
    n = F.ceil(F.col("n_out") / LEADS).cast("int")
    met_by = every.select("node", "rep", own.alias("b"), F.explode(F.sequence(F.lit(0), n - 1)).alias("r"), F.lit(False).alias("lead"))
    portion = F.pmod(F.xxhash64("rep"), n.cast("long")).cast("int")
    leads = rest.select("node", "rep", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("b"), portion.alias("r"), F.lit(True).alias("lead"))
    return met_by.unionByName(leads).select(F.xxhash64("node", "b", "r").alias("node"), "rep", "lead")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of the vertices of the edges; the root is the component's
    smallest vertex. Roots hook to their smallest neighbour and paths are
    halved until no edge joins two roots."""
    label = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct().withColumn("root", F.col("v"))
    rest = edges
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        up = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("r"), "p"))
        while True:
            over = up.select(F.col("r").alias("p"), F.col("p").alias("q"))
            jumped = cut_lineage(up.join(over, "p").select("r", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")))
            up = jumped.select("r", "p")
            if jumped.filter("moved").isEmpty():
                break
        label = cut_lineage(label.join(up.select(F.col("r").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root")))
        a, b = (up.select(F.col("r").alias(c), F.col("p").alias(f"p{c}")) for c in ("a", "b"))
        rest = cut_lineage(rest.join(a, "a").join(b, "b").filter("pa <> pb")
                           .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    return label


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b["text"].to_pylist()
        for first, end in batches_of_chars([len(t or "") for t in texts], 1_500_000):
            h, counts = shingles([text_words(t) for t in texts[first:end]])
            ends = np.cumsum(counts)
            sets = [np.unique(h[e - n:e]).tobytes() for e, n in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([b["ukey"][first:end], pa.array(sets, pa.binary())], names=["ukey", "set"])


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, max_filter_bits: int) -> DataFrame:
    """(rep, set) of the wanted (rep, ukey): texts are read again, and those
    outside a Bloom filter of the wanted rows are not even split."""
    bits = bloom.filter_bits(wanted.count(), max_filter_bits)
    maps = cut_lineage(bloom.build(wanted, F.col("ukey"), bits))
    d = docs.select(row_key(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).alias("ukey"), F.col(f"`{text_col}`").alias("text"))
    d = bloom.probe(d, F.col("ukey"), maps, bits).filter("maybe").select("ukey", "text")
    s = d.mapInArrow(_sets, "ukey long, set binary").groupBy("ukey").agg(F.max("set").alias("set"))  # repeated rows
    return cut_lineage(s.join(wanted, "ukey").select("rep", "set"))


def candidates(reps: DataFrame) -> DataFrame:
    """(v, root) of the candidate clusters."""
    tokens = cut_lineage(reps.select("rep", "n", "sig").mapInArrow(_low_bytes, "rep long, n long, sig binary"))
    edges: list[DataFrame] = []

    def settle(inside: DataFrame, whole: Column) -> DataFrame:
        m = cut_lineage(inside.select("*", whole.alias("whole"), F.ceil(F.col("size") / NODE).alias("blocks")))
        first = by_node(flood(m).join(tokens, "rep"), _sift)
        rest = outside(m, first)
        ends = F.col("whole") | (F.col("n_out") <= NODE)
        edges.extend([first, by_node(second(m, rest.filter(ends)).join(tokens, "rep"), _sift)])
        parted = cut_lineage(rest.filter(~ends).select("node").distinct())
        return cut_lineage(inside.join(parted, "node", "left_semi"))

    nodes = leaves(reps, settle)
    return components(_all([by_node(nodes.join(tokens, "rep"), _sift), *edges]).distinct())


def linked_classes(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, max_filter_bits: int) -> DataFrame:
    """(v, root) of all classes that are linked with another one."""
    candidate = cut_lineage(candidates(reps).withColumnRenamed("v", "rep").join(reps.select("rep", "ukey", "n"), "rep"))
    sizes = cut_lineage(candidate.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")))
    candidate = cut_lineage(hot_cold_join(candidate, sizes, ["root"], "size", candidate.count()))
    sets = full_sets(docs, candidate.select("rep", "ukey"), id_col, text_col, max_filter_bits)
    size, total = F.col("size"), F.col("total")
    blocks = F.least(size, F.greatest(F.ceil(size / GROUP), F.ceil(total / CLUSTER_SHINGLES), F.ceil(size * total / CLUSTER_WORK)))
    cut = candidate.select(F.col("root").alias("node"), "rep", "size", blocks.alias("blocks"))
    edges = [by_node(cut.filter("blocks = 1").select("node", "rep").join(sets, "rep"), _confirm)]
    large = cut_lineage(cut.filter("blocks > 1"))
    if not large.isEmpty():
        first = by_node(flood(large).join(sets, "rep"), _confirm)
        edges += [first, by_node(second(large, outside(large, first)).join(sets, "rep"), _confirm)]
    return components(_all(edges).distinct())


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig = [np.frombuffer(x, np.uint16).astype(np.uint8).tobytes() for x in b["sig"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["rep"], b["n"], pa.array(sig, pa.binary())], names=["rep", "n", "sig"])


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = 1 << 31) -> DataFrame:
    """Per document: rid, doc_id, ukey, n_shingles, component_id, kept."""
    base = described(docs, id_col, text_col)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    classes = cut_lineage(base.filter("n > 0").groupBy("key").agg(F.min("rid").alias("rep"), best.alias("best"), F.count(F.lit(1)).alias("docs")))
    reps = cut_lineage(base.join(classes.select(F.col("rep").alias("rid")), "rid").select(F.col("rid").alias("rep"), "ukey", "n", "sig"))
    roots = linked_classes(docs, reps, id_col, text_col, max_filter_bits).withColumnRenamed("v", "rep")
    alone = classes.join(roots, "rep", "left_anti").select("key", "docs", F.col("best").alias("first"))
    inside = cut_lineage(classes.join(roots, "rep").select("key", "docs", "best", "root"))
    tops = cut_lineage(inside.groupBy("root").agg(F.min("best").alias("first"), F.count(F.lit(1)).alias("n_classes")))
    joined = hot_cold_join(inside, tops, ["root"], "n_classes", inside.count()).select("key", "docs", "first")
    info = cut_lineage(alone.unionByName(joined).select("key", "docs", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("keep_rid")))
    full = base.filter("n > 0").select("rid", "doc_id", "ukey", "key", "n")
    out = hot_cold_join(full, info, ["key"], "docs", base.count()).select(
        "rid", "doc_id", "ukey", F.col("n").alias("n_shingles"), "component_id", (F.col("rid") == F.col("keep_rid")).alias("kept"))
    empty = base.filter("n = 0").select("rid", "doc_id", "ukey", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(empty)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = 1 << 31) -> DataFrame:
    """docs with one document of each component, all columns kept. Only rows
    that a Bloom filter takes for surplus ones shuffle; the others stay."""
    d = cut_lineage(decide(docs, id_col, text_col, max_filter_bits).select("ukey", "kept"))
    gone = d.filter(~F.col("kept"))
    bits = bloom.filter_bits(gone.count(), max_filter_bits)
    maps = cut_lineage(bloom.build(gone, F.col("ukey"), bits))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("ukey", row_key(F.col(f"row.`{id_col}`").cast("long"), F.col(f"row.`{text_col}`")))
    probed = bloom.probe(rows, F.col("ukey"), maps, bits)
    maybe = probed.filter("maybe").groupBy("ukey").agg(F.max_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    back = maybe.join(d.filter("kept").select("ukey").distinct(), "ukey", "left_semi")
    return probed.filter(~F.col("maybe")).select("row.*").unionByName(back.select("row.*"))
