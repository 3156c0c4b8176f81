"""Repair of the structure of conversations by a suffix-shared automaton.

Each conversation becomes a signature, one letter per row: what its role is
and whether the row may stay, costs when it stays, or must go. The cheapest edits
(keep, rerole, delete, insert) that make the roles follow ``s?(ua)+`` depend only on
what is still to come and on the state of the grammar. Signatures are therefore
minimised from the end: two places of any two conversations with the same rest
are one node of the automaton, and a node has the costs and the best next edits of
the four grammar states, computed once.

The distinct suffixes are met in order by sorting the signatures read
backwards: shared ends are neighbours, and a task keeps just the path of the last
signature. Range partitions on (reversed signature, conversation) split a signature
that many conversations have; a signature met again costs nothing.

Edits at a place are inserts and then one of delete, keep, rerole. These pieces are
prefix-free, and the state and the piece fix the next state, so the ASCII-least of the
cheapest audits has the ASCII-least piece at every place: nodes store a piece
and a next state instead of whole audits.

Order: rows of a conversation by turn, nulls first, then role, text digest and copy.
A conversation's audit is one string and its digest one hash over its rows in
order, so one task reads its rows; they stream through it, sorted (on disk if need be),
and only one letter per row is held. Texts move once, for the digest.

Defined results: nulls in role and text count as one space; a null id is a
conversation of its own; repeated rows are rows; a conversation whose rows are all gone
has zeros, an empty audit and the hash of an empty text; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.llm.common import SPACE, small_batches
from panelkit.session import cut_lineage

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Letters of a signature: role initials, in capitals where the row is truncated,
#: o for another role; x for a row that must go.
GONE = "x"
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (BEGIN, ASSISTANT)
#: The next state after a role, by state. Reroled and inserted rows take the one
#: of user and assistant that the state allows.
NEXT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
OWED = {BEGIN: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}


# ------------------------------------------------------------ damage and faults
def id_type_of(rows: DataFrame) -> str:
    return "string" if rows.schema["conv_id"].dataType.typeName() == "string" else "long"


def conv_id(conversations: DataFrame) -> Column:
    return F.col("conv_id").cast(id_type_of(conversations))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, copy, role, text, live: rows after seeded damage. Rows that
    are dropped stay with live = false, so that no conversation is lost."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select(conv_id(conversations), F.col("turn").cast("long"), show("role").alias("role"), show("text").alias("text"),
                             (F.crc32(F.concat(show("conv_id"), F.lit(":"), show("turn")).cast("binary")) % 20).alias("hit"))
    text = (F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select("conv_id", "turn", F.explode(copies).alias("copy"), F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("hit") != 0).alias("live"))


def as_is(conversations: DataFrame) -> DataFrame:
    """The rows of a table in the same form, undamaged."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(conv_id(conversations), F.col("turn").cast("long"), F.lit(0).alias("copy"), show("role").alias("role"), show("text").alias("text"), F.lit(True).alias("live"))


def text_digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


ORDER = ["turn", "role", "d", "copy"]  # ascending, nulls first


def faulted(rows: DataFrame) -> DataFrame:
    """Rows without their texts: conv_id, turn, role, d, copy, live, blank,
    truncated, duplicate (role and text seen earlier). Both windows and the sort
    that follows work inside one partitioning by conversation."""
    last = F.regexp_extract("text", f"([^{SPACE}])[{SPACE}]*\\z", 1)
    r = rows.select("conv_id", "turn", "role", text_digest().alias("d"), "copy", "live",
                    (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    r = r.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "d", "live").orderBy(*ORDER)
    return r.withColumn("duplicate", F.row_number().over(seen) > 1)


# ------------------------------------------------------------- per conversation
FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def facts(rows: DataFrame, id_type: str = "long") -> DataFrame:
    """Per conversation: counts of faults and its signature, from rows that
    stream in order of the conversations."""
    cols = ["conv_id", "turn", "role", "live", "blank", "duplicate", "truncated"]
    sorted_rows = rows.sortWithinPartitions("conv_id", *ORDER).select(*cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Facts | None = None
        done: list[tuple] = []
        for b in batches:
            for conv, turn, role, live, blank, dup, trunc in zip(*[b[c].to_pylist() for c in cols]):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Facts(conv)
                if live:
                    now.add(turn, role, blank, dup, trunc)
            if len(done) >= 4096:
                yield _batch(done, FACTS, id_type)
                done = []
        if now is not None:
            done.append(now.row())
        yield _batch(done, FACTS, id_type)

    return sorted_rows.mapInArrow(run, _typed(FACTS, id_type))


def _typed(schema: str, id_type: str) -> str:
    return schema.replace("conv_id long", f"conv_id {id_type}")


def _batch(rows: list[tuple], schema: str, id_type: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.strip().split() for f in _typed(schema, id_type).split(",")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


class _Facts:
    """Running counts of one conversation."""

    def __init__(self, conv):
        self.conv, self.least, self.most, self.turns, self.before, self.role = conv, None, None, 0, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.letters = bytearray()  # one byte per row

    def add(self, turn, role: str, blank: bool, dup: bool, trunc: bool) -> None:
        if turn is not None:
            self.turns += turn != self.before  # turns come in order
            self.least = turn if self.least is None else self.least
            self.most = self.before = turn
        initial = role[:1]
        if self.role is not None:
            self.illegal += (self.role, initial) not in LEGAL
        self.role = initial
        if blank or dup:
            self.blank += blank
            self.duplicate += not blank
            self.letters += GONE.encode()
        else:
            self.truncated += trunc
            letter = initial if initial in ("s", "u", "a") else "o"
            self.letters += (letter.upper() if trunc else letter).encode()

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.letters.decode()


# ------------------------------------------------------------------ the automaton
class Node(NamedTuple):
    """A place with the same rest in all conversations: the cheapest cost
    (above ``base``) and the piece and next state that reach it, by state."""
    costs: tuple
    pieces: tuple
    states: tuple


@lru_cache(maxsize=1)
def last_node() -> Node:
    """After the last row: inserts until the grammar accepts."""
    out = []
    for state in range(4):
        n, s = 0, state
        while s not in ACCEPTING:
            s, n = NEXT[s, OWED[s]], n + 1
        out.append((INSERT * n, "I" * n, s))
    return Node(*zip(*out))


def edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(piece, cost, next state) of everything that can be done at a row."""
    role, extra = letter.lower(), TRUNCATED * letter.isupper()
    for inserts in range(3):  # with two inserts every state has been reached
        at, cost = "I" * inserts, INSERT * inserts
        yield at + "D", cost + DELETE, state
        if letter != GONE:
            if (state, role) in NEXT:
                yield at + "K", cost + extra, NEXT[state, role]
            yield at + "R", cost + REROLE + extra, NEXT[state, OWED[state]]
        state = NEXT[state, OWED[state]]


@lru_cache(maxsize=1 << 16)
def step(letter: str, costs: tuple) -> tuple[int, Node]:
    """(base, node) of the place before a row, given the costs after it. Costs
    differ by a few units between states, so few cost tuples exist."""
    out = []
    for state in range(4):
        cost, piece, to = min((c + costs[s], p, s) for p, c, s in edits(letter, state))
        out.append((cost, piece, to))
    base = min(c for c, _, _ in out)
    return base, Node(tuple(c - base for c, _, _ in out), tuple(p for _, p, _ in out), tuple(s for _, _, s in out))


class Automaton:
    """The path of the last signature, from its end; signatures come in order
    of their reverses, so a shared end is on the path already."""

    def __init__(self):
        self.back, self.path, self.base = "", [last_node()], [0]
        self.made = 0  # nodes computed

    def best(self, back: str) -> tuple[int, list[str]]:
        """(cost, pieces in order) of a signature that is given reversed."""
        keep = _shared(self.back, back)
        del self.path[keep + 1:], self.base[keep + 1:]
        for letter in back[keep:]:
            more, node = step(letter, self.path[-1].costs)
            self.path.append(node)
            self.base.append(self.base[-1] + more)
        self.made += len(back) - keep
        self.back = back
        state, out = BEGIN, []
        for node in reversed(self.path):
            out.append(node.pieces[state])
            state = node.states[state]
        return self.base[-1] + self.path[-1].costs[BEGIN], out


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


PLANS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(per_conv: DataFrame, id_type: str = "long") -> DataFrame:
    """facts with cost and audit. The conversation is part of the range key, so a
    signature of many conversations is spread over tasks."""
    spark = per_conv.sparkSession
    names = [f.split()[0] for f in PLANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for b in batches:
            rows = [(*head, cost, "".join(pieces)) for *head, (cost, pieces) in
                    zip(*[b[c].to_pylist() for c in names[:6]], map(automaton.best, b["back"].to_pylist()))]
            yield _batch(rows, PLANS, id_type)

    p = per_conv.withColumn("back", F.reverse("signature")).withColumn("h", F.xxhash64("conv_id"))
    p = p.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "back", "h").sortWithinPartitions("back", "h")
    return p.mapInArrow(run, _typed(PLANS, id_type))


# ------------------------------------------------------------------- the repair
def pieces_of(audit: str) -> Iterator[str]:
    """The pieces of an audit: inserts and the edit that ends them."""
    first = 0
    for i, c in enumerate(audit):
        if c != "I":
            yield audit[first:i + 1]
            first = i + 1
    yield audit[first:]


def repaired_rows(plan: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from the pieces and its rows."""
    state = BEGIN

    def inserted(n: int) -> Iterator[tuple[str, str]]:
        nonlocal state
        for _ in range(n):
            yield ROLE[OWED[state]], ""
            state = NEXT[state, OWED[state]]

    for role, text in rows:
        piece = next(plan)
        yield from inserted(len(piece) - 1)
        if piece[-1] == "K":
            yield role, text
            state = NEXT[state, role[:1]]
        elif piece[-1] == "R":
            yield ROLE[OWED[state]], text
            state = NEXT[state, OWED[state]]
    yield from inserted(len(next(plan)))


def _with_plans(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows in order, each conversation led by its audit (``head`` true)."""
    small_batches(rows.sparkSession)
    live = rows.filter("live").select("conv_id", F.lit(False).alias("head"), "turn", "role", text_digest().alias("d"), "copy", "text")
    heads = planned.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                           F.lit(None).cast("binary").alias("d"), F.lit(0).alias("copy"), F.col("audit").alias("text"))
    both = live.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.desc("head"), *ORDER).select("conv_id", "head", "turn", "role", "text")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, repaired rows as an iterator of (turn, role, text) inputs) one
    conversation after the other; each must be used up before the next."""
    cells = (c for b in batches for c in zip(*[b[n].to_pylist() for n in ("conv_id", "head", "turn", "role", "text")]))
    head = next(cells, None)
    while head is not None:
        after: list = [None]

        def own():
            for c in cells:
                if c[1]:
                    after[0] = c
                    return
                yield c[3], c[4]

        stream = own()
        yield head[0], repaired_rows(pieces_of(head[4]), stream)
        for _ in stream:
            pass
        head = after[0]


def repaired(rows: DataFrame, planned: DataFrame, id_type: str = "long") -> DataFrame:
    """The repaired conversations as rows: conv_id, turn (0, 1, ...), role, text."""
    schema = "conv_id long, turn long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for conv, stream in _streams(batches):
            for i, (role, text) in enumerate(stream):
                held.append((conv, i, role, text))
                if len(held) >= 512:
                    yield _batch(held, schema, id_type)
                    held = []
        yield _batch(held, schema, id_type)

    return _with_plans(rows, planned).mapInArrow(run, _typed(schema, id_type))


def digests(rows: DataFrame, planned: DataFrame, id_type: str = "long") -> DataFrame:
    """(conv_id, repaired_sha256): the hash of the repaired rows as lines."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for conv, stream in _streams(batches):
            sha, first = hashlib.sha256(), True
            for role, text in stream:
                sha.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                first = False
            held.append((conv, sha.hexdigest()))
            if len(held) >= 4096:
                yield _batch(held, schema, id_type)
                held = []
        yield _batch(held, schema, id_type)

    return _with_plans(rows, planned).mapInArrow(run, _typed(schema, id_type))


def plan_repair(rows: DataFrame) -> DataFrame:
    """Per conversation: faults, cost and audit, written once."""
    kind = id_type_of(rows)
    return cut_lineage(plans(cut_lineage(facts(faulted(rows), kind)), kind))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of a table of conversations."""
    rows = as_is(conversations)
    return repaired(rows, plan_repair(rows), id_type_of(rows))


def digest(rows: DataFrame) -> DataFrame:
    """Per conversation: faults, cost, audit and the hash of its repaired rows."""
    planned = plan_repair(rows)
    sha = digests(rows, planned, id_type_of(rows))
    on = F.col("p.conv_id").eqNullSafe(F.col("s.conv_id"))
    return planned.alias("p").join(sha.alias("s"), on).select("p.*", "s.repaired_sha256")
