"""Repair of conversations: against exhaustive edits and a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelkit.llm import conversations as C

LETTERS = "suaoSUAOx"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def exhaustive(signature):
    """(cost, audit) over all edit strings with up to len + 2 inserts."""
    best = None
    n = len(signature)
    ends = {""}
    for i in range(n + 1):
        grown = set()
        for k in range(3):
            for have in ends:
                for own in itertools.product("ua", repeat=k):
                    grown.add(have + "".join("I" + r for r in own))
        if i < n:
            letter, nxt = signature[i], set()
            for g in grown:
                nxt.add(g + "D-")
                if letter != "x":
                    nxt.add(g + "K" + letter.lower())
                    nxt |= {g + "Ru", g + "Ra"}
            grown = nxt
        ends = grown
    for e in ends:
        ops, roles = e[::2], e[1::2].replace("-", "")
        if not re.fullmatch("(s?(ua)+)?", roles):
            continue
        rows = [o for o in ops if o != "I"]
        cost = sum(COST[o] for o in ops) + sum(1 for o, x in zip(rows, signature) if o != "D" and x.isupper())
        best = min(best or (cost, ops), (cost, ops))
    return best


def test_cheapest_edits_are_exhaustive():
    a = C.Automaton()
    words = [""] + ["".join(w) for n in (1, 2) for w in itertools.product(LETTERS, repeat=n)]
    words += ["".join(random.Random(3).choices(LETTERS, k=3)) for _ in range(40)]
    for w in sorted(words, key=lambda w: w[::-1]):
        cost, pieces = a.best(w[::-1])
        assert (cost, "".join(pieces)) == exhaustive(w), w
    assert a.made < sum(map(len, words))  # shared ends are computed once


def test_nodes_are_shared():
    a = C.Automaton()
    words = sorted("".join(w) for w in itertools.product("suax", repeat=6))
    first = {w: a.best(w) for w in words}  # read as reversed signatures
    assert a.made == sum(4**k for k in range(1, 7))  # one node per distinct suffix
    rnd = random.Random(1)
    for w in rnd.sample(words, 200):
        assert C.Automaton().best(w) == first[w]
    n = 200_000
    cost, pieces = C.Automaton().best("au" * n)
    assert cost == 0 and set(pieces[:-1]) == {"K"} and len(pieces) == 2 * n + 1


def plain(rows, damage=True):
    """{conv_id: result} by the contract; rows: (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        own += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        n, sig, seen = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), "", set()
        for i, (_, role, text) in enumerate(own):
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            sig += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
            n["illegal"] += i > 0 and own[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        turns = {t for t, _, _ in own if t is not None}
        cost, audit = cheapest(sig)
        state, lines, at = "", [], 0
        for e in audit:
            owed = "a" if state == "u" else "u"
            if e == "I":
                lines.append(f"{C.ROLE[owed]}:")
                state = owed
                continue
            _, role, text = own[at]
            at += 1
            if e == "K":
                lines.append(f"{role}:{text}")
                state = role[0]
            elif e == "R":
                lines.append(f"{C.ROLE[owed]}:{text}")
                state = owed
        out[conv] = {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **n, "cost": cost, "audit": audit,
                     "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def cheapest(sig):
    """Whole audit strings from the end, by state."""
    after = {"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}
    for letter in reversed(sig):
        now = {}
        for state in ("", "s", "u", "a"):
            options, s = [], state
            for k in range(3):
                owed = "a" if s == "u" else "u"
                def put(op, cost, to, k=k, options=options):
                    options.append((2 * k + cost + after[to][0], "I" * k + op + after[to][1]))
                put("D", 3, s)
                if letter != "x":
                    put("R", 2 + letter.isupper(), owed)
                    if letter.lower() == owed or letter.lower() == "s" and s == "":
                        put("K", int(letter.isupper()), letter.lower())
                s = owed
            now[state] = min(options)
        after = now
    return after[""]


def compare(df, damage=True):
    rows = C.damaged(df) if damage else C.as_is(df)
    got = C.digest(rows).collect()
    want = plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], damage)
    assert len(got) == len(want)
    for r in got:
        own = r.asDict()
        assert {k: own[k] for k in want[r.conv_id]} == want[r.conv_id], r.conv_id


def test_query_matches_plain_version(spark):
    from panelkit.llm.queries import op13_conversations

    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    compare(df)
    assert op13_conversations(spark, sf).count() == df.select("conv_id").distinct().count()


SCHEMA = "conv_id long, turn int, role string, text string, head int, audit string"


def test_odd_conversations(spark):
    rnd = random.Random(5)
    rows = [(None, None, None, None, 1, "x"), (None, 1, "user", "Hi.", 1, "x"), (1, None, "user", "Yes.", 0, None), (1, None, "user", "Yes.", 0, None),
            (2, 0, "tool", " \t", 0, ""), (2, 0, "assistant", "é 😀.\n", 0, ""), (2, 5, "", "w" * 100_000 + "!", 0, ""), (3, 7, "system", "", 0, "")]
    roles = ["system", "user", "assistant", "tool", None, "s", ""]
    rows += [(rnd.randint(4, 60), rnd.choice([None, *range(9)]), rnd.choice(roles), rnd.choice(["A.", "B?", "C", "", None, "D. \n"]), 0, "y") for _ in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    compare(df)
    compare(df, damage=False)
    compare(spark.createDataFrame([(f"c{i % 3}", i, "user", "x.") for i in range(9)], "conv_id string, turn long, role string, text string"))
    assert C.digest(C.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_large_conversation_and_many_equal_ones(spark):
    rows = [(0, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(3001)]
    rows += [(i, t, r, x) for i in range(1, 1500) for t, (r, x) in enumerate([("user", "Hello?"), ("assistant", "Yes.")])]
    compare(spark.createDataFrame(rows, SCHEMA.split(", head")[0]))


def test_repair_rows_follow_the_grammar(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Again."), (1, 2, "user", ""), (2, 0, "system", "Be kind."), (2, 1, "user", "Hm?")]
    got = C.repair(spark.createDataFrame(rows, SCHEMA.split(", head")[0])).orderBy("conv_id", "turn").collect()
    for conv in (1, 2):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in got if r.conv_id == conv))
    assert [(r.role, r.text) for r in got if r.conv_id == 2] == [("system", "Be kind."), ("user", "Hm?"), ("assistant", "")]


@pytest.mark.parametrize("name", ["facts", "digests"])
def test_plans_move_rows_once(spark, name):
    df = spark.createDataFrame([(1, 0, "user", "x.")], SCHEMA.split(", head")[0])
    rows = C.damaged(df)
    plan = C.facts(C.faulted(rows)) if name == "facts" else C.digests(rows, spark.createDataFrame([(1, "K")], "conv_id long, audit string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
