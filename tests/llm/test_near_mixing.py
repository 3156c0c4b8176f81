"""Near-duplicates against all pairs, mixing against its contract, and the
pipeline against its stages' rules."""

import collections
import random

import numpy as np
import pytest

from panelkit.llm import mixing, near_dup


def word_sets(texts):
    out = {}
    for i, t in texts.items():
        w = near_dup.text_words(t)
        out[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k:k + 5]) for k in range(len(w) - 4)])
    return out


def all_pairs_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = sorted(sets)
    for k, i in enumerate(items):
        for j in items[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def edited(words, rnd, share):
    return [f"e{rnd.random()}" if rnd.random() < share else w for w in words]


@pytest.fixture(scope="module")
def near_texts():
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    texts = {}
    for _ in range(60):
        base = [f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(3, 120))]
        for _ in range(rnd.randint(1, 6)):
            texts[len(texts)] = " ".join(edited(base, rnd, rnd.choice([0, 0.005, 0.01, 0.03])))
    for _ in range(60):  # a common passage in otherwise different documents
        texts[len(texts)] = " ".join([f"q{rnd.random()}" for _ in range(rnd.randint(5, 60))] + passage)
    one = [f"c{i}" for i in range(150)]
    for _ in range(120):  # one large group of near copies
        texts[len(texts)] = " ".join(edited(one, rnd, rnd.choice([0.01, 0.02, 0.04])))
    for t in ("", " ", "Short Text", "short text", "short", "a b c d", "a b c d e"):
        texts[len(texts)] = t
    return texts


def near_frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in texts.items()], "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("limits", [None, {"NODE": 16, "CLUSTER_WORK": 5000, "DEEPER": 1}])
def test_components_match_all_pairs(spark, near_texts, monkeypatch, limits):
    for k, v in (limits or {}).items():  # small limits: deeper nodes, blocks and large clusters
        monkeypatch.setattr(near_dup, k, v)
    sets = word_sets(near_texts)
    want = all_pairs_components({i: s for i, s in sets.items() if s})
    df = near_frame(spark, near_texts)
    got = near_dup.decide(df).collect()
    assert len(got) == len(near_texts)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == want.get(r.doc_id, r.doc_id), r
        assert r.kept == (r.doc_id == r.component_id)
    if not limits:
        kept = near_dup.keep_one(df)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept) and kept.columns == df.columns


def test_large_nodes_with_the_same_classes(spark, monkeypatch):
    """Texts with equal sets meet in the same node of every tree, with one at 0.75."""
    monkeypatch.setattr(near_dup, "NODE", 8)
    texts = {}
    for f in range(24):
        passage = [f"f{f}w{i}" for i in range(30)]
        for n in range(2, 14):
            texts[len(texts)] = " ".join(passage * n)
        texts[len(texts)] = " ".join(passage * 2 + [f"f{f}x{i}" for i in range(10)])
    want = all_pairs_components(word_sets(texts))
    assert len(set(want.values())) == 24
    assert {r.doc_id: r.component_id for r in near_dup.decide(near_frame(spark, texts)).collect()} == want


def test_branching_nodes_get_more_trees(spark, monkeypatch):
    """Pairs at 0.75 in nodes that branch: the first trees alone lose some."""
    for k, v in {"TREES": 12, "MORE_TREES": 70, "NODE": 4, "DEEPER": 4}.items():
        monkeypatch.setattr(near_dup, k, v)
    rng = np.random.default_rng(9)
    rows, pairs = [], []
    for f in range(12):  # a family, each of its classes at about 0.75 from the others
        one = rng.integers(0, 1 << 16, near_dup.SIGNATURE, dtype=np.uint16)
        for _ in range(12):
            sig, at = one.copy(), rng.choice(near_dup.SIGNATURE, 17, replace=False)
            sig[at] = rng.integers(0, 1 << 16, len(at), dtype=np.uint16)
            rows.append((len(rows), bytearray(sig.tobytes())))
        pairs += [(a, b) for b in range(len(rows) - 12, len(rows)) for a in range(len(rows) - 12, b)]
    nodes = collections.defaultdict(set)
    for r in near_dup.leaves(spark.createDataFrame(rows, "rep long, sig binary")).collect():
        nodes[r.node].add(r.rep)
    met = {(a, b) for n in nodes.values() for a in n for b in n}
    assert not [p for p in pairs if p not in met]


def test_large_family_costs_what_its_members_do(spark, monkeypatch):
    """Near copies in nodes and clusters of many blocks: components as by all
    pairs, and rows per class that do not grow with the family."""
    for k, v in {"NODE": 64, "GROUP": 32, "LEADS": 16, "PIVOTS": 8}.items():
        monkeypatch.setattr(near_dup, k, v)
    rnd, rows = random.Random(8), {}
    shipped = []
    by_node = near_dup.by_node

    def counting(df, fn):
        df = near_dup.cut_lineage(df)
        shipped.append(df.count())
        return by_node(df, fn)

    monkeypatch.setattr(near_dup, "by_node", counting)
    for n in (150, 600):
        base, texts = [f"w{i}" for i in range(150)], {}
        for i in range(n):
            own = list(base)
            for at in rnd.sample(range(150), rnd.randint(1, 4)):
                own[at] = f"e{rnd.random()}"
            texts[i] = " ".join(own)
        shipped.clear()
        got = {r.doc_id: r.component_id for r in near_dup.decide(near_frame(spark, texts)).collect()}
        assert got == all_pairs_components(word_sets(texts))
        rows[n] = sum(shipped) / n
    assert rows[600] < 3 * rows[150]


def test_second_pass_joins_families_that_one_text_links(spark, monkeypatch):
    """Two large families without a common pivot, linked by one text only."""
    for k, v in {"NODE": 8, "GROUP": 8, "LEADS": 4, "PIVOTS": 2}.items():
        monkeypatch.setattr(near_dup, k, v)
    common, texts = [f"c{i}" for i in range(100)], {}
    left, right = [f"l{i}" for i in range(14)], [f"r{i}" for i in range(14)]
    for f, side in enumerate((left, right)):
        for i in range(40):
            texts[len(texts)] = " ".join(common + side + [f"{f}x{i}"])
    texts[len(texts)] = " ".join(common)
    want = all_pairs_components(word_sets(texts))
    assert {r.doc_id: r.component_id for r in near_dup.decide(near_frame(spark, texts)).collect()} == want


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(rnd.randint(2000, 2400), rnd.randint(2000, 2400)) for _ in range(300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.v: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long").distinct()).collect()}
    assert got == {v: find(v) for e in edges for v in e}


def test_near_dup_odd_rows(odd, empty):
    got = near_dup.decide(odd).collect()
    assert len(got) == 12
    same = [r for r in got if r.component_id == 1]  # one text in either case, under ids 1, 1, 2 and null
    assert len(same) == 4 and sum(r.kept for r in same) == 1 and same[0].n_shingles == 8
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert all(r.kept and r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)
    assert near_dup.decide(empty).count() == 0 and near_dup.keep_one(empty).count() == 0


# ---------------------------------------------------------------- mixing
def plain_targets(sums):
    """Targets of sources in order, by sharing again until none is above."""
    total, w = sum(sums), [mixing.WEIGHTS[i % 3] for i in range(len(sums))]
    full = set()
    while True:
        rest = total - sum(3 * sums[i] for i in full)
        weight = sum(w[i] for i in range(len(sums)) if i not in full)
        share = [3 * s if i in full else rest * w[i] / weight for i, s in enumerate(sums)]
        over = {i for i, s in enumerate(sums) if i not in full and share[i] > 3 * s}
        if not over:
            return share
        full |= over


def test_knapsack_reaches_the_best_sum():
    rnd = random.Random(1)
    for _ in range(200):
        sizes = np.array(sorted(rnd.sample(range(1, 40), rnd.randint(1, 6))))
        free = np.array([rnd.randint(0, 4) for _ in sizes])
        budget = rnd.randint(0, 120)
        sums = {0}
        for s, f in zip(sizes, free):
            sums = {x + k * int(s) for x in sums for k in range(f + 1)}
        got = mixing.knapsack(sizes, free, budget)
        assert (got <= free).all() and int((got * sizes).sum()) == max(x for x in sums if x <= budget)


def test_fit_counts_is_near_the_budget():
    rnd = random.Random(2)
    for _ in range(100):
        sizes = np.array(sorted(rnd.sample(range(1, 3000), rnd.randint(1, 200))))
        counts = np.array([rnd.randint(1, 30) for _ in sizes])
        whole = int((sizes * counts).sum())
        budget = rnd.randint(0, whole)
        got = mixing.fit_counts(sizes, counts, budget, 1)
        assert (got >= 0).all() and (got <= counts).all()
        assert abs(int((got * sizes).sum()) - budget) <= (5 if len(sizes) > 50 and budget > 10_000 else sizes[0])


def test_fit_counts_of_long_documents():
    fit = lambda sizes, counts, budget: int((mixing.fit_counts(np.array(sizes), np.array(counts), budget, 1) * np.array(sizes)).sum())
    assert fit([10_000, 30_000], [3, 3], 50_000) == 50_000
    assert fit([10_000, 30_000], [30, 30], 504_000) == 500_000
    assert fit([20_000], [9], 31_000) == 40_000
    rnd = random.Random(5)
    for k in range(60):  # the nearest of all sums, also of small budgets
        sizes = sorted(rnd.sample(range(9000, 120_000) if k % 2 else range(1, 60), rnd.randint(1, 5)))
        counts = [rnd.randint(1, 4) for _ in sizes]
        sums = {0}
        for s, f in zip(sizes, counts):
            sums = {x + n * s for x in sums for n in range(f + 1)}
        budget = rnd.randint(0, max(sums))
        assert abs(fit(sizes, counts, budget) - budget) == min(abs(x - budget) for x in sums)
    # very many long documents: the share leaves enough to the search
    sizes, counts = sorted(rnd.sample(range(9000, 400_000), 300)), [1000] * 300
    assert fit(sizes, counts, 12_345_678_901) == 12_345_678_901


def test_mixing_contract(spark):
    rnd = random.Random(7)
    names = ["b", "a", None, "é", "Z", "aa", "hot"]
    rows = [(i, " ".join("w" * rnd.randint(0, 60)), rnd.choice(names) if rnd.random() < 0.6 else "hot") for i in range(3000)]
    rows += [(3000 + i, "w " * 5, "tiny") for i in range(3)] + [(4000, None, "none")]
    df = spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in mixing.plan_rows(df).collect()}
    assert len(got) == len(rows)
    sums, taken = collections.Counter(), collections.Counter()
    for i, t, s in rows:
        assert got[i].size == len((t or "").split())
        sums[s] += got[i].size
        taken[s] += got[i].taken
        assert got[i].taken <= 3 * got[i].size and got[i].taken == got[i].size * got[i].copies
    order = sorted([s for s in sums if s is not None], key=lambda s: s.encode()) + [None]
    share = dict(zip(order, plain_targets([sums[s] for s in order])))
    for i, _, s in rows:
        assert got[i].source_size == sums[s] and got[i].target == pytest.approx(share[s])
    for s in order:
        assert abs(taken[s] - share[s]) <= 2, (s, taken[s], share[s])
    again = {r.doc_id: r.taken for r in mixing.plan_rows(df.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in got.items()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {i: r.copies for i, r in got.items() if r.copies}


def test_mixing_odd_rows(odd, empty):
    got = mixing.plan_rows(odd.drop("size").withColumnRenamed("row", "rank")).collect()
    assert len(got) == 12 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.plan_rows(empty).count() == 0 and mixing.mix(empty).count() == 0


# -------------------------------------------------------------- the pipeline
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert after.columns == columns, name
        rows, left = before.collect(), after.collect()
        if i == 1:
            best = {}
            for r in rows:
                best[r.text] = max(best.get(r.text, -1), r.doc_id)
            assert sorted(r.doc_id for r in left) == sorted(best.values())
        if i == 2:
            want = all_pairs_components({k: s for k, s in word_sets({r.doc_id: r.text for r in rows}).items() if s})
            assert {r.doc_id for r in left} == {i for i in (r.doc_id for r in rows) if want.get(i, i) == i}
        if i == 4:
            assert sorted(r.doc_id for r in left) == sorted(r.doc_id for r in rows) and all(r.round_trip for r in left)
        before = after
    assert corpus_pipeline.run(spark, sf).count() == before.count()


def test_queries_and_entry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
