"""Cross-tokenizer alignment: against the libraries and plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelkit.llm import token_align as T


def plain_tokens(texts):
    """Per text: [(id, start, end)] of A and of B, or two empty lists."""
    tok = Tokenizer.from_file(public_tokenizers.path(T.A_VOCABULARY))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.B_VOCABULARY))
    code = {c: b for b, c in T.byte_letters().items()}
    out = []
    for t in texts:
        if not t:
            out.append(([], []))
            continue
        a = [(i, bytes(code[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + t, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(t)]
        sides = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            sides.append(own)
        good = all(b"".join(x for _, x in s) == (" " + t).encode() for s in (a, b))
        out.append(tuple(sides) if good else ([], []))
    return out


def plain(texts):
    tokens = plain_tokens(texts)
    ends = [{e: i for i, _, e in b} for _, b in tokens]
    linked = [[(i, at[e]) for i, _, e in a if e in at] for (a, _), at in zip(tokens, ends)]
    count = Counter(p for own in linked for p in own)
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for (a, b), own in zip(tokens, linked):
        cuts = {x[2] for x in a} & {y[2] for y in b}
        sides = []
        for side in (a, b):
            sides.append([[]])
            for i, _, e in side:
                sides[-1][-1].append(str(i))
                if e in cuts:
                    sides[-1].append([])
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides)][:-1]
        out.append((len(a), len(b), len(groups), len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return out


def some_texts():
    rnd = random.Random(9)
    parts = ["the", "The,", "naïve", "É", "don't", "we'll", "3.14", "1234567", "x_y", "é", " ", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<s>", "日本", "😀", "a,b", "|",
             "end.\nStart", "\n", "\n\n", "\t", "  ", "   x", "\r\n", "<0x41>", "unbelievably", "internationalization", "\x00", "'s"]
    out = ["", " ", "\n", "a", " a", "a ", "\na", "▁", "x ▁ y", "<s>", "  ", "a b"]
    return out + [rnd.choice([" ", ""]).join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(250)]


def result(df):
    return [tuple(r)[1:] for r in T.digest(df).orderBy("doc_id").collect()]


def test_alignment_matches_plain_loops(spark):
    texts = some_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for t, got, want in zip(texts, result(df), plain(texts), strict=True):
        assert got == want, repr(t)


def test_registered_query_matches_plain_loops(spark):
    from panelkit.llm.queries import op11_token_align

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op11_token_align(spark, sf).collect()}
    assert len(got) == len(docs)
    for r, want in zip(docs, plain([r.text for r in docs]), strict=True):
        assert got[r.doc_id] == want, r.doc_id


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_links_match_plain_loops(spark, kind):
    texts = some_texts()[:80]
    got = {}
    for r in T.links(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), kind).collect():
        got.setdefault(r.doc_id, []).append((r.a_at, r.b_at, r.a_id, r.b_id, r.bytes))
    for i, (a, b) in enumerate(plain_tokens(texts)):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        group = lambda end: next(k for k, c in enumerate(cuts) if end <= c)
        if kind == "overlap":
            want = [(j, k, x[0], y[0], min(x[2], y[2]) - max(x[1], y[1])) for j, x in enumerate(a) for k, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
        else:
            want = [(j, k, x[0], y[0], None) for j, x in enumerate(a) for k, y in enumerate(b) if group(x[2]) == group(y[2])]
        assert sorted(got.get(i, [])) == sorted(want), repr(texts[i])


def test_sparse_products():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n, m, k = rng.integers(1, 9, 3)
        x, y = rng.integers(0, 3, (n, m)) * (rng.random((n, m)) < 0.4), rng.integers(0, 3, (m, k)) * (rng.random((m, k)) < 0.4)
        csr = lambda d: T.CSR(np.concatenate([[0], np.cumsum((d > 0).sum(1))]), np.nonzero(d)[1], d.shape[1], d[d > 0])
        p = csr(x).times(csr(y))
        dense = np.zeros((n, k), np.int64)
        dense[p.rows(), p.col] = p.val
        assert (dense == x @ y).all()
        t = csr(x).transpose()
        back = np.zeros((m, n), np.int64)
        back[t.rows(), t.col] = t.val
        assert (back == x.T).all()


def test_chunk_store_is_bounded():
    a = T.aligner(T.A_VOCABULARY, T.B_VOCABULARY)
    own = T.Aligner(a.a, a.b, limit=20)
    texts = [t for t in some_texts() if t][:60]
    whole = T.Aligner(a.a, a.b).align(texts)
    for i, t in enumerate(texts):
        total, sha, n, pair, count = own.align([t])
        assert (total[0] == whole[0][i]).all() and sha[0] == whole[1][i]
    assert len(own.index) <= 60


def test_odd_rows(odd, empty, spark):
    rows = odd.collect()
    got = T.digest(odd).collect()
    want = plain([r.text for r in rows])
    key = lambda r: repr(r)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(r.doc_id, *w) for r, w in zip(rows, want)], key=key)
    assert T.digest(empty).count() == 0
    assert T.digest(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 2
