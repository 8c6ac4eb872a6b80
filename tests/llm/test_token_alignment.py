import hashlib
import random
import types
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cuespark.llm import token_alignment as T
from cuespark.llm.queries import tokenizer_file

A_FILE, B_FILE = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A_FILE)
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
BYTES = T.Tokenizers(A_FILE, B_FILE)
ENC = T.PieceEncoder(A_FILE, B_FILE)


def brute_groups(text):
    """Groups of A ids and B ids of whole-text encodings, or none."""
    if not text:
        return []
    a = TOK.encode(" " + text, add_special_tokens=False).ids
    b = SP.encode(text)
    spelt = lambda ids, table: [table[i] for i in ids]
    x, y = spelt(a, BYTES.bytes_a), spelt(b, BYTES.bytes_b)
    if not b"".join(x) == b"".join(y) == (" " + text).encode():
        return []
    ends = lambda tokens: np.cumsum([len(t) for t in tokens]).tolist()
    ea, eb = ends(x), ends(y)
    out, i, j = [], 0, 0
    for e in sorted(set(ea) & set(eb)):
        p, q = ea.index(e, i) + 1, eb.index(e, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def brute(docs):
    every = [(d, brute_groups(t)) for d, t in docs]
    count = Counter()
    for _, g in every:
        count.update({(x, y) for a, b in g for x in a for y in b})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for d, g in every:
        links = [(x, y) for a, b in g for x in a for y in b]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def table(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def plain(ends_a, ends_b):
    out, other = ([], []), set(ends_b)
    for i, e in enumerate(ends_a):
        if e in other:
            out[0].append(i + 1)
            out[1].append(ends_b.index(e) + 1)
    return out


@settings(max_examples=500, deadline=None)
@given(st.integers(1, 60).flatmap(lambda n: st.tuples(st.sets(st.integers(1, n)), st.sets(st.integers(1, n)), st.just(n))), st.integers(1, 5), st.integers(1, 9))
def test_runs_and_irregular_groups(x, probe, every):
    a, b, n = sorted(x[0] | {x[2]}), sorted(x[1] | {x[2]}), x[2]
    want = plain(a, b)
    T.PROBE, before = probe, T.PROBE
    try:
        lanes = [np.unique([0, *w[::every], w[-1]]) for w in want]
        assert tuple(v.tolist() for v in T.align(np.array(a), np.array(b), *lanes)) == want
    finally:
        T.PROBE = before


def test_long_one_to_one_stretches_take_few_probes(monkeypatch):
    ends = list(range(1, 500_001))
    a = np.array([e for e in ends if e not in (5000, 120_000)])
    b = np.array([e for e in ends if e not in (70_000,)])
    probes = []

    class Minimum:  # NumPy's, counting its reductions: one for each probe
        __call__ = staticmethod(np.minimum)

        def reduceat(self, *args):
            probes.append(1)
            return np.minimum.reduceat(*args)

    monkeypatch.setattr(T, "np", types.SimpleNamespace(**vars(np) | {"minimum": Minimum()}))
    got = T.align(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert tuple(v.tolist() for v in got) == plain_fast(a, b)
    assert len(probes) < 80


def plain_fast(a, b):
    common = np.intersect1d(a, b)
    return (np.searchsorted(a, common) + 1).tolist(), (np.searchsorted(b, common) + 1).tolist()


def encoded(rows):
    raw = [(" " + t).encode() if t else b"" for t in rows]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    x = T.Alignment(ENC, data, offsets)
    out = []
    for d in range(len(rows)):
        lo, hi = x.doc_g[d], x.doc_g[d + 1]
        i, j, groups = x.doc_a[d], x.doc_b[d], []
        for p, q in zip(x.upto_a[lo:hi], x.upto_b[lo:hi]):
            groups.append((x.a[i:p].tolist(), x.b[j:q].tolist()))
            i, j = p, q
        out.append(groups)
    return out


TRICKY = [*" \n\t\r\x0b\x1c\x85\xa0 　▁ab'sé×日\U0001f600._-<|>\x00", "<|endoftext|>", "<s>", "<0x0A>", "hello", "  ", "\r\n", "I'm"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TRICKY), max_size=30).map("".join), min_size=1, max_size=4))
def test_pieces_give_the_groups_of_whole_texts(rows):
    assert encoded(rows) == [brute_groups(t) for t in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(rows):
    assert encoded(rows) == [brute_groups(t) for t in rows]


def corpus(n=150):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choices(["the", "inter", "nation", "al", "ize", "é", "日本", "7", "x"], k=rnd.randint(1, 4)))
    docs = [(rnd.randint(-50, 10**6), "".join(word() + rnd.choice([" ", "\n", ", ", "  "]) for _ in range(rnd.randint(0, 60)))) for _ in range(n)]
    return docs + [(1, None), (2, ""), (None, "null id"), (3, "a ▁ b"), (3, "a ▁ b"), (4, "<|endoftext|> here"), (5, " " * 500 + "x"), (6, "=" * 3000)]


@pytest.mark.parametrize("block", [T.PAIRS, 100])
def test_same_as_brute_force(spark, make_docs, block):
    docs = corpus()
    assert table(T.report(make_docs(docs).repartition(3), A_FILE, B_FILE, block=block)) == brute(docs)


def test_long_groups_count_equal_links(spark, make_docs, monkeypatch):
    monkeypatch.setattr(T, "WIDE", 3)
    docs = corpus(40)
    data = [(" " + t).encode() for _, t in docs if t]
    x = T.Alignment(ENC, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    listed = x.links()
    monkeypatch.setattr(T, "WIDE", 1 << 40)
    for got, want in zip(listed, x.links()):
        assert got.tolist() == want.tolist()


def test_shared_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(T, "span_hashes", lambda data, start, base=0: np.zeros(len(start), np.uint64) if base == 0 else np.arange(len(start), dtype=np.uint64))
    monkeypatch.setitem(globals(), "ENC", T.PieceEncoder(A_FILE, B_FILE))
    for rows in (["a bc def", "ghi jk"], ["other words here"]):
        assert encoded(rows) == [brute_groups(t) for t in rows]


def test_short_lanes_and_small_memory(monkeypatch):
    monkeypatch.setattr(T, "LANE", 3)
    monkeypatch.setattr(T, "CACHE", 5)
    monkeypatch.setitem(globals(), "ENC", T.PieceEncoder(A_FILE, B_FILE))
    for _ in range(2):
        rows = [t or "" for _, t in corpus(30)]
        assert encoded(rows) == [brute_groups(t) for t in rows]


def test_alignments_hold_the_groups(spark, make_docs):
    docs = corpus(30)
    rows = make_docs(docs).selectExpr("doc_id", "text", "1 AS id", "2 AS a", "3 AS pairs")
    got = []
    for r in T.alignments(rows, A_FILE, B_FILE).collect():
        i = j = 0
        groups = []
        for p, q in zip(r.upto_a, r.upto_b):
            groups.append((r.a[i:p], r.b[j:q]))
            i, j = p, q
        got.append((r.doc_id, groups))
    assert sorted(got, key=str) == sorted(((d, brute_groups(t)) for d, t in docs), key=str)


def test_empty_table(spark, make_docs):
    assert T.report(make_docs([]), A_FILE, B_FILE).count() == 0
