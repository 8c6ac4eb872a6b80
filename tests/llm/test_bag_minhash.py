import random
import re
from collections import Counter

import numpy as np
import pytest

from cuespark.llm import bag_minhash as B

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute_classes(docs, similarity=0.8):
    bags, root = [bag(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(bags):
        for j in range(i):
            if a and bags[j] and jaccard(a, bags[j]) >= similarity:
                root[find(i)] = find(j)
    order = lambda d: (d is not None, d or 0)
    least = {}
    for i, (d, _) in enumerate(docs):
        least.setdefault(find(i), []).append(d)
    return [(d, min(least[find(i)], key=order)) for i, (d, _) in enumerate(docs)]


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])


def test_multisets_are_exact():
    texts = ["a b c d e f", "", "A b", "x x x x x x x", "é b c d e", " \n", "a b c d e f a b c d e f"]
    row, x, count = B.multisets(*block(texts))
    for i, t in enumerate(texts):
        assert sorted(count[row == i]) == sorted(bag(t).values())
    common = lambda i, j: len(set(x[row == i]) & set(x[row == j]))
    assert common(0, 6) == 2 and common(0, 4) == 0


@pytest.mark.parametrize("weights", [[(1, 1)] * 60 + [(1, 0)] * 20 + [(0, 1)] * 20, [(3, 5)] * 30 + [(7, 7)] * 10, [(100, 40), (1, 1), (2, 9)] * 5])
def test_signatures_are_unbiased(weights):
    """The share of equal components is the weighted Jaccard similarity."""
    want = sum(min(w) for w in weights) / sum(max(w) for w in weights)
    rnd, m, equal, n = np.random.default_rng(7), 64, 0, 200
    for _ in range(n):
        x = np.sort(rnd.integers(0, 2**63, len(weights), dtype=np.uint64))
        rows = [(r, h, w[r]) for r in (0, 1) for h, w in zip(x, weights) if w[r]]
        row, h, c = (np.array(v) for v in zip(*rows))
        sig = B.signatures(row, h.astype(np.uint64), c, 2, m)
        assert np.isfinite(sig).all()
        equal += (sig[0] == sig[1]).sum()
    assert abs(equal / (n * m) - want) < 4 * (want * (1 - want) / (n * m)) ** 0.5 + 0.002


def test_overlap():
    a, b = Counter({1: 3, 5: 1, 9: 2}), Counter({1: 1, 9: 4, 2**63 + 7: 1})
    arr = lambda c: (np.array(sorted(c), dtype=np.uint64), np.array([c[k] for k in sorted(c)]))
    assert B.overlap(*arr(a), *arr(b)) == jaccard(a, b)


def sample(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)] + ["É", "日本"]
    docs = []
    for g in range(25):
        words = rnd.choices(vocab, k=rnd.choice([3, 12, 60, 200]))
        if g % 4 == 0:
            words = words[:40] * 4
        for _ in range(rnd.choice([1, 2, 5, 20])):
            w = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            docs.append((len(docs), " ".join(w)))
    return docs + [(900, None), (901, ""), (902, " \n\t"), (3, docs[5][1].upper()), (3, docs[5][1]), (None, docs[8][1]), (903, "one"), (904, "One"),
                   (905, " ".join(rnd.choices(vocab, k=30000)))]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_brute_force(spark, make_docs, seed):
    docs = sample(seed)
    got = [(r.id, r.class_id) for r in B.classes(make_docs(docs)).collect()]
    assert Counter(got) == Counter(brute_classes(docs))


def test_large_group_of_near_copies(spark, make_docs):
    """Recall of links inside a group whose members differ from its base."""
    rnd = random.Random(6)
    base, docs = [f"b{i}" for i in range(150)], []
    for d in range(300):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 3, 5])):
            w[rnd.randrange(150)] = f"x{rnd.random()}"
        docs.append((d, " ".join(w)))
    docs += [(1000 + d, " ".join(f"r{rnd.randrange(9999)}" for _ in range(80))) for d in range(50)]
    got = {r.id: r.class_id for r in B.classes(make_docs(docs)).collect()}
    want = dict(brute_classes(docs))
    assert len(set(got.values())) <= 1.01 * len(set(want.values()))
    pairs = [(a, b) for a in range(0, 300, 3) for b in range(a) if want[a] == want[b]]
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
    assert all(got[d] == d for d in range(1000, 1050))


def test_dedup_keeps_one_of_each_class(spark, make_docs):
    docs = sample() + [sample()[10]] * 3
    odd = make_docs(docs).selectExpr("*", "1 as rid", "2 as row", "3 as node", "4 as n")
    got = B.dedup(odd)
    assert got.columns == odd.columns
    rows, cls = got.collect(), brute_classes(docs)
    texts = {(d, t): c for (d, t), (_, c) in zip(docs, cls)}
    wordless = sum(not bag(t) for _, t in docs)
    assert len(rows) == wordless + len({c for (d, t), (_, c) in zip(docs, cls) if bag(t)})
    assert len({texts[r.doc_id, r.text] for r in rows if bag(r.text)}) == len(rows) - wordless


def test_empty_and_wordless_tables(spark, make_docs):
    assert B.report(make_docs([])).count() == 0
    assert sorted(tuple(r) for r in B.report(make_docs([(1, None), (2, "")])).drop("class_key").collect()) == [(1, 1, 0, True), (2, 2, 0, True)]
    assert B.dedup(make_docs([])).count() == 0


@pytest.mark.parametrize("few", [B.BROADCAST_ROWS, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(B, "BROADCAST_ROWS", few)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5)]
    df = spark.createDataFrame([(u, v) for u, v in links], "u bigint, v bigint")
    got = dict(tuple(r) for r in B.components(df).collect())
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want


def brute_components(docs, similarity=0.8):
    """Sets of row numbers, whatever the rows' ids; rows without words alone."""
    bags, parts = [bag(t) for _, t in docs], []
    for i, a in enumerate(bags):
        near = [p for p in parts if any(a and bags[j] and jaccard(a, bags[j]) >= similarity for j in p)]
        parts = [p for p in parts if p not in near] + [{i}.union(*near)]
    return parts


def test_classes_with_one_name_stay_apart(spark, make_docs):
    """Null and repeated ids on unrelated texts, with copies of some."""
    text = lambda c, n=30: " ".join(f"{c}{i}" for i in range(n))
    docs = [(None, text("a")), (None, text("b")), (7, text("b")), (3, text("c")), (3, text("d")), (5, text("d") + " tail"),
            (None, None), (None, ""), (3, text("c")), (None, text("a")), (3, " ")]
    want = Counter((min(docs[i][0] is not None and docs[i][0] or -1 for i in p), len(p), len(bag(docs[min(p)][1]))) for p in brute_components(docs))
    got = B.classes(make_docs(docs)).collect()
    by_root = {}
    for r in got:
        by_root.setdefault(r.root or r.seq, []).append(r)
    assert Counter((-1 if p[0].class_id is None else p[0].class_id, len(p), min(r.n for r in p)) for p in by_root.values()) == want

    kept = [docs[min(p, key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))] for p in brute_components(docs)]
    assert Counter((r.doc_id, r.text) for r in B.dedup(make_docs(docs)).collect()) == Counter(kept)
    report = B.report(make_docs(docs)).collect()
    assert len(report) == len(docs)
    assert Counter((r.doc_id, r.n_shingles) for r in report if r.kept) == Counter((d, sum(bag(t).values())) for d, t in kept)


def test_prefixes_keep_every_near_pair():
    """The first common shingle of near copies passes the filters."""
    rnd, counts = np.random.default_rng(5), np.zeros(1 << B.SLOT_BITS, np.int64)
    seen = 0
    for _ in range(300):
        x = rnd.integers(0, 2**63, 30, dtype=np.uint64) * np.uint64(2)
        counts[B._slots(x)] = rnd.integers(1, 9, 30)
        c = rnd.integers(1, 4, 30)
        two = [(np.sort(x[k]), c[k][np.argsort(x[k])]) for k in (np.sort(rnd.choice(30, rnd.integers(24, 31), replace=False)) for _ in "ab")]
        ends = np.cumsum([0, *(len(h) for h, _ in two)])
        row, h, left, n = B.prefix(np.concatenate([h for h, _ in two]).view(np.int64), np.concatenate([w for _, w in two]), ends, counts, 0.8)
        a, b = ({k: (m, t) for r, k, m, t in zip(row, h, left, n) if r == i} for i in (0, 1))
        if B.overlap(*two[0], *two[1]) >= 0.8:
            seen += 1
            assert any(1.8 * min(a[k][0], b[k][0]) >= 0.8 * (a[k][1] + b[k][1]) - 1e-6 for k in a.keys() & b.keys())
    assert seen > 50


def test_family_of_many_small_classes(spark, make_docs):
    """300 pairs of near copies (0.82) in one family of similar texts (0.75):
    nearly every bucket has hundreds of members and none is a link of most."""
    words = lambda c, n: [f"{c}_{i}" for i in range(n)]
    docs = [(2 * g + i, " ".join(words("t", 90) + words(f"p{g}", 4) + words(f"o{g}{'ab'[i]}", 10))) for g in range(300) for i in (0, 1)]
    bags = [bag(t) for _, t in docs[:3]]
    assert jaccard(bags[0], bags[1]) >= 0.8 > jaccard(bags[0], bags[2]) > 0.75
    got = Counter(r.class_id for r in B.classes(make_docs(docs)).collect())
    assert got == Counter({2 * g: 2 for g in range(300)})


def test_recall_on_the_given_documents(spark):
    """Every 50th document against all rows: each near copy is in its class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    bags = {r.doc_id: bag(r.text) for r in rows}
    shown = {r.doc_id: r.class_key for r in B.report(docs).collect()}
    links = hits = 0
    for q in (d for d in bags if d % 50 == 0):
        for d, other in bags.items():
            small, large = sorted((sum(bags[q].values()), sum(other.values())))
            if d == q or small < 0.8 * large or not small:
                continue
            shared = sum((bags[q] & other).values())
            if shared >= 0.8 * (small + large - shared):
                links += 1
                hits += shown[q] == shown[d]
    assert links and hits >= 0.9 * links


def test_classes_of_one_name_have_keys_of_their_own(spark, make_docs):
    docs = [(5, "one two three four five six"), (5, "other words in this text here"), (5, "one two three four five six"), (None, None)]
    got = sorted(((r.class_id, r.class_key, r.kept) for r in B.report(make_docs(docs)).collect()), key=str)
    assert len({k for _, k, _ in got}) == 3 and got[-1] == (None, None, True) and sum(k for *_, k in got) == 3


def test_equal_rows_with_other_columns_have_one_winner(spark):
    rows = [(1, "a b c d e f", x) for x in "pqrstuv"]
    kept = {tuple(B.dedup(spark.createDataFrame(sorted(rows, key=k), "doc_id bigint, text string, extra string").repartition(n)).collect()[0])
            for n in (1, 5) for k in (None, lambda r: -ord(r[2]))}
    assert len(kept) == 1
