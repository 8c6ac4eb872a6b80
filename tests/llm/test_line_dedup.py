import hashlib
import random
from collections import Counter

from cuespark.llm import line_dedup as L


def key(x):
    x = x.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def brute(docs, n=10):
    order = lambda d: (d is not None, d or 0)
    least = {}
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= n:
                k = key(x)
                least[k] = min(least.get(k, d), d, key=order)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < n or least[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sample():
    rnd = random.Random(2)
    pool = [" ".join(rnd.choices(["ab", "É", "xyz", "Q"], k=rnd.randint(1, 8))) for _ in range(60)] + ["  The Common line here ", "the common line here\t", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé"]
    docs = [(rnd.randint(-20, 400), "\n".join(rnd.choices(pool, k=rnd.randint(0, 200)))) for _ in range(150)]
    docs += [(900, None), (901, ""), (None, docs[0][1]), (None, "The common line here"), (5, docs[1][1]), (5, docs[1][1]), (5, "The common line here\nfresh line number"),
             (1000, "the common line here\n" * 5000 + "end")]
    return docs


def test_report_matches_brute_force(spark, make_docs):
    docs = sample()
    for share in (L.HOT_SHARE, 3):
        old, L.HOT_SHARE = L.HOT_SHARE, share
        try:
            got = [tuple(r) for r in L.report(make_docs(docs)).collect()]
        finally:
            L.HOT_SHARE = old
        assert Counter(got) == Counter((d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in brute(docs))


def test_texts_and_clashing_columns(spark, make_docs):
    docs = sample()
    odd = make_docs(docs).selectExpr("*", "1 as row", "2 as dropped", "3 as _d", "4 as n_lines")
    got = L.dedup_lines(odd)
    assert got.columns == odd.columns
    want = Counter((d, t) if docs[i][1] is not None else (d, None) for i, (d, _, _, t) in enumerate(brute(docs)))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want


def test_bitmaps_are_sparse(spark, make_docs):
    one = "\n".join(f"line number {i}" for i in range(1000))
    rows = L.keep_bitmaps(make_docs([(1, one), (2, "line number 700\nother"), (3, "\n".join(["x"] * 500 + ["line number 3"]))])).collect()
    assert {(r["_d"], tuple(r.dropped.items())) for r in rows} == {(2, ((0, 1),)), (3, ((7, 1 << 52),))}


def test_empty_table(spark, make_docs):
    assert L.report(make_docs([])).count() == 0
