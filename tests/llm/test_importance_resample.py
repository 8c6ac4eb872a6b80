import hashlib
import math
import random
import re
import zlib

import pytest

from cuespark.llm import importance_resample as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def grams(text, order):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, order=1, buckets=10_000, share=10, least=20, seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for x, rows in ((s, docs), (t, [(None, d) for d in target])):
        for r in rows:
            for g in grams(r[1], order)[1]:
                x[bucket(g)] += 1
    gain = [math.floor(1000 * math.log(((b + 1) * (sum(s) + buckets)) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in ((r[0], r[1]) for r in docs):
        w, g = grams(text, order)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: share * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(n=400):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abCDé日9", k=rnd.randint(1, 4)))
    text = lambda k: "".join(word() + rnd.choice([" ", "\n", ", ", "\x00", "_"]) for _ in range(k))
    docs = [(rnd.randint(-99, 10**7), text(rnd.choice([0, 3, 19, 20, 21, 60]))) for _ in range(n)]
    return docs, [text(30) for _ in range(20)] + [None, ""]


def table(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("order", [1, 3])
def test_same_as_brute_force(spark, make_docs, order):
    docs, target = corpus()
    got = R.report(make_docs(docs), make_docs([(i, t) for i, t in enumerate(target)]), order=order)
    assert table(got) == brute(docs, target, order)


def test_ngrams_do_not_cross_documents():
    bucket, doc, n = R.batch_features(["a b".encode(), b"", "C".encode(), "é d e".encode()], 2, 1 << 30)
    want = [(d, zlib.crc32(g.encode()) % (1 << 30)) for d, gs in enumerate((["a", "b", "a b"], [], ["c"], ["é", "d", "e", "é d", "d e"])) for g in gs]
    assert sorted(zip(doc.tolist(), bucket.tolist())) == sorted(want) and n.tolist() == [2, 0, 1, 3]
    assert (doc[1:] >= doc[:-1]).all()


def test_nulls_long_texts_ties_and_repeats(spark, make_docs):
    long = "word " * 300_000
    docs = [(None, None), (None, "x " * 30), (1, ""), (2, long)] + [(7, "same text here " * 10)] * 50 + [(None, f"t{i} " * 25) for i in range(30)]
    target = make_docs([(0, "same text"), (1, None)])
    got = table(R.report(make_docs(docs), target, share=50))
    want = brute(docs, ["same text", None], share=50)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 42)) == sorted(r[4] for r in want if r[4])


def test_batches_and_partitions_do_not_matter(spark, make_docs, monkeypatch):
    docs, target = corpus(100)
    t = make_docs([(0, " ".join(target[:5]))])
    monkeypatch.setattr(R, "JOINED", 50)
    assert table(R.report(make_docs(docs).repartition(7), t)) == brute(docs, [" ".join(target[:5])])


def test_resample_returns_whole_rows_with_clashing_names(spark, make_docs):
    docs, target = corpus(200)
    rows = make_docs(docs).selectExpr("doc_id", "text", "'x' AS id", "1.5D AS score", "array(doc_id) AS rank", "'r' AS row", "text AS buckets", "lang AS n_words")
    got = R.resample(rows, make_docs([(0, target[0])]))
    assert got.columns == rows.columns and got.dtypes == rows.dtypes
    drawn = {r[0] for r in brute(docs, [target[0]]) if r[4]}
    assert {r.doc_id for r in got.collect()} == drawn and all(r.buckets == r.text for r in got.collect())


def test_empty_tables(spark, make_docs):
    docs, _ = corpus(60)
    assert R.report(make_docs([]), make_docs([(0, "a")])).count() == 0
    assert table(R.report(make_docs(docs), make_docs([]))) == brute(docs, [])


def test_target_like_documents_are_preferred(spark, make_docs):
    rnd = random.Random(5)
    text = lambda base: " ".join(f"{base}{rnd.randint(0, 50)}" for _ in range(40))
    docs = [(i, text("near" if i % 10 == 0 else "far")) for i in range(1000)]
    got = R.report(make_docs(docs), make_docs([(i, text("near")) for i in range(50)])).where("rank is not null").collect()
    assert len(got) == 100 and sum(r.doc_id % 10 == 0 for r in got) >= 80  # 10 by chance
