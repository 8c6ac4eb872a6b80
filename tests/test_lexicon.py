"""A1-A4 on the fixture rows, plus the lexicon total."""

from pyspark.sql import functions as F

from cuespark.operators import lexicon as L


def _tok(spark, pairs):
    return spark.createDataFrame([(0, i, t, p) for i, (t, p) in enumerate(pairs)],
                                 "doc_id long, tok_id int, token string, pos string")


def test_lexicon_counts(spark):
    lex = {(r.gram, r.pos): r.n for r in L.lexicon(_tok(spark, [("cat", "NN"), ("cats", "NNS"), ("cat", "NN")])).collect()}
    assert lex == {("cat", "NN"): 4, ("ca", "NN"): 2, ("c", "NN"): 2, ("cats", "NNS"): 2, ("cat", "NNS"): 1,
                   ("ca", "NNS"): 1, ("c", "NNS"): 1}


def test_lexicon_total(spark):
    words = ["a", "house", "houses", "unbelievable", "cat"]
    lex = L.lexicon(_tok(spark, [(w, "NN") for w in words]))
    assert lex.agg(F.sum("n")).first()[0] == sum(1 + min(5, len(w)) for w in words)


def test_sbs_count(spark):
    t = _tok(spark, [("cat", "NN"), ("cats", "NNS"), ("cat", "NN"), ("uncat", "NN"), ("dog", "NN")])
    out = {r.token: r.sbs_count for r in L.with_sbs_count(t).collect()}
    assert out["uncat"] == 8 and out["cat"] == 0 and out["dog"] == 0


def test_sbs_count_exact(spark):
    t = _tok(spark, [("cat", "NN"), ("uncat", "NN"), ("careless", "NN"), ("care", "NN")])
    out = {r.token: r.sbs_count_exact for r in L.with_sbs_count_exact(t).collect()}
    # 'cat' counts 2 (itself + its 3-gram), 'care' 2 (+ 'careless' starts with 'care')
    assert out["uncat"] == 2 and out["careless"] == 3 and out["cat"] == 0


def test_sbs_counts_leave_out_whole_words(spark):
    t = _tok(spark, [("catering", "NN"), ("catering", "NN"), ("cater", "NN"), ("uncatering", "NN"), ("un", "NN")])
    per = L.sbs_counts(t)
    out = {r.token: r.sbs_count for r in per.collect()}
    # c, ca, cat, cate: 2 + 1 each; cater also as the word itself
    assert out == {"uncatering": 4 * 3 + 4}
    given = L.sbs_counts(t, lex=L.lexicon(t))
    assert {r.token: r.sbs_count for r in given.collect()} == out
    plan = per._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # words longer than any n-gram go before the lexicon is summed, so below an Aggregate of it
    sums = [i for i, x in enumerate(plan) if "Aggregate [gram" in x]
    cut = [i for i, x in enumerate(plan) if "length(gram" in x and "<= 5" in x]
    assert sums and cut and min(sums) < max(cut), plan
