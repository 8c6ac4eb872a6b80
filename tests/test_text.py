"""F1-F10 on the hand-written rows of the fixture table."""

from pyspark.sql import functions as F

from cuespark.functions import text as T


def _one(spark, tokens, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, token string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_prefix(spark):
    assert _one(spark, ["unhappy", "dismay", "noon", "in", "non"], T.has_neg_prefix("token")) == [1, 1, 0, 1, 1]


def test_suffix_and_infix(spark):
    toks = ["careless", "carelessness", "restlessly", "lessly", "harness"]
    assert _one(spark, toks, T.has_neg_suffix("token")) == [1, 0, 0, 0, 0]
    assert _one(spark, toks, T.has_neg_infix("token")) == [0, 1, 1, 1, 0]


def test_punct_is_substring_test(spark):
    assert _one(spark, [".", "()", "--", "''", ""], T.is_punct("token")) == [1, 1, 0, 0, 1]


def test_punct_chars(spark):
    assert _one(spark, ["a.b", ""], T.punct_chars("token")) == [[0, 1, 0], []]


def test_match_one(spark):
    assert _one(spark, ["no", "not", "nothing", "note"], T.match_one("token")) == [1, 1, 1, 0]


def test_strip_affix(spark):
    toks = ["unhappy", "useless", "unless", "in", "cat"]
    assert _one(spark, toks, T.strip_affix("token")) == ["happy", "use", "un", "", ""]


def test_ngrams(spark):
    assert _one(spark, ["house", "cat", ""], T.start_ngrams("token")) == [
        ["house", "hous", "hou", "ho", "h"], ["cat", "ca", "c"], []]
    assert _one(spark, ["house", "cat"], T.end_ngrams("token")) == [["house", "ouse", "use", "se", "e"],
                                                                   ["cat", "at", "t"]]


def test_affix_ngrams(spark):
    out = _one(spark, ["unhappy", "cat"], T.affix_ngrams("token"))
    assert out[0]["start"] == ["happy", "happ", "hap", "ha", "h"]
    assert out[1]["end"] == ["cat", "at", "t"]


def test_ngrams_use_code_points(spark):
    assert _one(spark, ["héllo"], F.size(T.start_ngrams("token"))) == [5]


def test_ngrams_are_plain_expressions_and_keep_odd_tokens(spark):
    df = spark.createDataFrame([("unhappy",), ("",), ("less",), ("ab",), (None,), ("a😀cdef",)], "t string")
    out = df.select(T.start_ngrams("t").alias("s"), T.end_ngrams("t", 2).alias("e"), T.affix_ngrams("t")["start"].alias("a"))
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [
        (["unhap", "unha", "unh", "un", "u"], ["py", "y"], ["happy", "happ", "hap", "ha", "h"]), ([], [], []),
        (["less", "les", "le", "l"], ["ss", "s"], ["less", "les", "le", "l"]), (["ab", "a"], ["ab", "b"], ["ab", "a"]), ([], [], []),
        (["a😀cde", "a😀cd", "a😀c", "a😀", "a"], ["ef", "f"], ["a😀cde", "a😀cd", "a😀c", "a😀", "a"])]
