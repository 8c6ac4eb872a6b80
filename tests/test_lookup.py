"""Lookups in tables that are too large to send: rows travel as chunks."""

import pytest
from pyspark.sql import functions as F

from cuespark.operators import lookup as Lk
from cuespark.operators import vectors as V
from cuespark.operators.sentences import feature_pairs
from cuespark.plans import models as M

SCHEMA = "doc_id long, token_id int, token string, lemma string, n int, x double, more array<string>, negcuelabel string"
ROWS = [(i // 20 if i % 31 else None, i % 20, f"w{i % 23}" if i % 7 else None, f"w{(i * 3) % 29}", (i % 5) - 2 if i % 11 else None, i / 3, ["a", None] if i % 2 else None,
         ["O", "B-NEG", "I-NEG"][i % 3] if i % 13 else None) for i in range(400)]


def _df(spark):
    return spark.createDataFrame(ROWS + ROWS[:9], SCHEMA)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("chunk", [1 << 17, 50])
def test_predictions_by_chunks_are_those_by_joins(spark, monkeypatch, chunk):
    df, names = _df(spark), ["token", "lemma", "n", "x"]
    model = M.train(df.where("token_id % 3 <> 0"), names, kind="nb")
    want = _rows(model.predict(df))
    monkeypatch.setattr(M, "SMALL_DOMAIN", 0)
    monkeypatch.setattr(Lk, "CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(chunk, 10000))
    try:
        out = model.predict(df)
        assert out.schema == model.predict(df).schema and out.columns == [*df.columns, "predicted"]
        assert _rows(out) == want
        assert _rows(model.predict(df.where("false"))) == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_with_many_terms_are_not_shuffled(spark, monkeypatch):
    """Neither side of a join is the rows: what meets the terms are words."""
    df = _df(spark)
    model = M.train(df, ["token", "lemma"], kind="nb")
    monkeypatch.setattr(M, "SMALL_DOMAIN", 0)
    plan = model.predict(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_blob" in plan and all("token" not in line for line in plan.splitlines() if "Join" in line)


def test_encoded_by_chunks(spark, monkeypatch):
    df, names = _df(spark), ["token", "n", "lemma"]
    listed = V.fit_one_hot(df.where("token_id < 15"), names)
    x = df.withColumn("feats", feature_pairs(names))
    want, ids = _rows(listed.transform(x)), _rows(listed.numbers(df, names))
    monkeypatch.setattr(V, "LISTED_TERMS", 0)
    monkeypatch.setattr(V, "SENT_TERMS", 0)
    enc = V.fit_one_hot(df.where("token_id < 15"), names)
    assert _rows(enc.transform(x, names)) == _rows(enc.transform(x)) == want
    assert _rows(enc.numbers(df, names)) == ids
    assert _rows(enc.transform(x, names, keep=["doc_id", "token_id"])) == _rows(listed.transform(x).select("doc_id", "token_id", "onehot"))
    assert F.col and enc.transform(x, names, keep=["doc_id"]).columns == ["doc_id", "onehot"]


def _sides(spark):
    """Odd texts, repeated positions, null ids and positions, documents over block borders."""
    odd = [(1, 0, "a", 3, "O"), (1, 1, "b\x1fc", None, "B"), (1, 2, None, 1, None), (1, 3, "", 0, "O"), (1, 3, "a", 5, "B"), (None, 0, "x", 0, "O"), (2, None, "z", 0, "O")]
    long = [(3, i, f"w{i % 97}", i % 7, "O" if i % 5 else "B") for i in range(9000)]
    df = spark.createDataFrame(odd + long, "doc_id long, tok_id int, token string, n int, label string")
    ann = [(d, p, "O" if (p or 0) % 3 else None if p == 6 else "B", [p]) for d, p, *_ in odd + long + odd[:4] if p != 7777]
    return df, spark.createDataFrame(ann, "doc_id long, tok_id int, pred string, more array<int>").coalesce(2)


@pytest.mark.parametrize("chunk", [1 << 17, 700])
def test_wide_rows_meet_annotations_as_chunks(spark, monkeypatch, chunk):
    from cuespark.operators import annotate as An
    df, ann = _sides(spark)
    df = df.coalesce(1)
    monkeypatch.setattr(Lk, "CHUNK", chunk)
    plain = df.join(ann, ["doc_id", "tok_id"])
    out = An.join_annotations(df, ann, wide=True)
    assert "_blob" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.schema.names == plain.schema.names and _rows(out) == _rows(plain)
    scattered = df.orderBy(F.xxhash64("token", "tok_id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    monkeypatch.setattr(Lk, "CHUNK", 100)
    try:
        assert Lk.join_chunks(scattered, ann, ["doc_id", "tok_id"]) is None
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert _rows(An.join_annotations(scattered, ann, wide=True)) == _rows(plain)


def test_error_rows_are_found_without_shuffling_gold_rows(spark):
    from cuespark.operators import evaluate as Ev
    df, ann = _sides(spark)
    out = Ev.error_rows(df, ann, gold_col="label")
    assert "_blob" in out._jdf.queryExecution().optimizedPlan().toString()
    want = df.join(ann.select("doc_id", "tok_id", F.col("pred").alias("predictedlabel")), ["doc_id", "tok_id"]).where("label <> predictedlabel")
    assert _rows(out) == _rows(want.select(*df.columns, "predictedlabel"))
    assert _rows(Ev.error_rows(df, ann, gold_col="label", category="B")) == _rows(want.where("label = 'B'").select(*df.columns, "predictedlabel"))
    assert Ev.error_rows(df.where("false"), ann, gold_col="label").count() == 0
