"""J3/J4 vector lookups, the streaming feature path, and invariance of the
feature table to the number of shuffle partitions."""

from cuespark.operators import vectors as V
from cuespark.plans import relations as R
from cuespark.session import scratch_path
from cuespark.streaming.features import run_token_features, token_features
from cuespark.sources.documents import documents_tokens

SF = "/root/testdata/sf0.001"


def _emb(spark):
    return spark.createDataFrame([("cat", [1.0, 2.0]), ("dog", [3.0, 4.0])], "word string, embedding array<float>")


def test_unknown_word_gets_zeros(spark):
    df = spark.createDataFrame([(0, "cat"), (1, "emu")], "i int, lemma string")
    out = {r.i: list(r.vec) for r in V.embed(df, "lemma", _emb(spark), 2, out="vec").collect()}
    assert out == {0: [1.0, 2.0], 1: [0.0, 0.0]}


def test_context_vectors_in_order(spark):
    df = spark.createDataFrame([(0, "cat", "dog", "emu")], "i int, lemma string, prev string, next string")
    row = V.embed_context(df, _emb(spark), ["lemma", "prev", "next"], 2).first()
    assert list(row.dense) == [1.0, 2.0, 3.0, 4.0, 0.0, 0.0]
    row = V.embed_context(df, _emb(spark), ["lemma", "next"], 2).first()
    assert list(row.dense) == [1.0, 2.0, 0.0, 0.0]


def test_stream_equals_batch(spark):
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    run_token_features(spark, f"{SF}/documents.parquet*", sink, ckpt)
    streamed = spark.read.parquet(sink)
    batch = token_features(documents_tokens(spark, SF))
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert streamed.count() == batch.count()


def test_features_invariant_to_partition_count(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = R.features(spark, SF).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = R.features(spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) > 0


def test_rank_sorted_is_dense_and_ordered(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 37) % 5003).alias("k"))
    rows = V.rank_sorted(df, [F.desc("k")]).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(5000))
    assert [r.k for r in rows] == sorted((r.k for r in rows), reverse=True)


def test_read_vector_table_text(spark):
    import os
    from urllib.parse import urlparse
    path = urlparse(scratch_path(spark, "vec-text")).path  # local folder in tests
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "v.txt"), "w") as fh:
        fh.write("cat 1 2\n\ndog 3.5 -4\n")
    rows = {r.word: list(r.embedding) for r in V.read_vector_table(spark, path, fmt="text").collect()}
    assert rows == {"cat": [1.0, 2.0], "dog": [3.5, -4.0]}


def test_ranks_are_distinct_when_a_task_writes_several_files(spark):
    from cuespark.operators.context import corpus_position
    from cuespark.operators.vectors import rank_sorted
    df = spark.range(0, 500).selectExpr("concat('k', lpad(id, 4, '0')) as doc_id", "cast(0 as int) as tok_id")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        ranks = [r.idx for r in rank_sorted(df, "doc_id").orderBy("doc_id").collect()]
        places = [r.corpus_pos for r in corpus_position(df).orderBy("doc_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert ranks == list(range(500)) and places == list(range(500))


def test_encoder_columns_are_the_sorted_ranks(spark):
    from pyspark.sql import functions as F

    from cuespark.operators import vectors as V
    from cuespark.operators.sentences import feature_pairs
    fit = spark.createDataFrame([("b", 2), ("a", 1), ("c", 10)], "lemma string, n int")
    enc = V.fit_one_hot(fit, ["lemma", "n"])
    ranks = {r.term: r.idx for r in V.vocabulary_table(fit, ["lemma", "n"]).collect()}
    assert enc.vocabulary == sorted(ranks) and [ranks[t] for t in enc.vocabulary] == list(range(6))
    x = enc.transform(spark.createDataFrame([("a", 10), ("zz", 3)], "lemma string, n int").withColumn("feats", feature_pairs(["lemma", "n"])))
    size, nnz, idx = V.vector_entries(F.col("onehot"))
    assert sorted(tuple(r) for r in x.select(size, nnz, idx).collect()) == [(6, 0, []), (6, 2, [ranks["lemma=a"], ranks["n=10"]])]


def test_large_vocabularies_stay_tables(spark, monkeypatch):
    """The encoder's lookups give the columns of the listed vocabulary, also
    for terms sent to the tasks, and nothing lists it."""
    from pyspark.sql import functions as F

    from cuespark.operators.sentences import feature_pairs
    rows = [(i, f"w{i % 7}" if i % 5 else None, i % 3) for i in range(40)]
    fit = spark.createDataFrame(rows, "i int, lemma string, n int")
    score = fit.unionByName(spark.createDataFrame([(50, "new", 1), (51, "w1", 9), (52, "n=1", None)], fit.schema))
    x, names = score.withColumn("feats", feature_pairs(["n", "lemma"])), ["n", "lemma"]
    listed = V.fit_one_hot(fit, ["lemma", "n"])
    of = lambda df: {r.i: r.onehot for r in df.collect()}
    want, ids = of(listed.transform(x)), {r.i: list(r.ids) for r in listed.numbers(score, names).collect()}
    monkeypatch.setattr(V, "LISTED_TERMS", 0)
    for sent in (0, 20):
        monkeypatch.setattr(V, "SENT_TERMS", sent)
        enc = V.fit_one_hot(fit, ["lemma", "n"])
        assert of(enc.transform(x)) == of(enc.transform(x, names)) == want
        assert {r.i: list(r.ids) for r in enc.numbers(score, names).collect()} == ids
        assert "vocabulary" not in vars(enc) and enc.size == listed.size == 11
    plan = enc.transform(x, names)._jdf.queryExecution().executedPlan().toString()
    assert F.col and "BroadcastHashJoin" in plan


def test_vectors_are_sent_in_pieces_or_meet_the_rows(spark, monkeypatch):
    """Rows with vectors are not shuffled while the vectors can be sent."""
    emb = spark.createDataFrame([(f"w{i}", [float(i), -float(i)]) for i in range(50)] + [(None, [9.0, 9.0])], "word string, embedding array<float>")
    df = spark.createDataFrame([(i, f"w{i % 70}" if i % 9 else None, f"w{(i * 7) % 60}", "w3") for i in range(300)], "i int, lemma string, prev string, next string")
    results = []
    for sent, piece in ((1 << 20, 1 << 20), (1 << 20, 600), (0, 1)):
        monkeypatch.setattr(V, "SENT", sent)
        monkeypatch.setattr(V, "SENT_PIECE", piece)
        out = V.embed_context(df, emb, ["lemma", "prev", "next"], 2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sent == 0 or "hashpartitioning" not in plan
        results.append(sorted((r.i, list(r.dense)) for r in out.collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) == 300


def test_terms_are_found_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None), ("a", 1, "x"), ("b", 1, "x=y")], "lemma string, n int, tag string")
    df.write.parquet(str(tmp_path / "rows"))
    terms = V.distinct_terms(spark.read.parquet(str(tmp_path / "rows")), ["lemma", "n", "tag"])
    assert sorted(r.term for r in terms.collect()) == ["lemma=a", "lemma=b", "n=1", "n=2", "tag=<none>", "tag=x", "tag=x=y"]
    assert terms._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_combined_vectors_are_those_of_the_assembler(spark):
    """Sparse and dense ones, zeros and a negative zero among the entries; no
    function runs row by row."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors
    for size, width in ((50, 3), (4, 3), (2, 30)):
        rows = [(i, Vectors.sparse(size, sorted({i % size, (i * 3) % size}), [1.0] * len({i % size, (i * 3) % size})) if i % 4 else Vectors.dense([0.0, 2.0] * (size // 2)),
                 [float(i * j % 3) if j % 2 else -0.0 for j in range(width)]) for i in range(30)]
        df = spark.createDataFrame(rows, ["i", "onehot", "dense"]).withColumn("dense", V.F.col("dense").cast("array<float>"))
        for onehot in ("onehot", None):
            parts = [onehot] if onehot else []
            want = VectorAssembler(inputCols=[*parts, "_d"], outputCol="x").transform(df.withColumn("_d", array_to_vector("dense")))
            out = V.combine(df, onehot, "dense", "x")
            assert out.columns == ["i", "onehot", "dense", "x"] and "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
            assert {r.i: repr(r.x) for r in out.collect()} == {r.i: repr(r.x) for r in want.select("i", "x").collect()}
        assert V.combine(df, keep=["i"]).columns == ["i", "features"]
