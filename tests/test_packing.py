"""Packed blocks: what token lists, sentences and annotation joins shuffle."""

from pyspark.sql import functions as F

from cuespark.operators import annotate as An
from cuespark.operators import sentences as S
from cuespark.operators.packing import block_rows, packed_blocks

# nulls, the separator, empty tokens, equal positions, null ids, gaps
ODD = [(1, 0, "a"), (1, 1, "b\x1fc"), (1, 2, None), (1, 3, ""), (1, 3, "a"), (1, 7, "."), (None, 0, "x"), (None, 1, "y"), (2, None, "z"), (2, 0, "."), (2, 1, "t")]


def _odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, tok_id int, token string")


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def _exchanged(df):
    """The columns that the plan's shuffles move."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "MapInArrow" in plan and "Exchange" in plan[: plan.index("MapInArrow")]


def test_rows_come_back(spark):
    df = _odd(spark)
    back = packed_blocks(df, ["doc_id"], "tok_id", ["token"], 4).select("doc_id", F.inline(block_rows(df, "tok_id", ["token"])))
    assert _rows(back) == _rows(df)


def test_a_document_in_order_is_one_run(spark):
    df = spark.range(2000, numPartitions=1).select((F.col("id") >= 1500).cast("long").alias("doc_id"),
                                                   F.when(F.col("id") < 1500, F.col("id")).otherwise(F.col("id") - 1500).cast("int").alias("tok_id"), F.lit("w").alias("token"))
    assert sorted((r.doc_id, r._rows, len(r._runs)) for r in packed_blocks(df, ["doc_id"], "tok_id", ["token"]).collect()) == [(0, 1500, 1), (1, 500, 1)]


def test_token_list_shuffles_runs(spark):
    df = _odd(spark)
    out = S.token_list(df, block=4)
    assert _exchanged(out)
    items = F.array_sort(F.collect_list(F.struct("tok_id", "token")))
    plain = df.groupBy("doc_id", F.floor(F.col("tok_id") / 4).cast("int").alias("block")).agg(F.count(F.lit(1)).alias("n_tokens"), items.alias("i"))
    assert _rows(out) == _rows(plain.select("doc_id", "block", "n_tokens", F.col("i")["token"].alias("tokens")))


def test_sentences_over_block_borders_and_pieces(spark):
    """Against a plain walk over the tokens, two of the documents longer than a block."""
    docs = {1: [("." if i % 37 == 36 else f"w{i}") for i in range(9000)], 2: ["w"] * 5000 + ["."] + ["v"] * 10, 3: ["a", "."], 4: ["a"]}
    df = spark.createDataFrame([(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)], "doc_id long, tok_id int, token string").repartition(3, "doc_id")
    for keep in (True, False):
        want = []
        for d, ts in docs.items():
            seq, start = 0, 0
            for end in [i for i, t in enumerate(ts) if t == "."] + ([len(ts)] if keep else []):
                got = list(range(start, min(end + 1, len(ts))))
                want += [(d, seq, p, got[a], len(got[a: a + 100]), [ts[i] for i in got[a: a + 100]]) for p, a in enumerate(range(0, len(got), 100))]
                seq, start = seq + 1, end + 1
        out = S.sentences(df, ["token"], keep, max_len=100)
        assert _exchanged(out)
        assert _rows(out) == sorted(map(repr, want))


def test_annotations_join_as_blocks(spark):
    df = _odd(spark)
    ann = df.where("doc_id <> 1 or tok_id <> 1").select("doc_id", "tok_id", F.upper("token").alias("lemma"))
    for right in (ann, df.select("doc_id", "tok_id", F.upper("token").alias("lemma"))):
        out = An.join_annotations(df, right)
        assert _exchanged(out)
        assert _rows(out) == _rows(df.join(right, ["doc_id", "tok_id"]))


def test_system_predictions_are_written_once(spark, tmp_path):
    """A written row for each token; rows of repeated ids meet as in a join by key."""
    from cuespark.plans import catalog as Q
    from cuespark.plans import relations as R
    docs = spark.createDataFrame([(1, "en", "no the cat ."), (2, "en", "is the"), (2, "en", "was a dog"), (None, "en", "lost")], "doc_id long, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = Q._predictions(spark, str(tmp_path))
    assert spark.read.parquet(*out.inputFiles()).count() == 4 + 2 * 2 + 2 * 2 + 1
    g = R.gold(spark, str(tmp_path)).select("doc_id", F.col("tok_id").alias("token_id"), "sys_a", "sys_b")
    each = F.array(*[F.struct(F.lit(n).alias("system"), F.col(c).alias("predicted")) for n, c in Q.SYSTEMS.items()])
    plain = R.features(spark, str(tmp_path)).join(g, ["doc_id", "token_id"]).select(*R.FEATURE_COLUMNS, F.inline(each))
    assert _rows(out) == _rows(plain)


def test_ordered_context_shuffles_runs(spark):
    """Neighbours, running sums and wrapped edges as without packing, tokens over
    block borders, odd tokens and null ids; positions are not repeated."""
    from cuespark.operators import context as C
    odd = [(1, 0, "a"), (1, 1, "b\x1fc"), (1, 2, None), (1, 3, ""), (1, 4, "."), (None, 0, "x"), (None, 1, "."), (2, 0, "."), (2, 1, "T")]
    long = [(3, i, "." if i % 41 == 0 else f"w{i % 97}") for i in range(9000)]
    df = spark.createDataFrame(odd + long, "doc_id long, tok_id int, token string")
    for f in (lambda p: C.sentence_seq(df, packed=p), lambda p: C.context_tokens(df, packed=p), lambda p: C.context_tokens(df, wrap=True, packed=p),
              lambda p: C.match_multi(df, ["w1 w2", "w1 w2 w3 w4"], packed=p)):
        out, plain = f(True), f(False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and plan.count("hashpartitioning(doc_id") == plain._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(doc_id")
        assert _rows(out.select(*plain.columns)) == _rows(plain)


def test_only_the_labels_of_predictions_are_written_if_asked_for(spark, tmp_path):
    from cuespark.plans import catalog as Q
    docs = spark.createDataFrame([(1, "en", "no the cat ."), (2, "en", "is the"), (None, "en", "lost")], "doc_id long, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    keys = ("doc_id", "token_id", "negcuelabel")
    out = Q._predictions(spark, str(tmp_path), keys)
    assert spark.read.parquet(*out.inputFiles()).columns == [*keys, "sys_a", "sys_b"]
    assert _rows(out) == _rows(Q._predictions(spark, str(tmp_path)).select(*keys, "system", "predicted"))
