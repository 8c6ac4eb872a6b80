"""A6 / A7 and projections: order, tails, bounded pieces."""

from cuespark.operators import sentences as S


def _doc(spark, tokens):
    return spark.createDataFrame([(0, i, t, "O") for i, t in enumerate(tokens)],
                                 "doc_id long, tok_id int, token string, label string")


def test_tail_option(spark):
    df = _doc(spark, ["a", ".", "b"])
    assert S.sentences(df, keep_tail=False).count() == 1
    assert S.sentences(df, keep_tail=True).count() == 2


def test_long_sentence_is_split_into_ordered_pieces(spark):
    toks = [f"w{i}" for i in range(10)] + ["."] + ["x", "y"]
    out = S.sentences(_doc(spark, toks), max_len=4).orderBy("sent_seq", "piece").collect()
    assert [(r.sent_seq, r.piece, r.n_tokens) for r in out] == [(0, 0, 4), (0, 1, 4), (0, 2, 3), (1, 0, 2)]
    assert sum((r.token for r in out), []) == toks


def test_token_list_blocks(spark):
    toks = [f"t{i}" for i in range(9)]
    out = S.token_list(_doc(spark, toks), block=4).orderBy("block").collect()
    assert [len(r.tokens) for r in out] == [4, 4, 1] and sum((r.tokens for r in out), []) == toks


def test_feature_pairs_and_split(spark):
    df = spark.createDataFrame([(0, 1, "a", 1)], "doc_id long, token_id int, lemma string, punct int")
    assert S.features_and_labels(df.withColumn("negcuelabel", df.lemma), ["lemma", "punct"]).first().feats == \
        ["lemma=a", "punct=1"]
    dense, one_hot = S.split_features(["token", "lemma", "prev", "pos"], "train")
    assert dense == ["lemma", "prev"] and one_hot == ["pos"]
    docs = spark.createDataFrame([("d10", "a b"), ("d2", "f g h"), ("d1", ""), ("d11", "c d e")], "doc_id string, text string")
    got = [tuple(r) for r in S.first_n(docs, 4).orderBy("doc_id", "tok_id").select("doc_id", "tok_id", "token").collect()]
    assert got == [("d10", 0, "a"), ("d10", 1, "b"), ("d11", 0, "c"), ("d11", 1, "d")]
