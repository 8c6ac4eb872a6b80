"""TSV round trips with awkward tokens, corpus-scope context, and small
learning runs (fixed data, quality floors instead of exact weights)."""

from pyspark.sql import functions as F

from cuespark.operators import context as C
from cuespark.plans import models as M
from cuespark.plans import tagger as TG
from cuespark.session import scratch_path
from cuespark.sources import conll as IO


def test_token_lines_round_trip(spark):
    rows = [("a", 0, 0, '"', "O"), ("a", 0, 1, "\\", "O"), ("a", 0, 2, ".", "O"), ("a-1", 1, 3, "#x", "B-NEG")]
    df = spark.createDataFrame(rows, IO.token_schema())
    path = scratch_path(spark, "t")
    IO.write_token_lines(df.withColumnRenamed("sentence_id", "sentence_id"), path)
    assert sorted(tuple(r) for r in IO.read_tokens(spark, path).collect()) == sorted(rows)
    assert IO.read_lines_drop_blank(spark, path).count() == 4


def test_feature_table_empty_strings_survive(spark):
    from cuespark.plans.relations import FEATURE_COLUMNS
    vals = {c: "" for c in FEATURE_COLUMNS}
    vals.update(doc_id="x1", sentence_id=0, token_id=0, token="a", punct=0, prefix=0, suffix=0, infix=0,
                sbs_count=0, match_one=0, match_multi=0, negcuelabel="O", prev_tok_cue="0")
    df = spark.createDataFrame([tuple(vals[c] for c in FEATURE_COLUMNS)], IO.feature_schema())
    path = scratch_path(spark, "f")
    IO.write_features(df, path)
    back = IO.read_features(spark, path).first()
    assert back.prev == "" and back.next == "" and back.token == "a"


def test_corpus_scope_neighbours(spark):
    data = [(0, 0, "a"), (0, 1, "b"), (1, 0, "c"), (2, 0, "d"), (2, 1, "e")]
    df = spark.createDataFrame(data, "doc_id long, tok_id int, token string")
    pos = C.corpus_position(df)
    out = C.ordered_context(pos, {"prev": ("token", -1, ""), "next": ("token", 1, "")}, scope=(), pos="corpus_pos",
                            block=2)
    got = {r.token: (r.prev, r.next) for r in out.collect()}
    assert got == {"a": ("", "b"), "b": ("a", "c"), "c": ("b", "d"), "d": ("c", "e"), "e": ("d", "")}


def _toy(spark, n_docs=30):
    rows = []
    for d in range(n_docs):
        toks = ["it", "is", "no", "good", ".", "the", "cat", "was", "not", "here", "."]
        for i, t in enumerate(toks):
            lab = "B-NEG" if t in ("no", "not") else "O"
            rows.append((d, i, t, t, "NN", lab))
    return spark.createDataFrame(rows, "doc_id long, token_id int, token string, lemma string, pos string, "
                                       "negcuelabel string")


def test_linear_models_learn(spark):
    df = _toy(spark)
    for kind in ("nb", "logreg", "svm"):
        m = M.train(df, ["lemma", "pos"], kind=kind, max_iter=20)
        pred = m.predict(df)
        acc = pred.select(F.avg((F.col("predicted") == F.col("negcuelabel")).cast("double"))).first()[0]
        assert acc == 1.0, kind


def test_missing_features_are_a_value_and_missing_labels_no_class(spark):
    df = _toy(spark).withColumn("pos", F.when(F.col("lemma") != "not", F.col("pos")))
    unlabelled = df.where("lemma = 'not'").withColumn("negcuelabel", F.lit(None).cast("string"))
    terms = [r.feats for r in df.select(M.feature_pairs(["pos"]).alias("feats")).distinct().collect()]
    assert sorted(terms) == [["pos=<none>"], ["pos=NN"]]
    for kind in ("nb", "svm"):
        m = M.train(df.unionByName(unlabelled), ["lemma", "pos"], kind=kind, max_iter=20)
        assert m.labels == ["B-NEG", "O"]
        assert m.predict(df).where("predicted <> negcuelabel or predicted is null").count() == 0, kind


def test_tagger_learns(spark):
    df = _toy(spark, 10)
    m = TG.train_tagger(df, ["lemma"], max_iter=30, l2=0.1)
    pred = m.predict(df).join(df, ["doc_id", "token_id"])
    assert pred.count() == df.count()
    acc = pred.select(F.avg((F.col("predicted") == F.col("negcuelabel")).cast("double"))).first()[0]
    assert acc == 1.0


def _labelled(spark, n_docs=8):
    """Documents of varied sentences; B-NEG after a full stop only, so that
    O -> B-NEG never occurs inside a sentence."""
    import random
    rnd = random.Random(4)
    rows = []
    for d in range(n_docs):
        i = 0
        for s in range(6):
            n = rnd.randint(2, 9)
            for k in range(n):
                tok = "." if k == n - 1 else rnd.choice(["no", "not", "cat", "dog", "runs"]) if k == 0 else rnd.choice(["cat", "dog", "runs", "the"])
                lab = "B-NEG" if k == 0 and tok in ("no", "not") else "O"
                rows.append((f"d{d}", s, i, tok, tok, "NN", lab))
                i += 1
    return spark.createDataFrame(rows, "doc_id string, sentence_id int, token_id int, token string, lemma string, pos string, negcuelabel string").repartition(3)


def test_tagger_results_do_not_depend_on_piece_size(spark):
    df = _labelled(spark)
    fits = [TG.train_tagger(df, ["lemma"], max_iter=20, max_len=n) for n in (4, 1000)]
    import numpy as np
    assert np.isclose(fits[0].loss, fits[1].loss) and np.allclose(fits[0].w, fits[1].w, atol=1e-5)
    paths = [sorted(tuple(r) for r in fits[0].predict(df, max_len=n, carry=["negcuelabel"]).collect()) for n in (3, 1000)]
    assert paths[0] == paths[1] and len(paths[0]) == df.count()


def test_unseen_transitions_stay_zero_across_sentences(spark):
    df = _labelled(spark)
    m = TG.train_tagger(df, ["lemma"], max_iter=20, all_transitions=False)
    _, A, _, _ = TG._unpack(m.w, len(m.vocab), len(m.labels))
    assert A[m.labels.index("O"), m.labels.index("B-NEG")] == 0
    assert A[m.labels.index("B-NEG"), m.labels.index("O")] != 0
    table = {(r.term, r.label): r.weight for r in m.weights(spark).collect()}
    assert len(table) == (len(m.vocab) + len(m.labels) + 2) * len(m.labels)


def test_tagger_cuts_sentences_itself_without_a_sentence_column(spark):
    df = _labelled(spark)
    rows = TG.tagger_sentences(df.drop("sentence_id"), ["lemma"]).collect()
    want = TG.tagger_sentences(df, ["lemma"]).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in rows) == sorted((r.doc_id, tuple(r.ids)) for r in want)


def test_tune_tagger_covers_the_grid(spark):
    got = TG.tune_tagger(_labelled(spark), ["lemma"], n_folds=2, max_iter=5)
    assert sorted(got.all_transitions) == [False, True] and got.macro_f1.between(0, 1).all()


def _varied(spark, n=240):
    """Labels that lemma and tag decide for most rows, with some noise."""
    import random
    rnd, rows = random.Random(12), []
    for i in range(n):
        lemma, pos = rnd.choice(["no", "not", "cat", "dog", "run"]), rnd.choice(["NN", "VB"])
        lab = "B-NEG" if lemma in ("no", "not") and rnd.random() < 0.9 else "I-NEG" if lemma == "run" and pos == "VB" else "O"
        rows.append((f"d{i // 8}", i % 8, lemma, lemma, pos, lab))
    return spark.createDataFrame(rows, "doc_id string, token_id int, token string, lemma string, pos string, negcuelabel string")


def test_weighted_distinct_rows_fit_the_same_model(spark):
    """Fits on equal rows as one weighted row and on single rows agree."""
    import numpy as np
    df = _varied(spark)
    for kind in ("nb", "logreg"):
        m = M.train(df, ["lemma", "pos"], kind=kind)
        rows = m.encoder.transform(df.select(M.feature_pairs(["lemma", "pos"]).alias("feats"), "negcuelabel"))
        x = M._indexed(rows.select(F.col("onehot").alias("x", metadata={}), "negcuelabel", F.lit(1.0).alias("w")), m.labels, "negcuelabel")
        single = M._fit(x.select("x", "y", "w"), kind, None, M.C, 1e-4, 1)
        one, two = (np.array(a.theta.toArray() if kind == "nb" else a.coefficientMatrix.toArray()) for a in (m.model, single))
        assert np.allclose(one, two, atol=1e-3)


def test_tune_svm_scores_every_fold_and_grid_point(spark):
    best, scores = M.tune_svm(_varied(spark), ["lemma", "pos"], cs=(0.1, 1.0), tols=(1e-2, 1e-1), n_folds=3, max_iter=8)
    assert [(c, t, n) for c, t, n, _ in scores] == [(c, t, 3) for c in (0.1, 1.0) for t in (1e-2, 1e-1)]
    assert all(0 < s <= 1 for *_, s in scores) and best.kind == "svm"


def test_embeddings_and_ablation(spark):
    import pytest

    from cuespark.plans import ablation as Ab
    df = _varied(spark).withColumn("prev", F.lit("cat")).withColumn("next", F.lit("")).withColumn("prev_tok_cue", F.lit("0"))
    emb = spark.createDataFrame([("no", [1.0, 0.0]), ("not", [0.9, 0.1]), ("cat", [0.0, 1.0])], "word string, embedding array<float>")
    m = M.train_embeddings(df, emb, 2, ["lemma", "pos"], kind="logreg")
    acc = m.predict(df).select(F.avg((F.col("predicted") == F.col("negcuelabel")).cast("double"))).first()[0]
    assert acc > 0.7
    with pytest.raises(ValueError):
        Ab.ablate(df, df, sets=[["lemma"]], models=("svm_vectors",))
    with pytest.raises(ValueError):
        M.train_embeddings(df, emb, 2, ["lemma"], kind="nb")
    pred = Ab.ablate(df, df, sets=[["lemma"], ["lemma", "prev_tok_cue"], ["lemma"]], models=("nb", "svm_vectors"), emb=emb, dim=2, max_iter=8)
    assert pred.count() == 4 * df.count()
    rep = Ab.score_runs(pred, df).select("feature_set", "uses_gold_context").distinct().collect()
    assert {tuple(r) for r in rep} == {("lemma", False), ("lemma+prev_tok_cue", True)}


def test_labelled_token_file_to_features(spark):
    """Six columns, string ids, label last: the label is lagged, not ruled."""
    from cuespark.operators.annotate import annotate_rules
    from cuespark.plans import relations as R
    rows = [("x-1", 0, i, t, "_", lab) for i, (t, lab) in enumerate([("He", "O"), ("is", "O"), ("not", "B-NEG"), ("here", "O"), (".", "O")])]
    path, out = scratch_path(spark, "raw"), scratch_path(spark, "feat")
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, token_id int, token string, c4 string, label string")
    IO.write_token_lines(df, path, df.columns)
    tok = annotate_rules(IO.read_tokens(spark, path)).withColumnRenamed("token_id", "tok_id").drop("sentence_id")
    IO.write_features(R.features_from_tokens(tok, label_rule=None), out)
    got = {r.token_id: r for r in IO.read_features(spark, out).collect()}
    assert got[0].doc_id == "x-1" and got[0].prev_tok_cue == "0" and got[3].prev_tok_cue == "B-NEG" and got[2].negcuelabel == "B-NEG"
    labels = IO.read_labels(spark, out)
    assert labels.columns == ["doc_id", "token_id", "negcuelabel"] and labels.where("negcuelabel = 'B-NEG'").count() == 1


def test_plain_system_files(spark, tmp_path):
    head = "doc_id\ttoken_id\ttoken\tpredicted\n"
    (tmp_path / "run_sys_a.txt").write_text(head + "x\t0\tno\tB-NEG\n")
    (tmp_path / "run_b.txt").write_text(head + "x\t0\t\"\tO\n")
    (tmp_path / "other.txt").write_text(head + "x\t0\tno\tO\n")
    got = IO.read_system_files(spark, str(tmp_path), "run").collect()
    assert {(r.system, r.token, r.predicted) for r in got} == {("run-sys-a", "no", "B-NEG"), ("run-b", '"', "O")}


def test_join_annotations_check_counts(spark):
    import pytest

    from cuespark.operators.annotate import join_annotations
    tok = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "doc_id long, tok_id int, token string")
    ann = spark.createDataFrame([(1, 0, "a", "NN")], "doc_id long, tok_id int, lemma string, pos string")
    with pytest.raises(ValueError):
        join_annotations(tok, ann, check=True)


def test_code_travels_with_the_job():
    """Functions of the package are pickled by value."""
    from pyspark import cloudpickle

    raw = cloudpickle.dumps(TG._pad)
    assert b"cuespark.plans.tagger" not in raw.split(b"_pad")[0][:40] and len(raw) > 500


def test_short_headers_name_the_last_fields(spark, tmp_path):
    """A prediction table with 14 names and 18 fields: the last name is the prediction."""
    import pytest
    names = [f"n{i}" for i in range(13)] + ["negcuelabel"]
    rows = [[f"v{i}" for i in range(17)] + [lab] for lab in ("B-NEG", "O")]
    text = "\n".join("\t".join(r) for r in [names, *rows]) + "\n"
    (tmp_path / "run_a.txt").write_text(text)
    path = str(tmp_path / "run_a.txt")
    assert [r.negcuelabel for r in IO.read_named(spark, path).collect()] == ["B-NEG", "O"]
    assert [r.negcuelabel for r in IO.read_labels(spark, path, keys=()).collect()] == ["B-NEG", "O"]
    got = IO.read_system_files(spark, str(tmp_path), "run").collect()
    assert [(r.n0, r._0, r.negcuelabel) for r in got] == [("v4", "v0", "B-NEG"), ("v4", "v0", "O")]
    (tmp_path / "long.txt").write_text("a\tb\tc\n1\t2\n")
    with pytest.raises(ValueError, match="3 names"):
        IO.read_named(spark, str(tmp_path / "long.txt"))


def test_tables_without_keys_are_paired_by_position(spark, tmp_path):
    from cuespark.operators import evaluate as Ev
    labels = [f"L{i % 7}" for i in range(5000)]
    (tmp_path / "gold.txt").write_text("negcuelabel\n" + "\n".join(f"{x}\n" if i % 9 == 0 else x for i, x in enumerate(labels)) + "\n")
    (tmp_path / "run_x.txt").write_text("a\tnegcuelabel\n" + "\n".join(f"{i}\t0\t{x}" for i, x in enumerate(labels[:4000])) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)  # many splits of a file
    try:
        gold = IO.read_label_lines(spark, str(tmp_path / "gold.txt"))
        assert [tuple(r) for r in gold.orderBy("line").collect()] == list(enumerate(labels))
        runs = IO.read_system_lines(spark, str(tmp_path), "run")
        assert [tuple(r) for r in runs.orderBy("line").collect()] == [("run-x", i, x) for i, x in enumerate(labels[:4000])]
        pairs = Ev.pair(gold, runs, keys=("line",), gold_col="negcuelabel", pred_col="negcuelabel")
        assert pairs.count() == 4000 and pairs.where("gold != pred").count() == 0
        assert tuple(Ev.unpaired(gold, runs, ["run-x"], keys=("line",)).first()) == ("run-x", 4000, 1000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_naive_bayes_keeps_its_terms_off_the_driver(spark, monkeypatch):
    """No vocabulary is collected or encoded; scores are those of the counts,
    unknown values add nothing and equal scores go to the first class."""
    import math
    monkeypatch.setattr(M, "fit_one_hot", None)
    df = _varied(spark)
    names = ["lemma", "pos"]
    rows = [r.asDict() for r in df.collect()]
    m = M.train(df, names, kind="nb")
    new = df.limit(1).selectExpr("'new' doc_id", "token_id", "token", "'unheard' lemma", "'of' pos", "negcuelabel")
    got = {(r.doc_id, r.token_id): r.predicted for r in m.predict(df.unionByName(new)).collect()}
    terms = {(n, r[n]) for r in rows for n in names}

    def weight(term, label):
        rest = [r for r in rows if r["negcuelabel"] != label]
        return math.log(len(rest) * len(names) + len(terms)) - math.log(sum(r[term[0]] == term[1] for r in rest) + 1)

    for r in rows:
        score = {c: sum(weight((n, r[n]), c) for n in names) for c in m.labels}
        assert score[got[r["doc_id"], r["token_id"]]] >= max(score.values()) - 1e-9
    assert got["new", rows[0]["token_id"]] == m.labels[0] and len(got) == len(rows) + 1
    assert [r[0] for r in m.counts.groupBy("name", "value").count().select("count").collect()] == [1] * len(terms)
