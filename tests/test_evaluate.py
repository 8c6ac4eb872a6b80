"""A8-A14 on hand rows, with the invariants TP+FN = support and
micro-F1 = accuracy."""

from cuespark.operators import evaluate as Ev


def _conf(spark, gold, pred, system="s"):
    df = spark.createDataFrame([(system, g, p) for g, p in zip(gold, pred)], "system string, gold string, pred string")
    return Ev.confusion(df)


def test_prf_example(spark):
    out = {r["class"]: r for r in Ev.prf(_conf(spark, list("BBOO"), list("BOOO"))).collect()}
    assert out["B"].precision == 1.0 and out["B"].recall == 0.5 and abs(out["B"].fscore - 2 / 3) < 1e-12
    assert abs(out["O"].precision - 2 / 3) < 1e-12 and out["O"].recall == 1.0 and abs(out["O"].fscore - 0.8) < 1e-12
    assert abs(out["avg"].recall - 0.75) < 1e-12


def test_true_negative_rules(spark):
    st = {r["class"]: r for r in Ev.pr_stats(_conf(spark, list("BIO"), list("BOI"))).collect()}
    assert (st["B"].tn, st["I"].tn, st["O"].tn) == (0, 1, 1)
    assert (st["B"].tn_full, st["I"].tn_full, st["O"].tn_full) == (2, 1, 1)


def test_unseen_prediction_class_and_zero_division(spark):
    conf = _conf(spark, list("BBOO"), ["X", "B", "O", "O"])
    prf = {r["class"] for r in Ev.prf(conf).collect()}
    assert "X" not in prf
    rep = {r["class"]: r for r in Ev.classification_report(conf).collect()}
    assert rep["X"].precision == 0.0 and rep["X"].support == 0.0
    mat = Ev.confusion_matrix(conf).collect()
    assert sorted(mat[0].asDict().keys()) == ["B", "O", "gold", "system"]


def test_report_invariants(spark):
    gold = list("BBIOOOOIB")
    pred = list("BOIOOIOBB")
    rep = {r["class"]: r for r in Ev.classification_report(_conf(spark, gold, pred)).collect()}
    st = {r["class"]: r for r in Ev.pr_stats(_conf(spark, gold, pred)).collect()}
    for c in "BIO":
        assert st[c].tp + st[c].fn == gold.count(c)
    acc = sum(g == p for g, p in zip(gold, pred)) / len(gold)
    tp = sum(st[c].tp for c in "BIO")
    fp = sum(st[c].fp for c in "BIO")
    fn = sum(st[c].fn for c in "BIO")
    assert abs(rep["accuracy"].f1 - acc) < 1e-12
    assert abs(2 * tp / (2 * tp + fp + fn) - acc) < 1e-12


def test_unpaired_and_errors(spark):
    gold = spark.createDataFrame([(0, i, l) for i, l in enumerate("BOOB")], "doc_id long, tok_id int, label string")
    sysrows = spark.createDataFrame([(0, 0, "s", "B"), (0, 1, "s", "B"), (0, 9, "s", "O")],
                                    "doc_id long, tok_id int, system string, pred string")
    u = Ev.unpaired(gold, sysrows, ["s"]).first()
    assert (u.paired, u.gold_only, u.sys_only) == (2, 2, 1)
    err = Ev.error_rows(gold, sysrows, gold_col="label").collect()
    assert [(r.tok_id, r.predictedlabel) for r in err] == [(1, "B")]
    bio = spark.createDataFrame([(i, l) for i, l in enumerate(["B-NEG", "O", "X", "I-NEG"])], "i int, label string")
    counts = {r.label: r.n for r in Ev.label_counts(bio).collect()}
    assert counts == {"B-NEG": 1, "I-NEG": 1, "O": 2}


def test_unpaired_counts_repeated_null_and_foreign_rows_as_a_full_join(spark):
    gold = [(1, 0), (1, 0), (1, 1), (2, 5000), (None, 3)]
    rows = [(1, 0, "s"), (1, 0, "s"), (1, 0, "t"), (2, 5000, "t"), (2, 7, "s"), (None, 3, "s"), (1, 1, "u"), (9, 9, None)]
    g = spark.createDataFrame(gold, "doc_id long, tok_id int")
    s = spark.createDataFrame(rows, "doc_id long, tok_id int, system string")
    out = Ev.unpaired(g, s, ["s", "t", "v"])
    got = {r.system: (r.paired, r.gold_only, r.sys_only) for r in out.collect()}
    assert got == {"s": (4, 3, 2), "t": (3, 2, 0), "v": (0, 5, 0), "u": (0, 0, 1), None: (0, 0, 1)}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert Ev.unpaired(g.limit(0), s.limit(0), ["s"]).count() == 0


def test_label_pairs_are_not_sent_through_the_driver(spark, tmp_path):
    """Label tables have less than a byte a row: by its bytes any of them is small."""
    rows = spark.range(20000).selectExpr("id AS line", "'O' AS gold_label", "'s' AS system")
    rows.write.parquet(str(tmp_path / "labels"))
    t = spark.read.parquet(str(tmp_path / "labels"))
    pairs = Ev.pair(t, t, keys=("line",), gold_col="gold_label", pred_col="gold_label")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert pairs.count() == 20000
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_error_rows_are_not_sent_through_the_driver(spark, tmp_path):
    docs = spark.createDataFrame([(1, "no a"), (2, None), (None, "no"), (1, "is")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    rows = docs.selectExpr("doc_id", "posexplode(split(text, ' ')) as (tok_id, token)")
    gold = rows.selectExpr("*", "'O' as negcuelabel")
    pred = rows.selectExpr("doc_id", "tok_id", "if(token = 'no', 'B-NEG', 'O') as pred")
    out = Ev.error_rows(gold, pred)
    # position 0 of document 1 is there twice on both sides; a null id meets nothing
    assert sorted(map(tuple, out.collect())) == [(1, 0, "is", "O", "B-NEG"), (1, 0, "no", "O", "B-NEG")]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
