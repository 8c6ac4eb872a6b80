"""End-to-end plans on the smallest given tables: the two context paths
agree, the driver contract holds, and a few queries match DuckDB."""

import duckdb

import __spark_entry__ as E
from cuespark.plans import relations as R
from cuespark.sources.documents import TABLES

SF = "/root/testdata/sf0.001"


def test_document_and_block_paths_agree(spark):
    a = R.features(spark, SF)
    b = R.features_from_tokens(R.tokens(spark, SF), R.TEST_ONE_WORD_CUES, R.TEST_MULTI_WORD_CUES)
    cols = R.FEATURE_COLUMNS
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns[0] == "lang" and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_selected_queries_match_duckdb(spark):
    con = _duck()
    for name in ("flags_by_lang", "classification_report", "sentences", "corpus_position"):
        got = sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                     for r in E.queries()[name](spark, SF).collect())
        rel = con.sql(E.oracle_sql()[name])
        exp = sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                     for r in rel.fetchall())
        assert got == exp, name


def test_feature_table_makes_token_rows_once(spark):
    """Substring counts meet the texts, not the token rows: no second branch
    of token rows for those with an affix, and one set of type counts."""
    docs = spark.createDataFrame([(1, "en", "unless unhappy in. Careless"), (1, "en", "unhappy happy"), (None, "en", "unless unhappy in. Careless"),
                                  (2, "en", None), (3, "de", ""), (4, "de", "less un un unhappy . . x")], "doc_id long, lang string, text string")
    out = R.features_from_documents(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Generate posexplode") == 3  # the rows, and the types read twice (one exchange)
    tok = R.annotate_rules(R.tokenize(docs.where("doc_id != 1"), keep=("doc_id", "lang")))
    one = R.features_from_documents(docs.where("doc_id != 1"))
    two = R.features_from_tokens(tok)
    cols = R.FEATURE_COLUMNS
    assert sorted(map(tuple, one.select(*cols).collect())) == sorted(map(tuple, two.select(*cols).collect()))
    got = sorted((r.token, r.sbs_count) for r in out.where("sbs_count > 0").collect())
    assert [t for t, _ in got] == ["careless"] * 2 + ["unhappy"] * 4 + ["unless"] * 2 and len({n for t, n in got if t == "unhappy"}) == 1
