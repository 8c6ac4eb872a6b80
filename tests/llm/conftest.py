import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make
