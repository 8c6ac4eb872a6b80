"""Corpus pipeline: documents to token files, one operator a stage.

``STAGES`` are applied in order; every stage takes the session, the documents
that its predecessor kept and the folder of the tables, and its result is
written as Parquet and read again before the next one.  All but the last
return the columns of documents:

1. quality rules: documents that fail the base rule or are depleted by line
   frequency go, frequent lines are taken out of the others;
2. near-dedup: one document of each class of near copies stays;
3. decontamination: documents with a benchmark window go;
4. mixing: documents as often as the weighted mix takes them;
5. token files: the index of the written sequences, one row per document.

Operators define the results for nulls, empty texts, ties and empty tables;
the pipeline adds nothing to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuespark.llm import arrow_tokens, bag_minhash, decontaminate, fair_mix, line_frequency
from cuespark.llm.queries import tokenizer_file
from cuespark.session import materialize
from cuespark.sources.documents import load_table

# SQL has no near-dedup by sampled signatures and no tokenizer: the stages are
# tested against brute force in tests/llm instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_frequency.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, load_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fair_mix.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return arrow_tokens.token_index(docs, tokenizer_file())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_files", token_files)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
