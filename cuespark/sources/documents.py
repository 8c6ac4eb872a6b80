"""Table loading and S7 tokenisation.

``tokenize`` turns a text column into ordered token rows with one
``posexplode`` over a JVM regex: no Python, no shuffle.  The token position
``tok_id`` is dense (0 .. n-1) inside each document, which the ordered-context
operators rely on.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cues import TOKEN_PATTERN

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables; column pruning and filters reach
    the scan because every plan selects before it computes."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cluster when the scan produced fewer partitions
    than there are task slots (e.g. one large row group).  A scan of many
    files is already split and is returned unchanged, so no shuffle is added
    at scale.  Round-robin (not hashing on a key) so that later block
    windows still get their own (key, block) exchange."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)


def token_array(text_col: str = "text", pattern: str = TOKEN_PATTERN, lowercase: bool = True) -> Column:
    """The tokens of a text in order (null for a null text)."""
    text = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def tokenize(df: DataFrame, text_col: str = "text", keep=("doc_id", "lang"),
             pattern: str = TOKEN_PATTERN, lowercase: bool = True) -> DataFrame:
    """``(keep..., tok_id int, token string)`` for every token of every text.

    Whole texts are tokenised; a document that does not fit a partition still
    produces its rows in one task (a row is atomic), after which every
    operator in this package works on bounded blocks of positions.
    """
    toks = token_array(text_col, pattern, lowercase)
    return (df.select(*keep, F.posexplode(toks).alias("tok_id", "token"))
              .withColumn("tok_id", F.col("tok_id").cast("int")))


def token_counts(df: DataFrame, text_col: str = "text", keep=("doc_id",),
                 pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Number of tokens per text without exploding the rows."""
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(pattern), F.lit(0))
    return df.select(*keep, F.size(toks).cast("long").alias("n_tokens"))


def documents_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tok``: the token relation over the ``documents`` table."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return tokenize(spread(docs))
