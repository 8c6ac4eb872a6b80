"""The stateless token features on a streaming source.

Tokenisation (S7) and the per-token expressions (F1-F10, rule lemma/pos)
need no state, so the same column expressions run on a ``readStream``
DataFrame.  Context windows and corpus counts (W*, A*) need state and are
left to the batch plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.cues import ONE_WORD_CUES
from ..operators.annotate import rule_lemma, rule_pos
from ..sources.documents import tokenize


def token_features(tokens: DataFrame, one_cues=ONE_WORD_CUES) -> DataFrame:
    """Per-token stateless features; works for batch and streaming input."""
    t = F.col("token")
    return tokens.select(
        "doc_id", "tok_id", "token", rule_lemma(t).alias("lemma"), rule_pos(t).alias("pos"),
        T.is_punct(t).alias("punct"), T.has_neg_prefix(t).alias("prefix"), T.has_neg_suffix(t).alias("suffix"),
        T.has_neg_infix(t).alias("infix"), T.match_one(t, one_cues).alias("match_one"),
        T.strip_affix(t).alias("stripped"))


def stream_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    """A streaming scan of document files (new files become new rows);
    ``path`` is a directory or a glob (a single file is given as a glob)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_token_features(spark: SparkSession, source: str, sink: str, checkpoint: str,
                       one_cues=ONE_WORD_CUES, available_now: bool = True):
    """Tokenise and featurise every document file under ``source`` into a
    parquet sink; with ``available_now`` the query processes what exists
    and stops (exactly-once through the checkpoint)."""
    schema = spark.read.parquet(source).select("doc_id", "lang", "text").schema
    docs = stream_documents(spark, source, schema)
    feats = token_features(tokenize(docs.select("doc_id", "lang", "text")), one_cues)
    w = feats.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
