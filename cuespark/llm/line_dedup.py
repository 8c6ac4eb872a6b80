"""Line dedup (7): keep bitmaps from a range-partitioned sort of line hashes.

Every line's key (stripped of white space at both ends, A-Z lower-cased) is
hashed to 128 bits.  The rows (hash, document, position) are range-partitioned
by hash and sorted by hash, document and position inside a partition, and each
run of a hash is streamed: its first row names the smallest document, all rows
of other documents are dropped.  Text never takes part; the result is one
sparse bitmap per document (64 lines a word, words without a dropped line are
left out), applied to the texts afterwards.

A hash with more than 1/``HOT_SHARE`` of all rows would be one task's run: of
these (fewer than ``HOT_SHARE``, so they are broadcast) the smallest document
comes from a pre-aggregated minimum, and their rows are dealt out by position.

DataFrame functions only.  Defined results: a null or empty text is one empty
line; a null id is smaller than any other; rows with the same id and text are
one document, as are rows with the same id and other text, so that no line is
dropped between them; empty tables give empty results; only the id and text
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .lines import ascii_lower, hold, strip_space, text_lines

MIN_CHARS = 10
HOT_SHARE = 2000
SALTS = 64


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``_h1, _h2`` (hash of the key), ``_d`` (document), ``_t`` (hash of its
    text), ``_at`` (line number) of every line with a key long enough."""
    t = _text(F.col(text))
    rows = hold(docs.select(F.col(doc_id).alias("_d"), t.alias("_s")), ["_d"], _t=F.xxhash64("_s"), _lines=text_lines(F.col("_s")))
    rows = rows.select("_d", "_t", F.posexplode("_lines").alias("_at", "_line"))  # hashed once, not per line
    rows = rows.select("_d", "_t", "_at", strip_space(F.col("_line")).alias("_key")).where(F.length("_key") >= min_chars)
    rows = rows.select("_d", "_t", "_at", ascii_lower(F.col("_key")).alias("_key"))
    return rows.select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"), "_d", "_t", "_at")


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``_d, _t`` and ``dropped``, a map from word number to the 64 bits of
    its dropped lines, of every document that loses a line."""
    spark = docs.sparkSession
    keys = materialize(line_keys(docs, doc_id, text, min_chars), "line-keys")
    most = max(1, keys.count() // HOT_SHARE)
    hot = (keys.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_d")).alias("_least"))
           .where(F.col("_n") > most).select("_h1", "_h2", "_least"))
    dealt = keys.join(F.broadcast(hot), ["_h1", "_h2"], "left")
    dealt = dealt.withColumn("_salt", F.when(F.col("_least").isNull(), 0).otherwise(F.pmod(F.xxhash64("_d", "_at"), F.lit(SALTS))).cast("int"))
    dealt = dealt.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_h1", "_h2", "_salt")
    run = Window.partitionBy("_h1", "_h2", "_salt").orderBy("_d", "_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.coalesce("_least", F.first(F.struct("_d")).over(run))["_d"]
    gone = dealt.withColumn("_first", first).where(~F.col("_d").eqNullSafe(F.col("_first")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_at", F.lit(64)).cast("int"))
    words = gone.groupBy("_d", "_t", F.expr("_at div 64").cast("int").alias("_w")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy("_d", "_t").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_bits"))).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Struct ``row`` of every document row, ``n_lines``, ``n_dropped`` and
    its ``kept_text``."""
    t = _text(F.col(text))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("_i"), F.xxhash64(t).alias("_x"), text_lines(t).alias("_lines"))
    rows = rows.join(bitmaps, F.col("_i").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_t")), "left").drop("_i", "_x", "_d", "_t")
    words = F.when(F.col("dropped").isNotNull(), F.transform(F.sequence(F.lit(0), F.expr("(size(_lines) - 1) div 64").cast("int")),
                                                             lambda w: F.coalesce(F.element_at("dropped", w), F.lit(0).cast("long"))))
    rows = rows.select("row", "_lines", F.explode(F.array(F.struct(words.alias("w")))).alias("_b"))
    kept = F.filter("_lines", lambda line, i: F.getbit(F.get(F.col("_b")["w"], F.call_function("shiftright", i, F.lit(6))), F.pmod(i, F.lit(64))) == 0)
    kept = F.when(F.col("_b")["w"].isNull(), F.col("_lines")).otherwise(kept)
    rows = rows.select("row", F.size("_lines").cast("long").alias("n_lines"), F.explode(F.array(kept)).alias("_kept"))
    return rows.select("row", "n_lines", (F.col("n_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
                       F.array_join("_kept", "\n").alias("kept_text"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """All documents, the text reduced to its kept lines (null stays null)."""
    rows = apply_bitmaps(docs, keep_bitmaps(docs, doc_id, text, **options), doc_id, text)
    new = F.when(F.col("row")[text].isNotNull(), F.col("kept_text"))
    return rows.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document row: line counts and the digest of the kept text."""
    docs = docs.select(doc_id, text)
    rows = apply_bitmaps(docs, keep_bitmaps(docs, doc_id, text, **options), doc_id, text)
    return rows.select(F.col("row")[doc_id].alias(doc_id), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
