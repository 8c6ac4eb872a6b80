"""Target-distribution importance resampling (11).

Documents are drawn without replacement so that their hashed n-grams follow
those of a target collection: a document's weight is the mean log ratio of
target to source frequency of its features, and the highest weights after
adding Gumbel noise (seeded by the document id) are drawn.

Features are found a batch at a time: the texts are joined with a sentinel
byte that UTF-8 never holds, one regex pass finds all words, ``searchsorted``
over the documents' offsets gives each word its document, n-grams whose first
and last word are of different documents are masked out, and a ``bincount``
counts what is left.  The bucket of a feature is the CRC-32 of its UTF-8
bytes modulo ``BUCKETS``.

Steps: one pass writes every document's buckets (2 bytes a feature); a second
one sums them to one row for each task and bucket; the ``BUCKETS`` gains,
integers in thousandths, are the only thing broadcast; a third pass averages
them over each document.  The scores are integers within a range that the
logarithm bounds (some 10^5 values), so their histogram on the driver gives
the lowest score drawn, and only documents from there on are sorted.

Defined results: null and empty texts have no words, weight 0, and are never
drawn (too short); a null id is hashed as the empty string and comes before
others among equal scores; rows of equal score and id are ordered by a hash of
the text, and rows equal in all three are interchangeable; an empty target
gives every feature its source's rarity as gain; an empty table gives no rows.
Only the id and text columns are read (``resample`` returns all columns, which
may have any name).
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.context import running_before
from ..session import materialize

ORDER = 1          # features: runs of 1 to ORDER words
BUCKETS = 10_000
SHARE = 10         # per cent of the eligible documents that are drawn
LEAST_WORDS = 20   # an eligible document has as many words
SEED = 2024
JOINED = 4 << 20   # bytes of text joined at a time

SENTINEL = b"\xff"  # no byte of UTF-8, and no byte of a word
WORD = re.compile(rb"[0-9a-z\x80-\xfe]+")
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# ---- a batch of texts ---------------------------------------------------------

def batch_features(texts: list[bytes], order: int = ORDER, buckets: int = BUCKETS):
    """Bucket and document of each feature of ``texts``, by document, and the
    number of words of each document."""
    joined = SENTINEL.join(texts).translate(LOWER)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, crc = [], []
    for m in WORD.finditer(joined):
        starts.append(m.start())
        crc.append(zlib.crc32(m[0]))
    doc = np.searchsorted(offsets, np.array(starts, np.int64), side="right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    found, docs = [np.array(crc, np.int64)], [doc]
    words = WORD.findall(joined) if order > 1 else []
    for n in range(2, order + 1):
        if len(words) < n:
            break
        crc = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(crc, islice(words, n - 1, None))]
        inside = doc[: len(crc)] == doc[n - 1:]
        found.append(np.array(crc, np.int64)[inside])
        docs.append(doc[: len(inside)][inside])
    doc, bucket = np.concatenate(docs), np.concatenate(found) % buckets
    if order > 1:
        by = np.argsort(doc, kind="stable")
        doc, bucket = doc[by], bucket[by]
    return bucket, doc, n_words


def _texts(column: pa.Array):
    """First row and the UTF-8 of its rows, some ``JOINED`` bytes at a time."""
    first, held, size = 0, [], 0
    for i, text in enumerate(column.cast(pa.large_binary()).to_pylist()):
        held.append(text or b"")
        size += len(held[-1])
        if size >= JOINED:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _featurer(order: int, buckets: int):
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        for batch in batches:
            for first, texts in _texts(batch.column("text")):
                bucket, doc, n_words = batch_features(texts, order, buckets)
                upto = np.searchsorted(doc, np.arange(len(texts) + 1))
                raw = bucket.astype(kind).tobytes()
                cut = (upto * kind.itemsize).tolist()
                columns = [batch.column(c).slice(first, len(texts)) for c in batch.schema.names if c != "text"]
                columns += [pa.array(n_words.astype(np.int64)), pa.array(np.diff(upto)), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in batch.schema.names if c != "text"), "n_words", "n_features", "buckets"])

    return run


def _flat(column: pa.Array, buckets: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2" if buckets <= 1 << 16 else "<u4")


def _counter(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0), buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def _weigher(gains, buckets: int):
    def run(batches):
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            upto = np.concatenate([[0], np.cumsum(gains.value[_flat(batch.column("buckets"), buckets)])])
            ends = np.cumsum(n)
            weight = np.where(n > 0, (upto[ends] - upto[ends - n]) // np.maximum(n, 1), 0)
            names = [c for c in batch.schema.names if c != "buckets"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(weight)], names=[*names, "weight"])

    return run


# ---- plans ---------------------------------------------------------------------

def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, buckets: int = BUCKETS, carry: bool = False) -> DataFrame:
    """``id``, ``tie`` (a hash of the text), ``n_words``, ``n_features`` and
    ``buckets`` (little-endian integers) of every row; with ``carry`` also the
    row itself."""
    row = [F.struct(*docs.columns).alias("row")] if carry else []
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("tie"), *row, F.col(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_featurer(order, buckets), f"{kinds}, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of ``features``."""
    parts = table.select("buckets").mapInArrow(_counter(buckets), "bucket bigint, n bigint")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed frequencies, floored to thousandths."""
    s_all, t_all, b = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + b)) / ((s + 1) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise in floored thousandths, from the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, buckets: int = BUCKETS,
           seed: int = SEED, carry: bool = False) -> DataFrame:
    """``id``, ``tie``, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``seq`` (a number of the row) of every row of ``docs``; written."""
    spark = docs.sparkSession
    table = materialize(features(docs, doc_id, text, order, buckets, carry), "resample-features")
    wanted = features(target.select(F.lit(None).cast("long").alias("id"), F.col(text).alias("text")), "id", "text", order, buckets)
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(table, buckets), bucket_counts(wanted, buckets)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema if f.name != "buckets")
    weighed = table.mapInArrow(_weigher(gains, buckets), f"{kinds}, weight bigint")
    return materialize(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).withColumn("seq", F.monotonically_increasing_id()), "resample-scores")


def ranked(table: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` rows with their ``rank`` among those drawn, else null."""
    eligible = F.col("n_words") >= least_words
    found = table.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()  # one row per integer score
    by = np.argsort(-found["score"].to_numpy())
    score, upto = found["score"].to_numpy()[by], np.cumsum(found["n"].to_numpy()[by])
    take = share * int(upto[-1]) // 100 if len(upto) else 0
    if not take:
        return table.withColumn("rank", F.lit(None).cast("long"))
    cut = int(score[np.searchsorted(upto, take)])
    top = eligible & (F.col("score") >= cut)
    order = F.struct((-F.col("score")).alias("s"), F.col("id"), F.col("tie"), F.col("seq"))
    placed = running_before(table.where(top).withColumn("order", order).withColumn("one", F.lit(1)), "order", "one", "before")
    rank = F.when(F.col("before") < take, F.col("before") + 1).cast("long")
    rest = table.where(~top).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).select(*rest.columns).union(rest)


def report(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """Weight, score and rank of every document."""
    table = ranked(scored(docs, target, doc_id, text, **options), share, least_words)
    return table.select(F.col("id").alias(doc_id), "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The documents drawn; columns unchanged."""
    table = ranked(scored(docs, target, doc_id, text, carry=True, **options), share, least_words)
    return table.where(F.col("rank").isNotNull()).select("row.*")
