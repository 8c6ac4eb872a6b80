"""Word vectors and one-hot encoding.

The vectors are written once and measured; up to a bound they are sent to the
tasks, in pieces, so that token rows with their vectors are never shuffled.
Beyond it those of the distinct words that occur meet the rows by a join that is
left to AQE.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .lookup import look_up
from .sentences import feature_pairs, feature_value


def vectors_by_frequency(tokens: DataFrame, vectors: DataFrame, token: str = "token",
                         vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """S6 for the test tables: ``(word, vec_id, embedding)`` where the word of
    frequency rank r (count desc, word asc) gets vector ``vec_id = r``.

    Words are ranked with a distributed sort (no single-partition window,
    no limit); the inner join with the vector table keeps the ranks that
    have a vector.
    """
    counts = tokens.groupBy(F.col(token).alias("word")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = rank_sorted(counts, [F.desc("_n"), F.asc("word")], name=vec_id).select("word", vec_id)
    return ranked.join(vectors.select(vec_id, vec), on=vec_id, how="inner").select("word", vec_id, vec)


def read_vector_table(spark, path: str, fmt: str = "parquet", word: str = "word", vec: str = "embedding") -> DataFrame:
    """A word -> vector table from parquet ``(word, array<float>)`` or a
    text file of ``word v1 v2 ...`` lines."""
    if fmt == "parquet":
        return spark.read.parquet(path).select(F.col(word).alias("word"), F.col(vec).cast("array<float>").alias(vec))
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return lines.select(parts[0].alias("word"),
                        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("float")).alias(vec))


def vector_dim(emb: DataFrame, vec: str = "embedding") -> int:
    """Width of the vectors (one row is read; pass the raw vector table)."""
    row = emb.select(F.size(vec)).first()
    return int(row[0]) if row else 0


def needed_vectors(df: DataFrame, cols, emb: DataFrame, vec: str = "embedding") -> DataFrame:
    """The vectors of the distinct words occurring in ``cols`` (one pass
    over ``df`` and a semi join), typically far smaller than the table."""
    words = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("word")).distinct()
    return emb.join(words, on="word", how="left_semi").select("word", F.col(vec).alias("_v"))


# Vectors up to so many bytes are sent to the tasks, in pieces, and token rows
# stay where they are; more of them meet the rows by a shuffle.
SENT, SENT_PIECE = 256 << 20, 32 << 20


def _looked_up(df: DataFrame, cols, emb: DataFrame, dim: int, vec: str) -> list[DataFrame]:
    """The vectors to join with ``cols`` as one table, or as pieces by the
    hash of the word that are sent to the tasks.  Only if there are more of
    them than are sent are those of the words that occur picked out first."""
    from ..session import materialize
    found, one = materialize(emb.select("word", F.col(vec).alias("_v")), "vectors"), 4 * max(dim, 1) + 64
    if (size := found.count() * one) > SENT:
        found = materialize(needed_vectors(df, cols, found, "_v"), "vectors-needed")
        if (size := found.count() * one) > SENT:
            return [found]
    n = max(1, -(-size // SENT_PIECE))
    return [F.broadcast(found.where(F.pmod(F.xxhash64("word"), F.lit(n)) == i) if n > 1 else found) for i in range(n)]


def embed(df: DataFrame, col: str, emb: DataFrame, dim: int, out: str | None = None,
          vec: str = "embedding", found: list[DataFrame] | None = None) -> DataFrame:
    """Attach the vector of ``col`` (zeros when the word is unknown).
    ``found``: the vectors as tables ``(word, _v)`` that share no word."""
    out = out or f"{col}_vec"
    found = _looked_up(df, [col], emb, dim, vec) if found is None else found
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    x, parts = df, [f"_v{i}_{out}" for i in range(len(found))]
    for name, look in zip(parts, found):
        x = x.join(look.select(F.col("word").alias(col), F.col("_v").alias(name)), on=col, how="left")
    return x.withColumn(out, F.coalesce(*[F.col(p) for p in parts], zeros)).drop(*parts)


def embed_context(df: DataFrame, emb: DataFrame, names, dim: int, out: str = "dense",
                  lemma: str = "lemma", prev: str = "prev", nxt: str = "next") -> DataFrame:
    """Lemma vector, followed by the prev and/or next vector when those
    features are selected.  The vectors are found once for all three columns;
    each column is then a left join against that table, without a shuffle of
    the rows if it can be sent to the tasks."""
    parts = [lemma] + [c for c, n in ((prev, "prev"), (nxt, "next")) if n in names]
    found = _looked_up(df, parts, emb, dim, "embedding")
    x = df
    for c in parts:
        x = embed(x, c, emb, dim, out=f"_e_{c}", found=found)
    return x.withColumn(out, F.concat(*[F.col(f"_e_{c}") for c in parts])).drop(*[f"_e_{c}" for c in parts])


# Terms that a solver can hold: its coefficients are dense vectors on the driver.
MAX_VOCAB = 1 << 24


def vocabulary(df: DataFrame, names, max_size: int = MAX_VOCAB) -> list[str]:
    """M1 vocabulary: every distinct ``name=value`` in sorted order (the
    column order of a dictionary vectoriser).  The list is needed on the
    driver to build the encoder, so its size is checked first."""
    from ..session import materialize
    terms = materialize(distinct_terms(df, names), "terms")
    n = terms.count()
    if n > max_size:
        raise ValueError(f"one-hot vocabulary has {n} terms; the solver's dense coefficients hold {max_size}")
    return [r[0] for r in terms.orderBy("term").collect()]


def vocabulary_table(df: DataFrame, names) -> DataFrame:
    """M1 as a table: ``(term, idx)`` with idx the rank in sorted order."""
    return rank_sorted(distinct_terms(df, names), "term")


def rank_sorted(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """0-based position of each row in ``order`` (a column name or a list of
    sort expressions; ties must not occur), without a single-partition
    window.

    The range-partitioned sort is written once under the shared checkpoint
    folder; part files are numbered in sort order (task, then file of the task)
    and keep row order, so rank = (rows in earlier files) + row index in the file.  The per-file
    counts are one row per file.  Reading fixed files keeps the numbering
    stable when tasks are retried.
    """
    from ..session import materialize
    keys = [order] if isinstance(order, str) else list(order)
    s = materialize(df.orderBy(*keys), "ranked")
    s = s.select("*", F.struct(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("task"),
                          F.regexp_extract(F.col("_metadata.file_name"), r"-c(\d+)\.", 1).cast("int").alias("file")).alias("_part"),
                 F.col("_metadata.row_index").alias("_r"))
    counts = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_part", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"))
    out = s.join(offs, "_part").withColumn(name, (F.col("_off") + F.col("_r")).cast("long"))
    return out.drop("_part", "_r", "_off")


def distinct_terms(df: DataFrame, names) -> DataFrame:
    """Every distinct ``name=value`` term, in one pass over ``df``: values are
    made distinct by feature, the name is prefixed afterwards."""
    names = list(names)
    each = F.array(*[F.struct(F.lit(i).alias("_f"), feature_value(n).alias("_v")) for i, n in enumerate(names)])
    values = df.select(F.inline(each)).distinct()
    prefix = F.get(F.array(*[F.lit(f"{n}=") for n in names]), F.col("_f"))
    return values.select(F.concat(prefix, "_v").alias("term"))


# Terms of a feature that are sent to the tasks.
SENT_TERMS = 20_000
# A vocabulary of up to so many terms is a list in the encoder; a larger one
# stays a table that meets the rows, each feature by itself.
LISTED_TERMS = 100_000


@dataclass
class OneHot:
    """M1: binary one-hot encoder.  ``terms``: ``(term, idx)``, idx the rank in
    sorted order; ``counts``: the terms of each feature.  A row has at most one
    value of a feature; unseen terms are ignored."""
    terms: DataFrame
    counts: dict
    input_col: str = "feats"
    output_col: str = "onehot"

    @property
    def size(self) -> int:
        return sum(self.counts.values())

    @cached_property
    def vocabulary(self) -> list[str]:
        """The terms as a list, for vocabularies that the driver can hold."""
        if self.size > MAX_VOCAB:
            raise ValueError(f"{self.size} terms are more than the driver holds")
        return [r.term for r in self.terms.orderBy("idx").collect()]

    @cached_property
    def _listed(self) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol=self.input_col, outputCol=self.output_col, binary=True)

    def _few(self, names) -> bool:
        return all(self.counts[n] <= SENT_TERMS for n in names)

    def _sent(self, df: DataFrame, term_of: dict, out: str) -> DataFrame:
        """Term numbers, ascending: each feature's terms, few, meet the rows by
        its term (``term_of``) where they are."""
        x, found = df, []
        for name in self._order(term_of):
            look = self.terms.where(F.col("term").startswith(f"{name}=")).select(F.col("term").alias("_term"), F.col("idx").cast("int").alias(f"_i_{name}"))
            x, found = x.join(F.broadcast(look), term_of[name] == F.col("_term"), "left").drop("_term"), [*found, f"_i_{name}"]
        ids = F.array_compact(F.array(*[F.col(c) for c in found])) if found else F.array()
        return x.withColumn(out, ids.cast("array<int>")).drop(*found)

    def _order(self, term_of: dict) -> list:
        # terms are sorted as text: a feature's numbers follow those before it
        return sorted(self.counts.keys() & term_of.keys(), key=lambda n: f"{n}=")

    def _looked_up(self, df: DataFrame, term_of: dict, added: StructField, finish, keep) -> DataFrame:
        """The rows' columns ``keep`` and the column ``added`` that ``finish``
        makes of how many terms each row has and their numbers, ascending, one
        row after the other.  The terms of all features meet the rows together."""
        names = self._order(term_of)
        x = df.select("*", *[term_of[n].alias(f"_t_{n}") for n in names])
        table = self.terms.select(F.col("term").alias("value"), F.lit(0).alias("grp"), "idx")

        def numbers(place, found):
            at = np.stack([place[f"_t_{n}"] for n in names], axis=1)
            ids = found["idx"][at[at >= 0]] if len(found["idx"]) else np.zeros(0, np.int64)
            return {added.name: finish((at >= 0).sum(axis=1), ids.astype(np.int32))}

        return look_up(x, {f"_t_{n}": 0 for n in names}, table, numbers, [added], keep)

    def numbers(self, df: DataFrame, names, out: str = "ids") -> DataFrame:
        """Rows with the term numbers of their features ``names``."""
        if self.size <= LISTED_TERMS:
            x = self._listed.transform(df.withColumn(self.input_col, feature_pairs(names)))
            return x.withColumn(out, F.unwrap_udt(self.output_col)["indices"]).drop(self.input_col, self.output_col)
        term_of = {n: F.concat(F.lit(f"{n}="), feature_value(n)) for n in names}
        if self._few(self._order(term_of)):
            return self._sent(df, term_of, out)
        return self._looked_up(df, term_of, StructField(out, ArrayType(IntegerType())), lambda sizes, ids: _lists(sizes, pa.array(ids)), df.columns)

    def transform(self, df: DataFrame, names=None, keep=None) -> DataFrame:
        """Rows with their sparse vector; ``names``: the features that the
        terms of the input column stand for, in order, if known; ``keep``: the
        columns to return beside the vector (None: all)."""
        keep = df.columns if keep is None else list(keep)
        if self.size <= LISTED_TERMS:
            return self._listed.transform(df).select(*keep, self.output_col)
        feats, size = F.col(self.input_col), self.size
        if names is None:
            term_of = {n: F.get(F.filter(feats, lambda t: t.startswith(f"{n}=")), 0) for n in self.counts}  # noqa: B023 - used at once
        else:
            term_of = {n: F.get(feats, i) for i, n in enumerate(names)}

        if self._few(self._order(term_of)):
            x = self._sent(df, term_of, "_ids")
            entries = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"), F.col("_ids").alias("indices"),
                               F.array_repeat(F.lit(1.0), F.size("_ids")).alias("values"))
            x = x.select(*keep, entries.alias(self.output_col))
            # the entries are a vector's stored form: the same rows under its type
            schema = StructType([StructField(f.name, VectorUDT()) if f.name == self.output_col else f for f in x.schema.fields])
            return x.mapInArrow(lambda batches: batches, schema)

        def vectors(sizes, ids):
            """The stored form of sparse vectors of ones."""
            n = len(sizes)
            parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), _lists(sizes, pa.array(ids)), _lists(sizes, pa.array(np.ones(len(ids))))]
            return pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])

        return self._looked_up(df, term_of, StructField(self.output_col, VectorUDT()), vectors, keep)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def fit_one_hot(df: DataFrame, names, input_col: str = "feats", output_col: str = "onehot", max_vocab: int | None = None) -> OneHot:
    """M1 (fit): binary one-hot encoder over every ``name=value`` term seen
    in ``df``, columns in sorted order of the terms (the ranks of
    ``vocabulary_table``).  The terms are written and only their number for each
    feature comes to the driver; ``max_vocab`` is what a solver can hold."""
    from ..session import materialize
    names = list(dict.fromkeys(names))
    terms = materialize(vocabulary_table(df, names), "terms")
    row = terms.agg(*[F.count(F.when(F.col("term").startswith(f"{n}="), 1)).alias(f"n{i}") for i, n in enumerate(names)]).first()
    enc = OneHot(terms, dict(zip(names, row)), input_col, output_col)
    if max_vocab is not None and enc.size > max_vocab:
        raise ValueError(f"one-hot vocabulary has {enc.size} terms; the solver's dense coefficients hold {max_vocab}")
    return enc


def vector_entries(x) -> tuple:
    """Size, number of non-zero entries and indices (null for a dense one) of
    a vector column, read from its sparse form without expanding it."""
    v = F.unwrap_udt(x)
    return (F.coalesce(v["size"], F.size(v["values"])), F.size(F.array_remove(v["values"], F.lit(0.0))), v["indices"])


def _padded(lists: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Lists as the rows of a matrix, and how long each is."""
    many, flat = np.asarray(pc.list_value_length(lists)).astype(np.int64), np.asarray(lists.flatten()).astype(kind, copy=False)
    width = int(many.max(initial=0))
    if (many == width).all():
        return flat.reshape(len(many), width), many
    out = np.zeros((len(many), width), kind)
    out[np.arange(width) < many[:, None]] = flat
    return out, many


def _assembled(onehot: pa.Array | None, dense: pa.Array) -> pa.Array:
    """The stored form of one-hot vectors followed by dense ones: zeros left
    out, sparse where that takes fewer bytes (as ``Vector.compressed``)."""
    n, size = len(dense), np.zeros(len(dense), np.int64)
    values, places = [], []
    if onehot is not None:
        v, many = _padded(onehot.field("values"), np.float64)
        at = np.broadcast_to(np.arange(v.shape[1], dtype=np.int32), v.shape).copy()
        sparse = np.asarray(onehot.field("type")) == 0
        if sparse.any():
            some, _ = _padded(pc.filter(onehot.field("indices"), pa.array(sparse)), np.int32)
            at[sparse, : some.shape[1]] = some
        size += np.where(sparse, np.asarray(pc.fill_null(onehot.field("size"), 0)), many)
        values, places = [v], [at]
    v, many = _padded(dense, np.float64)
    values.append(v)
    places.append(np.arange(v.shape[1], dtype=np.int32) + size[:, None].astype(np.int32))
    size += many
    values, places = (values[0], places[0]) if len(values) == 1 else (np.hstack(values), np.hstack(places))
    held = values != 0
    nnz = np.count_nonzero(held, axis=1)
    full = ~(1.5 * (nnz + 1.0) < size)
    offsets = lambda sizes: pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    if not full.any():
        lists = [pa.ListArray.from_arrays(offsets(nnz), pa.array(x[held])) for x in (places, values)]
        return pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(size.astype(np.int32)), *lists], names=["type", "size", "indices", "values"])
    many = np.where(full, size, nnz)
    begin = np.cumsum(many) - many
    row, _ = np.nonzero(held)
    rank = np.arange(len(row)) - (np.cumsum(nnz) - nnz)[row]
    out = np.zeros(many.sum())
    out[begin[row] + np.where(full[row], places[held], rank)] = values[held]
    lists = [pa.ListArray.from_arrays(offsets(np.where(full, 0, nnz)), pa.array(places[held][~full[row]]), mask=pa.array(full)), pa.ListArray.from_arrays(offsets(many), pa.array(out))]
    return pa.StructArray.from_arrays([pa.array(full.astype(np.int8)), pa.array(size.astype(np.int32), mask=full), *lists], names=["type", "size", "indices", "values"])


def combine(df: DataFrame, onehot: str | None = "onehot", dense: str = "dense", out: str = "features", keep=None) -> DataFrame:
    """M6: one-hot vector followed by the dense vector (dense alone when
    there is no one-hot feature); ``keep``: the columns to return beside it
    (None: all).  Vectors are assembled batch by batch; a null one is an error."""
    keep = df.columns if keep is None else list(keep)
    x = df.select(*[F.col(c) for c in keep], *([F.unwrap_udt(onehot).alias("_onehot")] if onehot else []), F.col(dense).alias("_dense"))

    def assemble(batches):
        for batch in batches:
            parts = [batch.column("_onehot") if onehot else None, batch.column("_dense")]
            if any(p is not None and (p.null_count or (p is parts[1] and p.flatten().null_count)) for p in parts):
                raise ValueError("a vector to combine is null")
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), _assembled(*parts)], names=[*keep, out])

    return x.mapInArrow(assemble, StructType([*(df.schema[c] for c in keep), StructField(out, VectorUDT())]))
