"""Token rows packed into runs, so that a shuffle moves few bytes a token.

A run is rows that follow each other with one scope, one block of positions and
positions that count up by one.  It keeps its first position, and each string
column as one joined text (as arrays where a value is null or holds the
separator).  A row of its own costs the shuffle 16 to 19 bytes a token, mostly
keys and offsets; a run little more than the text.  Rows in no order are runs
of one: right, but not smaller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .context import _BLK, BLOCK

SEPARATOR = "\x1f"


def _changes(col) -> np.ndarray:
    """Whether a row's value differs from that of the row before."""
    a, b = col[1:], col[:-1]
    return np.asarray(pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b))))


def _run_starts(batch, n_keys: int) -> np.ndarray:
    """Places of the first rows of runs; the position follows the keys."""
    new = np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        pos = batch.column(n_keys)
        new[1:] = np.asarray(pc.fill_null(pc.not_equal(pos[1:], pc.add(pos[:-1], 1)), True))
        for k in range(n_keys):
            new[1:] |= _changes(batch.column(k))
    return np.flatnonzero(new)


def _joinable(col) -> bool:
    return col.null_count == 0 and not pc.any(pc.match_substring(col, SEPARATOR)).as_py()


def _packed(df: DataFrame, keys, pos: str, cols) -> DataFrame:
    """Runs of ``df``: ``keys``, ``_start``, ``_n`` and the values of ``cols`` as
    one text (``_j0``..) or as arrays (``_a0``..)."""
    x = df.select(*keys, F.col(pos).alias("_start"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    n_keys = len(keys)
    text = [isinstance(x.schema[f"_v{i}"].dataType, T.StringType) for i in range(len(cols))]
    fields = [*x.schema.fields[: n_keys + 1], T.StructField("_n", T.IntegerType())]
    for i, _ in enumerate(cols):
        fields.append(T.StructField(f"_j{i}", T.StringType()))
        fields.append(T.StructField(f"_a{i}", T.ArrayType(x.schema[f"_v{i}"].dataType)))

    def pack(batches):
        for batch in batches:
            first = _run_starts(batch, n_keys)
            ends = np.append(first[1:], batch.num_rows)
            out = [batch.column(k).take(pa.array(first)) for k in range(n_keys + 1)] + [pa.array(ends - first, pa.int32())]
            offsets = pa.array(np.append(first, batch.num_rows), pa.int32())
            for i, is_text in enumerate(text):
                col = batch.column(n_keys + 1 + i)
                lists = pa.ListArray.from_arrays(offsets, col)
                joined = is_text and _joinable(col)
                out.append(pc.binary_join(lists, SEPARATOR) if joined else pa.nulls(len(first), pa.string()))
                out.append(pa.nulls(len(first), lists.type) if joined else lists)
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return x.mapInArrow(lambda batches: pack(b for b in batches if b.num_rows), T.StructType(fields))


def packed_blocks(df: DataFrame, scope, pos: str, cols, block: int = BLOCK) -> DataFrame:
    """``(scope, _blk, _runs)``: a row for each block of positions, its rows as
    runs in no order (``block_rows`` unpacks them), in one shuffle."""
    scope, cols = list(scope), list(cols)
    x = df.select(*scope, F.floor(F.col(pos) / F.lit(block)).cast("long").alias(_BLK), pos, *[c for c in cols if c not in scope and c != pos])
    runs = _packed(x, [*scope, _BLK], pos, cols)
    # dealt out as runs, then grouped where they meet
    return runs.repartition(*scope, _BLK).groupBy(*scope, _BLK).agg(
        F.sum("_n").alias("_rows"), F.collect_list(F.struct(*runs.columns[len(scope) + 1:])).alias("_runs"))


def dealt_runs(df: DataFrame, by, same, pos: str) -> DataFrame:
    """The rows of ``df`` dealt out by ``by``, shuffled as runs of equal ``by``
    and ``same`` (names) whose ``pos`` counts up by one; the columns of ``by``
    and ``same`` come first."""
    keys = [*by, *same]
    cols = [c for c in df.columns if c not in keys and c != pos]
    runs = _packed(df, keys, pos, cols).repartition(*by)
    run = F.struct(*runs.columns[len(keys):])
    return runs.select(*keys, F.inline(_run_rows(run, [df.schema[c].dataType for c in (pos, *cols)], (pos, *cols))))


def _run_rows(r: Column, kinds, names) -> Column:
    """The rows of a run: its positions, then the values of its columns."""
    places = F.transform(F.sequence(F.lit(0), r["_n"] - 1), lambda i: r["_start"] + i)
    values = [F.coalesce(r[f"_a{i}"], F.split(r[f"_j{i}"], SEPARATOR)) if isinstance(k, T.StringType) else r[f"_a{i}"] for i, k in enumerate(kinds[1:])]
    return F.arrays_zip(places, *values).cast(T.ArrayType(T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])))


def block_rows(df: DataFrame, pos: str, cols, runs: str = "_runs") -> Column:
    """The rows ``(_p, cols)`` of a block of ``packed_blocks``, sorted; ``df``:
    the table that ``cols`` come from."""
    kinds = [df.schema[c].dataType for c in (pos, *cols)]
    return F.sort_array(F.flatten(F.transform(F.col(runs), lambda r: _run_rows(r, kinds, ("_p", *cols)))))
