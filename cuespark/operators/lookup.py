"""Values of rows looked up in a table that is too large to send to the tasks.

Joined column by column, such a table costs a shuffle of the whole rows for
each column.  Here rows stay together as chunks: a chunk is one row with its
distinct strings (``_words``) and its columns as small numbers in one compressed
block.  Chunks are written once; their words meet the table, what is found
comes back as one list a chunk, and the chunk's rows are made again beside it.
A word moves once for each chunk that holds it, a row a few bytes, however many
columns are looked up.  ``join_chunks`` joins rows by position in the same way:
the chunks' blocks of positions meet the blocks of the other side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .context import _BLK, BLOCK
from .packing import SEPARATOR, packed_blocks
from .sentences import MISSING

CHUNK = 1 << 17  # rows of a chunk
_ID = ("_part", "_seq")


def _strings(col: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values of a column as strings and each row's place in them, -1
    for null."""
    d = col.dictionary_encode()
    values = d.dictionary if pa.types.is_string(d.dictionary.type) else d.dictionary.cast(pa.string())
    return values, np.asarray(pc.fill_null(d.indices, -1)).astype(np.int64)


def _places(words: pa.Array, values: pa.Array, at: np.ndarray, null: int) -> np.ndarray:
    """Each row's place in ``words``; ``null`` for nulls."""
    of = np.append(np.asarray(pc.index_in(values, value_set=words)).astype(np.int64), null)
    return of[at]


def _chunk(table: pa.Table, keys: list[str]) -> tuple[list, int, bytes]:
    """The words of the rows, how many of them are keys (these come first), and
    the columns: strings as places in the words plus one, whole numbers as
    differences, others as they are."""
    columns = {n: table.column(n).combine_chunks() for n in table.column_names}
    columns = {n: pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for n, c in columns.items()}
    seen = {n: _strings(c) for n, c in columns.items() if n in keys or pa.types.is_string(c.type)}
    sought = pc.unique(pa.concat_arrays([pa.array([MISSING]), *(seen[n][0] for n in keys)]))
    words = pc.unique(pa.concat_arrays([sought, *(v for v, _ in seen.values())]))
    small = np.uint16 if len(words) < (1 << 16) - 1 else np.int32
    out = {}
    for n, c in columns.items():
        if pa.types.is_string(c.type):
            out[n] = pa.array((_places(words, *seen[n], -1) + 1).astype(small))
        elif pa.types.is_integer(c.type) and c.null_count == 0:
            v = np.asarray(c)
            out[n] = pa.array(np.diff(v, prepend=v.dtype.type(0)))
        else:
            out[n] = c
    sink = pa.BufferOutputStream()
    # which columns were changed, and how, can be told from the types asked for and the nulls
    marks = {n: b"s" if pa.types.is_string(c.type) else b"d" if pa.types.is_integer(c.type) and c.null_count == 0 else b"" for n, c in columns.items()}
    body = pa.table(out).replace_schema_metadata({n.encode(): m for n, m in marks.items()})
    with pa.ipc.new_stream(sink, body.schema) as writer:
        writer.write_table(body.combine_chunks())
    raw = sink.getvalue()
    return words, len(sought), len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def _rows(words: pa.Array, blob: bytes, wanted) -> tuple[dict, dict]:
    """The columns of a chunk (strings only if ``wanted``), and the places of its
    strings in the words."""
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"))
    body = pa.ipc.open_stream(raw).read_all()
    how = body.schema.metadata or {}
    columns, places = {}, {}
    for n in body.column_names:
        c = body.column(n).combine_chunks()
        c = pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c
        if how[n.encode()] == b"s":
            places[n] = np.asarray(c).astype(np.int64) - 1
            if n in wanted:
                columns[n] = words.take(pa.array(places[n], pa.int64(), mask=places[n] < 0))
        elif how[n.encode()] == b"d":
            v = np.asarray(c)
            columns[n] = pa.array(np.cumsum(v, dtype=v.dtype))
        else:
            columns[n] = c
    return columns, places


def look_up(df: DataFrame, keys: dict, table: DataFrame, finish: Callable, added: list[T.StructField], keep=None) -> DataFrame:
    """The rows of ``df``, its columns ``keep`` (None: all), with the columns ``added``.

    ``keys``: column of ``df`` (strings or whole numbers; null: ``MISSING``) ->
    the group in which its value is looked up.  ``table``: ``value``, the number
    of its group ``grp`` and what is found there, numbers; a value is there once
    for each group.  ``finish(place, found)`` runs in the tasks on a chunk and
    returns the columns ``added``: ``found`` has the columns of the table as
    arrays, ``place[column]`` the place in them for each row, -1 for none.
    """
    from ..session import materialize
    sought, columns = list(keys), list(df.columns if keep is None else keep)
    df = df.select(*dict.fromkeys([*columns, *sought]))
    payload = [c for c in table.columns if c not in ("value", "grp")]

    def pack(batches):
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def row():
            words, n_keys, blob = _chunk(pa.Table.from_batches(held), sought)
            lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n_keys], pa.int32()), lists, pa.array([blob], pa.binary())],
                                              names=[*_ID, "_n_keys", "_words", "_blob"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield row()
                seq, held, n = seq + 1, [], 0
        if n:
            yield row()

    # written: both uses of the chunks then see the same rows in them
    chunks = materialize(df.mapInArrow(pack, "_part int, _seq int, _n_keys int, _words array<string>, _blob binary"), "chunks")
    words = chunks.select(*_ID, F.posexplode(F.slice("_words", F.lit(1), F.col("_n_keys"))).alias("_w", "value"))
    hits = table.groupBy("value").agg(F.collect_list(F.struct("grp", *payload)).alias("_hits"))
    found = words.join(hits, "value").groupBy(*_ID).agg(F.collect_list(F.struct("_w", "_hits")).alias("_found"))
    kinds = [table.schema[c].dataType for c in payload]

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(0).slice(i, 1).flatten()
                rows, at = _rows(words, batch.column(1)[i].as_py(), columns)
                got = batch.column(2).slice(i, 1).flatten()
                lists = got.field("_hits") if len(got) else None
                hit = lists.flatten() if lists is not None else None
                w = np.repeat(np.asarray(got.field("_w")), np.asarray(pc.list_value_length(lists))) if hit is not None else np.zeros(0, np.int64)
                grp = np.asarray(hit.field("grp")) if hit is not None else np.zeros(0, np.int64)
                have = {c: np.asarray(hit.field(c)) if hit is not None else np.zeros(0, k) for c, k in zip(payload, numpy_kinds)}
                of, place = {}, {}
                missing = pc.index(words, MISSING).as_py()
                for g in set(keys.values()):
                    of[g] = np.full(len(words), -1, np.int64)
                    mine = np.flatnonzero(grp == g)
                    of[g][w[mine]] = mine
                for c, g in keys.items():
                    p = at[c] if c in at else _places(words, *_strings(rows[c]), -1)
                    place[c] = of[g][np.where(p < 0, missing, p)]
                out = {**rows, **finish(place, have)}
                yield pa.RecordBatch.from_arrays([out[n] for n in (*columns, *(f.name for f in added))], names=[*columns, *(f.name for f in added)])

    numpy_kinds = [np.float64 if isinstance(k, T.FractionalType) else np.int64 for k in kinds]
    together = chunks.join(found, list(_ID), "left").select("_words", "_blob", "_found")
    return together.mapInArrow(unpack, T.StructType([*(df.schema[c] for c in columns), *added]))


def _block_numbers(table: pa.Table, columns) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row, the same for rows equal in ``columns``, and the
    first row of each number."""
    n = np.zeros(table.num_rows, np.int64)
    for c in columns:
        values, at = _strings(table.column(c).combine_chunks())
        n = np.unique(n * (len(values) + 1) + at + 1, return_inverse=True)[1]
    return n, np.unique(n, return_index=True)[1]


def _run_values(runs: pa.Array, i: int, is_text: bool) -> pa.Array:
    """Column ``i`` of all rows of packed runs, run after run."""
    lists = runs.field(f"_a{i}")
    if not is_text:
        return lists.flatten()
    texts = pc.split_pattern(runs.field(f"_j{i}"), SEPARATOR)
    if lists.null_count == len(lists):
        return texts.flatten()
    return pa.concat_arrays([(lists if a else texts).slice(r, 1).flatten() for r, a in enumerate(lists.is_valid().to_pylist())])


def join_chunks(df: DataFrame, ann: DataFrame, keys, differ: tuple[str, str] | None = None) -> DataFrame | None:
    """Inner join of ``df`` (many columns, in chunks) and ``ann`` (few, in packed
    blocks) on ``keys``, the last a position; ``differ``: only rows whose two
    named columns, strings of ``df`` and of ``ann``, differ.

    The rows of a block should lie side by side in ``df``: each chunk gets the
    whole blocks of ``ann`` that it has rows of.  None if they are scattered.
    """
    from ..session import materialize
    *scope, pos = keys
    left, right = list(df.columns), [c for c in ann.columns if c not in keys]
    text = [isinstance(ann.schema[c].dataType, T.StringType) for c in right]
    by = [*scope, _BLK]
    x = df.withColumn(_BLK, F.floor(F.col(pos) / F.lit(BLOCK)).cast("long"))
    kinds = T.StructType([x.schema[c] for c in by])

    def pack(batches):
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def row():
            table = pa.Table.from_batches(held)
            number, first = _block_numbers(table, by)
            blocks = pa.StructArray.from_arrays([table.column(c).combine_chunks().take(pa.array(first)) for c in by], names=by)
            words, _, blob = _chunk(table.select(left).append_column("_k", pa.array(number)), [])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (words, blocks)]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), *lists, pa.array([blob], pa.binary())], names=[*_ID, "_words", "_blocks", "_blob"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield row()
                seq, held, n = seq + 1, [], 0
        if n:
            yield row()

    schema = T.StructType([*(T.StructField(c, T.IntegerType()) for c in _ID), T.StructField("_words", T.ArrayType(T.StringType())),
                           T.StructField("_blocks", T.ArrayType(kinds)), T.StructField("_blob", T.BinaryType())])
    chunks = materialize(x.mapInArrow(pack, schema), "chunks")
    blocks = chunks.select(*_ID, F.posexplode("_blocks").alias("_k", "_b"))
    sent, distinct = blocks.agg(F.count(F.lit(1)), F.count_distinct("_b")).first()
    # in order, only the first and the last block of a chunk are in others too
    if sent > 3 * distinct + 2 * chunks.count():
        return None
    blocks = blocks.select(*_ID, "_k", "_b.*")
    found = (blocks.hint("merge").join(packed_blocks(ann, scope, pos, right), by)
                   .groupBy(*_ID).agg(F.collect_list(F.struct("_k", "_runs")).alias("_found")))

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(0).slice(i, 1).flatten()
                rows, at = _rows(words, batch.column(1)[i].as_py(), ())
                got = batch.column(2).slice(i, 1).flatten()
                lists = got.field("_runs")
                runs = lists.flatten()
                k = np.repeat(np.asarray(got.field("_k")), np.asarray(pc.list_value_length(lists)))
                start, n = np.asarray(runs.field("_start")).astype(np.int64), np.asarray(runs.field("_n"))
                place = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                code = np.repeat(k.astype(np.int64), n) * BLOCK + place % BLOCK
                order = np.argsort(code, kind="stable")
                code = code[order]
                mine = np.asarray(pc.fill_null(rows[pos], 0)).astype(np.int64) % BLOCK + np.asarray(rows["_k"]) * BLOCK
                low = np.searchsorted(code, mine, "left")
                many = np.searchsorted(code, mine, "right") - low
                a = np.repeat(np.arange(len(mine)), many)
                b = order[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())]
                values = [_run_values(runs, j, t) for j, t in enumerate(text)]
                if differ is not None:
                    codes = pa.array(at[differ[0]][a])
                    one = words.take(pc.if_else(pc.less(codes, 0), pa.scalar(None, pa.int64()), codes))
                    on = np.flatnonzero(np.asarray(pc.fill_null(pc.not_equal(one, values[right.index(differ[1])].take(pa.array(b))), False)))
                    a, b = a[on], b[on]
                out = [words.take(pa.array(at[c][a], pa.int64(), mask=at[c][a] < 0)) if c in at else rows[c].take(pa.array(a)) for c in left]
                yield pa.RecordBatch.from_arrays([*out, *(v.take(pa.array(b)) for v in values)], names=[*left, *right])

    both = chunks.hint("merge").join(found, list(_ID)).select("_words", "_blob", "_found")
    return both.mapInArrow(unpack, T.StructType([*df.schema.fields, *(ann.schema[c] for c in right)]))
