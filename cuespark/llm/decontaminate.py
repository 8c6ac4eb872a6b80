"""Benchmark decontamination (3): windows of normalised test n-grams against
the token windows of training documents.

Spark cuts the benchmark into pieces of at most ``PIECE`` window positions,
so that a long item is many pieces, and measures them.  The windows of the
pieces are hashed into a set that is broadcast; above ``max_bytes`` of set
memory the pieces are dealt into blocks and the documents are read once for
each block, so no executor ever holds more than one block.  Documents are
scanned in place: no shuffle, and one row's memory at most.  Every hash hit
is verified against the words themselves before it counts.

Defined results: a null or empty text has no words and is clean; a benchmark
item without words has no window; an item whose id is null counts as the item
``''``; repeated document rows give repeated results; an empty table on
either side gives clean documents or no rows.  Only the named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import materialize
from .textblocks import ALNUM_BYTES, Words, byte_table, inside_rows, lower_table, text_blocks, window_hashes

WINDOW = 10
PIECE = 4096           # window positions of a benchmark piece
MAX_BYTES = 64 << 20   # memory of the window set of one broadcast block
WORD_BYTES = 32        # what the set holds for a word beside its text
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class WindowSet:
    """Windows of benchmark pieces ``(item, window length, words joined by a
    space)`` as flat arrays.  ``text`` holds all words, one byte between two;
    ``start`` is the first byte of each.  Per window length: the sorted
    hashes, the first word of a window with that hash, its items, and a bit
    table that answers most look-ups.  ``rare`` has windows whose hash
    another window got first."""

    def __init__(self, pieces):
        table = byte_table(ALNUM_BYTES)
        index: dict[str, int] = {}
        known: dict[bytes, int] = {}
        texts, starts, ids, parts = [], [], [], {}
        at = size = 0
        for item, n, said in pieces:
            raw = said.encode()
            w = Words(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), table)
            h = window_hashes(w.hashes(), n)
            where = np.arange(at, at + len(h), dtype=np.int32)
            parts.setdefault(n, []).append((h, where, np.full(len(h), index.setdefault(item, len(index)), np.int32)))
            texts.append(raw)
            starts.append((size + w.start).astype(np.int32))
            ids.append(np.array([known.setdefault(x, len(known)) for x in raw.split(b" ")], np.int32))
            at, size = at + len(w), size + len(raw) + 1
        self.names = list(index)
        self.text = b" ".join(texts)
        self.start = np.concatenate([*starts, [size]]).astype(np.int32)
        self.rare: dict[bytes, set[int]] = {}
        words = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.by_length = {n: self._sorted(n, *map(np.concatenate, zip(*p)), words) for n, p in parts.items()}

    def said(self, at: int, n: int) -> bytes:
        return self.text[self.start[at]: self.start[at + n] - 1]

    def _sorted(self, n, h, at, item, words):
        order = np.lexsort((item, h))
        h, at, item = h[order], at[order], item[order]
        new = np.append(True, h[1:] != h[:-1])
        lead, same = at[np.flatnonzero(new)[np.cumsum(new) - 1]], np.ones(len(h), dtype=bool)
        for j in range(n):
            same &= words[at + j] == words[lead + j]
        for i in np.flatnonzero(~same).tolist():
            self.rare.setdefault(self.said(at[i], n), set()).add(int(item[i]))
        h, at, item = h[same], at[same], item[same]
        once = np.append(True, (h[1:] != h[:-1]) | (item[1:] != item[:-1]))
        h, at, item = h[once], at[once], item[once]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        bits = max(12, math.ceil(math.log2(len(first) * 32)))
        mask, u = np.uint64((1 << bits) - 1), h[first]
        seen = np.zeros(1 << (bits - 3), dtype=np.uint8)
        np.bitwise_or.at(seen, (u & mask) >> np.uint64(3), _BIT[u & np.uint64(7)])
        return u, at[first], np.append(first, len(item)).astype(np.int32), item, seen, mask

    def items(self, n: int, at: int, said: bytes):
        """Items of the window ``said`` whose hash is the ``at``-th."""
        _, lead, first, item, _, _ = self.by_length[n]
        if self.said(lead[at], n) == said:
            return item[first[at]: first[at + 1]].tolist()
        return self.rare.get(said, ())

    @property
    def nbytes(self) -> int:
        arrays = [x for t in self.by_length.values() for x in t]
        return len(self.text) + self.start.nbytes + sum(x.nbytes for x in arrays)


_BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


def scan_block(data, offsets, windows: WindowSet, table, lower):
    """For the rows of one block: word counts, and ``{row: (hit word
    positions, items)}`` for the rows with a verified window."""
    data = lower[data]
    w = Words(data, offsets, table)
    counts = np.diff(w.row_start)
    hits: dict[int, tuple[set, set]] = {}
    if not len(w):
        return counts, hits
    h, raw = w.hashes(), data.tobytes()
    for n, (known, _, _, _, seen, mask) in windows.by_length.items():
        x = window_hashes(h, n)
        at = np.flatnonzero(seen[(x & mask) >> np.uint64(3)] & _BIT[x & np.uint64(7)])
        at = at[inside_rows(w.row_start, n, len(x))[at]] if len(at) else at
        if len(at):
            p = np.minimum(np.searchsorted(known, x[at]), len(known) - 1)
            at, p = at[known[p] == x[at]], p[known[p] == x[at]]
        if not len(at):
            continue
        rows = np.searchsorted(w.row_start, at, side="right") - 1
        start, end = w.start, w.end
        for i, row, g in zip(at.tolist(), rows.tolist(), p.tolist()):
            said = b" ".join([raw[a:b] for a, b in zip(start[i: i + n], end[i: i + n])])
            if items := windows.items(n, g, said):
                first = int(w.row_start[row])
                words, named = hits.setdefault(row, (set(), set()))
                words.update(range(i - first, i - first + n))
                named.update(items)
    return counts, hits


def _scanner(windows, text: str, keep: list[str], found: bool):
    """mapInArrow function over ``row`` structs: the ``keep`` fields of the
    row, ``n_words``, ``hit_words`` and ``items``; ``found``: add to the hits
    and items of an earlier block."""

    def run(batches):
        ws, table, lower = windows.value, byte_table(ALNUM_BYTES), lower_table()
        for batch in batches:
            n_words, words, items = [], [], []
            row = batch.column("row")
            for first, rows, data, offsets in text_blocks(pc.struct_field(row, text)):
                counts, hits = scan_block(data, offsets, ws, table, lower)
                n_words.append(counts)
                for r in range(rows):
                    at, named = hits.get(r, ((), ()))
                    words.append(sorted(at))
                    items.append([ws.names[i] for i in sorted(named)])
            if found:
                words = [sorted({*a, *b}) for a, b in zip(batch.column("hit_words").to_pylist(), words)]
                items = [a + b for a, b in zip(batch.column("items").to_pylist(), items)]
            kept = pa.StructArray.from_arrays([pc.struct_field(row, c) for c in keep], names=keep)
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                 pa.array(words, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                names=["row", "n_words", "hit_words", "items"])

    return run


def pieces(benchmark: DataFrame, item: str = "item_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """``item`` (id as a string), ``n`` (words of its windows) and ``said``:
    the item's words, joined by a space, in pieces that share ``n - 1`` words,
    so that every window lies in one piece."""
    words = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(WORD), F.lit(0))
    # the Generate keeps the words from being extracted again for each piece
    b = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.inline(F.array(F.struct(words.alias("w")))))
    size = F.size("w")
    first = F.sequence(F.lit(0), F.greatest(size - k, F.lit(0)), F.lit(PIECE))
    cut = F.transform(first, lambda i: F.struct(F.array_join(F.slice("w", i + 1, PIECE + k - 1), " ").alias("said")))
    return b.where(size > 0).select("item", F.least(size, F.lit(k)).alias("n"), F.inline(cut)).distinct()


def scan(docs: DataFrame, benchmark: DataFrame, keep=("doc_id",), text: str = "text", item: str = "item_id",
         item_text: str = "text", k: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) of every document row with
    ``n_words``, ``hit_words`` (positions of words inside an occurrence of a
    window) and ``items`` (ids, as strings, of the items with an occurring
    window)."""
    spark, keep = docs.sparkSession, list(keep)
    bench = pieces(benchmark, item, item_text, k)
    held = F.octet_length("said") + F.octet_length("item") + WORD_BYTES * (1 + F.length("said") - F.length(F.replace("said", F.lit(" "))))
    size = bench.agg(F.coalesce(F.sum(held), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / max_bytes))
    bench = bench.withColumn("block", F.pmod(F.xxhash64("item", "said"), F.lit(blocks)))
    if blocks > 1:
        bench = materialize(bench, "benchmark-pieces")
    read = list(dict.fromkeys([*keep, text]))
    state = docs.select(F.struct(*read).alias("row"))
    for b in range(blocks):
        # a set of at most about max_bytes: one block of the checked total
        block = bench.where(F.col("block") == b).select("item", "n", "said").collect()
        windows = spark.sparkContext.broadcast(WindowSet(map(tuple, block)))
        last = b == blocks - 1
        out = keep if last else read
        schema = StructType([StructField("row", docs.select(F.struct(*out).alias("row")).schema["row"].dataType),
                             StructField("n_words", LongType()), StructField("hit_words", ArrayType(IntegerType())),
                             StructField("items", ArrayType(StringType()))])
        state = state.mapInArrow(_scanner(windows, text, out, b > 0), schema)
        if not last:
            state = materialize(state, "decontaminate")
    return state


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row: counts of words, hit words and items, the
    digest of the item ids, and whether the document is contaminated."""
    items = F.array_sort(F.array_distinct("items"))
    hit = F.size("hit_words").cast("long")
    return scan(docs, benchmark, keep=(doc_id,), **options).select(
        F.col("row")[doc_id].alias(doc_id), "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, columns unchanged."""
    return scan(docs, benchmark, keep=docs.columns, **options).where(F.size("hit_words") == 0).select("row.*")


def _cutter(text: str, names: list[str]):
    def run(batches):
        table, lower = byte_table(ALNUM_BYTES), lower_table()
        for batch in batches:
            row, hit, out = batch.column("row"), batch.column("hit_words").to_pylist(), []
            column = pc.struct_field(row, text)
            for t, at in zip(column.to_pylist(), hit):
                if at:
                    raw = t.encode()
                    data = np.frombuffer(raw, dtype=np.uint8)
                    w = Words(lower[data], np.array([0, len(data)]), table)
                    parts, done = [], 0
                    for r in np.split(np.array(at), np.flatnonzero(np.diff(at) > 1) + 1):
                        parts.append(raw[done: w.start[r[0]]])
                        done = int(w.end[r[-1]])
                    t = b"".join([*parts, raw[done:]]).decode()
                out.append(t)
            cols = [pa.array(out, column.type) if c == text else pc.struct_field(row, c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, with every benchmark span (from the first to the last
    of consecutive hit words) cut out of the text; other columns unchanged."""
    s = scan(docs, benchmark, keep=docs.columns, text=text, **options)
    return s.mapInArrow(_cutter(text, docs.columns), docs.schema)
