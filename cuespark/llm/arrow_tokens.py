"""Token-ID output (10): equal-length token sequences in Arrow IPC files.

Documents are range-partitioned and sorted by id; every partition becomes one
shard: ``part-NNNNN.arrow`` whose record batches hold two fixed-size lists per
row, ``ids`` (uint16 or uint32) and ``mask`` (bool, false only in the padding
of the shard's last row), and ``part-NNNNN.docs.arrow`` with each document's
id, first position in the shard and length.  Both are memory-mapped on
reading, so row ``r`` of any batch is reached without decoding or copying.

Files are written under a private name and moved into place, so a repeated
task only replaces a file by an equal one.  Memory in a task follows
``ROWS`` x ``length`` ids and one document.

Defined results: null and empty texts give the end id alone; repeated
document rows are written once each; a null id sorts first; an empty table
gives no shard and an empty index.  Only the id and text columns are read.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .textblocks import byte_table, span_hashes, text_blocks

LENGTH = 2048   # ids of one sequence
ROWS = 256      # sequences of one record batch
END_ID = 2
CACHE = 1 << 22  # pieces whose ids a worker keeps during a job

SPACE = byte_table([*range(0x09, 0x0E), 0x20])
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
PUNCT = byte_table(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def piece_starts(data: np.ndarray, offsets: np.ndarray, punctuation: bool = True) -> np.ndarray:
    """Where the rows of a block can be cut so that a byte-level BPE encodes
    the parts to the ids of the whole: before a run of white space, and (if
    ``punctuation``) between a letter or digit and ASCII punctuation, where
    the tokenizer's own splitting rule always splits.  Only places where the
    bytes before leave no doubt are taken."""
    n = len(data)
    before = np.zeros((3, n), dtype=np.uint8)  # the three bytes before each
    for i in range(3):
        before[i, i + 1:] = data[: max(n - i - 1, 0)]
    b1, b2, b3 = before
    # white space beyond ASCII: U+0085, 00A0, 1680, 2000-205F (with dashes and quotes), 3000; controls that some rules count in
    doubt = ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 == 0xE1) & (b2 == 0x9A)) | ((b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81))) \
        | ((b3 == 0xE3) & (b2 == 0x80)) | ((b1 >= 0x1C) & (b1 <= 0x1F))
    cut = SPACE[data] & ~SPACE[b1] & ~doubt
    if punctuation:
        cut |= PUNCT[data] & (ALNUM[b1] | ((b2 == 0xC3) & (b1 != 0x97) & (b1 != 0xB7)))
    first = offsets[:-1][np.diff(offsets) > 0]
    cut[first] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of whole texts by a byte-level BPE of the ``tokenizers`` library,
    which encodes each distinct piece once.  Pieces are told apart by 128
    bits of hash."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self):
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _whole(self, data, offsets):
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
        parts = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block, one after the other, and how many each
        row has."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        raw = data.tobytes()
        start = piece_starts(data, offsets, not any(t in raw for t in self.special))
        h1, h2 = span_hashes(data, start, 0), span_hashes(data, start, 1)
        one, first, which = np.unique(h1, return_index=True, return_inverse=True)
        two = h2[first]
        if len(self.h1) > CACHE:
            self._clear()
        at = np.searchsorted(self.h1, one)
        known = at < len(self.h1)
        known[known] = self.h1[at[known]] == one[known]
        if (two[which] != h2).any() or (self.h2[at[known]] != two[known]).any():
            return self._whole(data, offsets)  # 64 bits are shared by two pieces
        new = np.flatnonzero(~known)
        if len(new):
            end = np.append(start[1:], len(data))
            pieces = [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
            made = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            size = np.fromiter(map(len, made), np.int64, len(made))
            where = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.uint32, int(size.sum()))])
            self.h1, self.h2 = np.insert(self.h1, at[new], one[new]), np.insert(self.h2, at[new], two[new])
            self.at, self.size = np.insert(self.at, at[new], where), np.insert(self.size, at[new], size)
            at = np.searchsorted(self.h1, one)
        size = self.size[at][which]
        upto = np.cumsum(size)
        flat = self.ids[np.repeat(self.at[at][which] - (upto - size), size) + np.arange(upto[-1])]
        rows = np.concatenate([[0], upto])[np.searchsorted(start, offsets)]
        return flat, np.diff(rows)


def _worker_encoder(path: str, job: str) -> PieceEncoder:
    """The encoder of this job in this worker process, which runs several of
    its tasks one after the other."""
    state = sys.modules.setdefault("_cuespark_worker", types.ModuleType("_cuespark_worker")).__dict__
    if state.get("job") != (job, path):
        state["encoder"], state["job"] = PieceEncoder(path), (job, path)
    return state["encoder"]


def _sequences(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Shard:
    """Packs documents into sequences and writes them batch by batch."""

    def __init__(self, folder: str, number: int, length: int, wide: bool):
        self.store, root = fs.FileSystem.from_uri(folder)
        self.base = f"{root.rstrip('/')}/part-{number:05d}"
        self.temp = f"{root.rstrip('/')}/_{uuid.uuid4().hex}"
        self.length, self.schema, self.dtype = length, _sequences(length, wide), np.uint32 if wide else np.uint16
        self.outs = [self.store.open_output_stream(self.temp + e) for e in (".arrow", ".docs.arrow")]
        self.ids = pa.ipc.new_file(self.outs[0], self.schema)
        self.docs = pa.ipc.new_file(self.outs[1], _DOCS)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        start = self.total + np.cumsum(size) - size
        self.docs.write_batch(pa.record_batch([doc_ids, pa.array(start), pa.array(size)], schema=_DOCS))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        self.n_docs += len(size)
        if self.held >= ROWS * self.length:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype)
        whole = len(flat) // self.length * self.length
        self.waiting, self.held = [flat[whole:].copy()], len(flat) - whole
        for a in range(0, whole, ROWS * self.length):
            part = flat[a: min(whole, a + ROWS * self.length)]
            self._write(part, np.ones(len(part), dtype=bool))
        if last and self.held:
            mask = np.arange(self.length) < self.held
            self._write(np.pad(self.waiting[0], (0, self.length - self.held)), mask)

    def _write(self, ids: np.ndarray, mask: np.ndarray) -> None:
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=t) for v, t in zip((ids, mask), self.schema.types)]
        self.ids.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))

    def close(self) -> None:
        self._flush(last=True)
        for w, o, e in zip((self.ids, self.docs), self.outs, (".arrow", ".docs.arrow")):
            w.close()
            o.close()
            self.store.move(self.temp + e, self.base + e)


def _writer(folder: str, tokenizer: str, length: int, end_id: int, job: str):
    def run(batches):
        from pyspark import TaskContext

        shard = None
        for batch in batches:
            encoder = _worker_encoder(tokenizer, job)
            if shard is None:
                wide = max(encoder.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
                shard = _Shard(folder, TaskContext.get().partitionId(), length, wide)
            for first, n, data, offsets in text_blocks(batch.column(1)):
                ids, size = encoder.encode(data, offsets)
                ids = np.insert(ids, np.cumsum(size), end_id).astype(shard.dtype)
                shard.add(batch.column(0).slice(first, n), ids, size + 1)
        if shard:
            shard.close()
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([shard.total], pa.int64()),
                                   pa.array([shard.n_docs], pa.int64())], names=["shard", "n_tokens", "n_docs"])

    return run


def shared_folder(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder, as a URI."""
    path = scratch_path(spark, name)
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", path):
        path = "file://" + os.path.abspath(path)
    return re.sub(r"^file:/+", "file:///", path)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text",
                 length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Encode every text and write the shards into ``folder`` (a URI that all
    executors can write).  Returns the manifest, itself written beside the
    shards: shard number in id order, ids and documents in it."""
    spark = docs.sparkSession
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root.rstrip('/')}/shards", recursive=True)
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = dealt.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id")
    done = dealt.mapInArrow(_writer(f"{folder}/shards", tokenizer, length, end_id, uuid.uuid4().hex), "shard int, n_tokens bigint, n_docs bigint")
    done.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class Shard:
    """Random access to one written shard, memory-mapped where it is local."""

    def __init__(self, folder: str, number: int):
        store, root = fs.FileSystem.from_uri(folder)
        base = f"{root.rstrip('/')}/part-{number:05d}"
        opened = [pa.memory_map(base + e) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(base + e)
                  for e in (".arrow", ".docs.arrow")]
        self.batches, self.docs = (pa.ipc.open_file(x) for x in opened)
        self.length = self.batches.schema.field("ids").type.list_size

    def sequences(self, batch: int) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` (a view of the file) and ``mask`` of one record batch, as
        two-dimensional arrays."""
        b = self.batches.get_batch(batch)
        ids, mask = (b.column(c).flatten() for c in ("ids", "mask"))
        return ids.to_numpy().reshape(-1, self.length), mask.to_numpy(zero_copy_only=False).reshape(-1, self.length)

    def stream(self):
        """The valid ids of each record batch, in order."""
        for i in range(self.batches.num_record_batches):
            ids, mask = self.sequences(i)
            yield ids.ravel() if mask.all() else ids[mask]


def _reader(folder: str):
    def run(batches):
        for batch in batches:
            for number, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(folder, number)
                parts, part, at = shard.stream(), np.zeros(0, np.uint16), 0
                for i in range(shard.docs.num_record_batches):
                    index = shard.docs.get_batch(i)
                    crcs = []
                    for size in index.column("n_tokens").to_pylist():
                        crc, left = 0, size
                        while left:
                            if at == len(part):
                                part, at = next(parts), 0
                            take = part[at: at + left]
                            crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                            at, left = at + len(take), left - len(take)
                        crcs.append(crc)
                    yield pa.record_batch([index.column("doc_id"), pc.add(index.column("start"), base), index.column("n_tokens"),
                                           pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_index(spark, folder: str) -> DataFrame:
    """From the files: each document with the number of ids of all documents
    before it, its number of ids and their CRC-32 as little-endian 32-bit
    integers."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row per shard; the prefix sum is over shards only
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    shards = shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
    return shards.mapInArrow(_reader(f"{folder}/shards"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_index(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token files and read their index back."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    write_tokens(docs, tokenizer, folder, **options)
    return read_index(spark, folder)
