"""Document fingerprints (13): improbable-feature digests.

A document's features are its windows of ``WINDOW`` bytes.  Each has the
Shannon entropy of its bytes in ``LEVELS`` steps, and a rank: how rare that
entropy is over the windows of a whole corpus (``entropy_ranks``), so that
the rank is low where a window is improbable.  Every stretch of ``WINDOW``
consecutive windows votes for its lowest rank, the first one of equals, and
windows with ``VOTES`` votes or more are the selected features.  Their 64-bit
hashes set ``BITS`` bits each in a Bloom filter of ``FILTER`` bytes; a filter
that holds ``FULL`` features is closed and the next one is chained to it.

Two digests are compared filter by filter: the common bits beyond those that
chance gives to filters so full, as a share of the most that there could be;
each filter of the shorter digest counts with its best partner, by its
features.  The result is between 0 and 1, and 1 for equal digests.

All of it is array work over blocks of texts: counts inside sliding windows
come from one stable sort of the bytes, entropies from integer running sums,
votes from sliding minima of doubling length.  An edited copy takes the
entropies of its two parts from their texts; only windows across the seam are
computed anew.

``edited_report`` compares documents with an edited copy, whose end is taken
from the next document in id order.  The texts are range-partitioned by id
once; a partition's first and last rows meet those of its neighbours in a
small join, so nothing is collected and no order is counted globally.

Defined results: a null text is empty; an empty text has the empty digest,
like only to itself (1, else 0); a text shorter than a window, or without any
window above ``LEAST`` entropy, has one feature, its whole text.  Null ids
come first, equal ids in the order of a hash of their texts; rows equal in
both are interchangeable.  A single row is its own next document.  An empty
table gives no rows.  Only the id and text columns are read, so others may
have any name.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .textblocks import mix64, text_blocks

WINDOW = 64     # bytes of a feature
LEVELS = 1000   # steps of entropy
LEAST = 100     # windows of lower entropy tell nothing
VOTES = 16      # of WINDOW stretches that a window is in
FILTER = 256    # bytes of a Bloom filter
BITS = 5        # bits set by a feature
FULL = 160      # features of a filter
BLOCK = 1 << 18  # bytes of text worked on at a time
GROUP = 1 << 22  # bytes of texts held together
NEAR = 10        # equal bytes looked for one by one on whole arrays

_U = np.uint64
_UNIT = 1 << 20  # entropies are summed in integers


# ---- windows of a block ------------------------------------------------------------

def _steps() -> np.ndarray:
    """What the c-th equal byte adds to the sum of c log2 c over a window."""
    f = [round(c * math.log2(c) * _UNIT) if c else 0 for c in range(WINDOW + 1)]
    return np.diff(np.array(f, np.int64), prepend=0)  # index c: f(c) - f(c - 1)


def _entropies(data: np.ndarray) -> np.ndarray:
    n = len(data)
    kind = np.int32 if n < 1 << 22 else np.int64
    order = np.argsort(data, kind="stable")
    # equal bytes lie next to each other in key, in the order of their places
    key = data[order].astype(kind) * kind(2 * n + WINDOW) + order.astype(kind)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # equal bytes less than a window before, after
    k, close = 1, key[1:] - key[:-1] < WINDOW
    while k <= NEAR and close.any():
        before[k:] += close
        after[:n - k] += close
        k += 1
        close = key[k:] - key[:-k] < WINDOW
    on = np.flatnonzero(close)
    while len(on):
        before[on + k] += 1
        after[on] += 1
        k += 1
        on = on[on + k < n]
        on = on[key[on + k] - key[on] < WINDOW]
    step = _steps()
    gain, loss = np.empty(n, np.int32), np.empty(n, np.int32)
    gain[order], loss[order] = step[1:][before], step[1:][after]
    # the first window; then bytes enter at its end and leave at its beginning
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = sum(int(step[: c + 1].sum()) for c in np.bincount(data[:WINDOW]))
    np.subtract(gain[WINDOW:], loss[: n - WINDOW], out=total[1:])
    most = WINDOW * round(math.log2(WINDOW) * _UNIT)
    return LEVELS * (most - np.cumsum(total)) // most


def entropies(data: np.ndarray) -> np.ndarray:
    """Level of entropy of the window that begins at each byte (the last
    ``WINDOW - 1`` are left out): 0 if all its bytes are equal, ``LEVELS`` if
    all differ."""
    last = WINDOW - 1
    parts = [_entropies(data[a: a + BLOCK + last]) for a in range(0, len(data) - last, BLOCK)]
    return np.concatenate(parts).astype(np.int16) if parts else np.zeros(0, np.int16)


def levels(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Entropies of the windows that lie in one text, -1 elsewhere, one number
    for each byte."""
    out = np.full(len(data), -1, np.int16)
    if len(data) >= WINDOW:
        out[: len(data) - WINDOW + 1] = entropies(data)
    for e in offsets[1:].tolist():
        out[max(e - WINDOW + 1, 0): e] = -1
    return out


def selected(level: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the selected windows (``level``: -1 where there is none, at
    ``WINDOW - 1`` places between texts)."""
    ok = level >= LEAST
    n = len(level)
    if not ok.any():
        return np.zeros(0, np.int64)
    none = np.int64(1) << 62
    code = np.full(n + 2 * (WINDOW - 1), none)  # rank, then place: the least is the first lowest
    code[WINDOW - 1: WINDOW - 1 + n] = np.where(ok, (ranks[level].astype(np.int64) << 40) + np.arange(n), none)
    size = 1
    while size < WINDOW:
        code = np.minimum(code[:-size], code[size:])
        size *= 2
    won = code[code < none] & ((np.int64(1) << 40) - 1)
    return np.flatnonzero(np.bincount(won, minlength=n) >= VOTES)


def _hashes(data: np.ndarray, at: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """64-bit hash of the ``size`` bytes at each place, eight bytes at a time."""
    h = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(0, size, 8):
        word = np.zeros(len(at), np.uint64)
        for j in range(8):
            word |= data[at + i + j].astype(np.uint64) << _U(8 * j)
        h = mix64(h ^ word) * _U(0xD6E8FEB86659FD93)
    return mix64(h)


# ---- digests ------------------------------------------------------------------------

class Digest:
    """Chained Bloom filters: ``filters`` (n x FILTER bytes) and the number of
    features in the last one; all others are full."""

    def __init__(self, filters: np.ndarray, last: int):
        self.filters, self.last = filters, last

    def counts(self) -> np.ndarray:
        n = np.full(len(self.filters), FULL)
        n[-1:] = self.last
        return n

    def __str__(self) -> str:
        """``features in the last filter:filters in base64``; empty if none."""
        return f"{self.last}:{base64.b64encode(self.filters.tobytes()).decode()}" if len(self.filters) else ""

    @classmethod
    def parse(cls, text: str) -> Digest:
        if not text:
            return cls(np.zeros((0, FILTER), np.uint8), 0)
        last, body = text.split(":")
        return cls(np.frombuffer(base64.b64decode(body), np.uint8).reshape(-1, FILTER), int(last))


def _chains(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> list[Digest]:
    """Digests of the distinct hashes of each document, in the order of their
    first occurrence; ``doc`` ascends."""
    by = np.lexsort((hashes, doc))
    again = np.zeros(len(by), bool)
    again[1:] = (doc[by][1:] == doc[by][:-1]) & (hashes[by][1:] == hashes[by][:-1])
    new = np.ones(len(by), bool)
    new[by[again]] = False  # lexsort is stable: the first occurrence stays
    doc, hashes = doc[new], hashes[new]
    size = np.bincount(doc, minlength=n_docs)
    chains = -(-size // FULL)
    base = np.cumsum(chains) - chains
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    filt = base[doc] + place // FULL
    bits = np.zeros((int(chains.sum()), 8 * FILTER), np.uint8)
    width = int(math.log2(8 * FILTER))
    for i in range(BITS):
        bits[filt, ((hashes >> _U(i * width)) & _U(8 * FILTER - 1)).astype(np.int64)] = 1
    filters = np.packbits(bits, axis=1)
    last = size - (np.maximum(chains, 1) - 1) * FULL
    return [Digest(filters[b: b + c], int(k)) for b, c, k in zip(base.tolist(), chains.tolist(), last.tolist())]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _cut(offsets: np.ndarray, size: int):
    """Ranges of texts of about ``size`` bytes together, one at least."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, b
        a = b


def digests(data: np.ndarray, offsets: np.ndarray, level: np.ndarray, ranks: np.ndarray) -> list[Digest]:
    """The digest of each of the texts that follow each other in ``data``."""
    out = []
    for a, b in _cut(offsets, BLOCK):
        raw, off, n = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], b - a
        at = selected(level[offsets[a]: offsets[b]], ranks)
        doc, hashes = np.searchsorted(off, at, side="right") - 1, _hashes(raw, at)
        alone = np.flatnonzero((np.bincount(doc, minlength=n) == 0) & (np.diff(off) > 0))
        if len(alone):
            own = [int.from_bytes(hashlib.sha256(raw[off[d]: off[d + 1]]).digest()[:8], "little") for d in alone.tolist()]
            doc, hashes = np.concatenate([doc, alone]), np.concatenate([hashes, np.array(own, np.uint64)])
            by = np.argsort(doc, kind="stable")
            doc, hashes = doc[by], hashes[by]
        out += _chains(doc, hashes, n)
    return out


def text_digests(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    data, offsets = _joined(texts)
    return digests(data, offsets, levels(data, offsets), ranks)


_ZERO = [(1 - 1 / (8 * FILTER)) ** (BITS * n) for n in range(2 * FULL + 1)]  # chance that a bit is 0 after n features


def likeness(one: Digest, two: Digest) -> float:
    """How alike two digests are, from 0 to 1."""
    if (len(one.filters), one.last) > (len(two.filters), two.last):
        one, two = two, one
    if not len(one.filters):
        return float(not len(two.filters))
    sides = []
    for d in (one, two):
        bits = [int.from_bytes(f.tobytes(), "big") for f in d.filters]
        sides.append([(b, b.bit_count(), n) for b, n in zip(bits, d.counts().tolist())])
    total = 0.0
    for x, ones, n in sides[0]:
        best = 0.0
        for y, more, k in sides[1]:
            chance, most = 8 * FILTER * (1 - _ZERO[n] - _ZERO[k] + _ZERO[n + k]), min(ones, more)
            best = max(best, ((x & y).bit_count() - chance) / (most - chance) if most > chance else float(x == y))
        total += n * min(best, 1.0)
    return total / sum(n for _, _, n in sides[0])


# ---- plans --------------------------------------------------------------------------

def _level_counter():
    def run(batches):
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), GROUP):
                level = levels(data, offsets)
                total += np.bincount(level[level >= 0], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(total)], names=["level", "n"])

    return run


def entropy_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy level by its windows over all texts, the rarest
    first (equally rare ones by level); can be kept and used for other tables,
    whose digests then can be compared."""
    found = docs.select(F.col(text)).mapInArrow(_level_counter(), "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LEVELS + 1, np.int64)
    counts[found["level"].to_numpy()] = found["n"].to_numpy()
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS + 1)
    return ranks


def _fingerprinter(ranks):
    def run(batches):
        for batch in batches:
            for first, n, data, offsets in text_blocks(batch.column("text"), GROUP):
                made = digests(data, offsets, levels(data, offsets), ranks.value)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, n), pa.array([str(d) for d in made], pa.string())], names=["id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, ranks: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and digest of every row; no shuffle."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_fingerprinter(docs.sparkSession.sparkContext.broadcast(ranks)), f"id {kind}, fingerprint string")
    return made.withColumnRenamed("id", doc_id)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many characters from the
    beginning of another one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _spliced(level, offsets, copies, offs, keep):
    """Levels of the copies: copy i begins with ``keep[i]`` bytes of text i and
    goes on with the beginning of text i + 1."""
    last = WINDOW - 1
    lo, ends = np.maximum(keep - last, 0).tolist(), np.minimum(keep + last, np.diff(offs)).tolist()
    starts = offs.tolist()
    seams, at = _joined([copies[s + a: s + b].tobytes() for s, a, b in zip(starts, lo, ends)])
    seam, at = levels(seams, at), at.tolist()
    out = np.full(len(copies), -1, np.int16)
    for i, (s, e, a, b, k) in enumerate(zip(starts, starts[1:], lo, ends, keep.tolist())):
        out[s: s + a] = level[offsets[i]: offsets[i] + a]
        out[s + a: s + b] = seam[at[i]: at[i + 1]]
        more = max(e - s - last - k, 0)
        out[s + k: s + k + more] = level[offsets[i + 1]: offsets[i + 1] + more]
    return out


def _compared(texts: list[str], ranks: np.ndarray):
    """Of each text but the last: characters, SHA-256 of its edited copy, both
    digests, and its likeness to the copy and to the following text."""
    data, offsets = _joined([t.encode() for t in texts])
    level = levels(data, offsets)
    own = digests(data, offsets, level, ranks)
    raw = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    copies, offs = _joined(raw)
    keep = np.array([len(t[: len(t) - len(t) // 4].encode()) for t in texts[:-1]], np.int64)
    other = digests(copies, offs, _spliced(level, offsets, copies, offs, keep), ranks)
    for i, (t, c) in enumerate(zip(texts, raw)):
        yield len(t), hashlib.sha256(c).hexdigest(), str(own[i]), str(other[i]), likeness(own[i], other[i]), likeness(own[i], own[i + 1])


_FACTS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _FACTS.split(", ")]


def _facts(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]


def _pairs(ranks):
    """Rows of a sorted partition with what follows each inside it; its first
    and last row with their texts, for the neighbours."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held, seen = None, False

        def out(ids, facts, edge, texts):
            n = len(ids)
            return pa.RecordBatch.from_arrays([ids, pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.string()), pa.array(texts, pa.string()), *facts],
                                              names=["id", "part", "edge", "text", *_NAMES])

        blank = [pa.nulls(1, a.type) for a in _facts([])]
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for lo, hi in _cut(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), GROUP):
                some = batch.slice(lo, hi - lo)
                ids, texts = some.column("id"), [t or "" for t in some.column("text").to_pylist()]
                if not seen:
                    yield out(ids.slice(0, 1), blank, "first", texts[:1])
                    seen = True
                else:
                    ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
                if len(texts) > 1:
                    yield out(ids.slice(0, len(texts) - 1), _facts(list(_compared(texts, ranks.value))), None, [None] * (len(texts) - 1))
                held = ids.slice(len(texts) - 1, 1), texts[-1]
        if held:
            yield out(held[0], blank, "last", [held[1]])

    return run


def _edges(ranks):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pair = [batch.column(c)[i].as_py() for c in ("text", "following")]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, 1), *_facts(list(_compared(pair, ranks.value)))], names=["id", *_NAMES])

    return run


def edited_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: np.ndarray | None = None) -> DataFrame:
    """One row per document row: characters, the digest, that of its edited
    copy (the end taken from the next document in id order; after the last
    comes the first), and the likeness to the copy and to the next document."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(entropy_ranks(docs, text) if ranks is None else ranks)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("seq"))
    kind = rows.schema["id"].dataType.simpleString()
    # seq splits a hot id with one text; only rows that are interchangeable depend on it
    by = [F.col("id").asc_nulls_first(), F.xxhash64("text"), "seq"]
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    made = dealt.select("id", "text").mapInArrow(_pairs(ranks), f"id {kind}, part int, edge string, text string, {_FACTS}")
    path = scratch_path(spark, "fingerprints")
    made.write.option("compression", "zstd").parquet(path)
    made = spark.read.parquet(path)
    # the last row of a partition is followed by the first of the next that has rows, a row for each partition
    firsts = made.where("edge = 'first'").select("part", F.col("text").alias("following"))
    w = Window.orderBy("part")
    after = firsts.select("part").select("part", F.coalesce(F.lead("part").over(w), F.min("part").over(w)).alias("next"))
    lasts = made.where("edge = 'last'").select("id", "text", "part").join(after, "part")
    met = lasts.join(firsts.withColumnRenamed("part", "next"), "next").select("id", "text", "following")
    ends = met.mapInArrow(_edges(ranks), f"id {kind}, {_FACTS}")
    return made.where("edge is null").select("id", *_NAMES).union(ends).withColumnRenamed("id", doc_id)
