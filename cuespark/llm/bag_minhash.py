"""MinHash near-dedup with BagMinHash signatures (2).

A document is the multiset of its five-word shingles (lower-cased words
between white space; a shorter text is one shingle).  Two documents are near
copies if the weighted Jaccard similarity of their multisets is 0.8 or more;
classes are the connected components of that relation.

Signatures (Ertl 2018): a shingle of weight w owns the part [0, w) of a
weight axis cut into dyadic shells [0,1), [1,2), [2,4), ...  Each shell has
its own Poisson process in time, seeded by shingle and shell, whose points
carry a discretised weight position and a signature component; points beyond
w do not count.  A component keeps the earliest time, so two components are
equal with probability equal to the weighted Jaccard similarity.  Points are
produced only up to a time that almost surely fills all components, and
further for the rows where it did not.

Steps, all as joins and aggregations over written tables:

1. one pass over the texts gives every row its multiset's 128-bit sum, its
   size and ``BANDS`` band hashes; equal multisets become one node;
2. buckets of two or more nodes; in each, ``SLICES`` pivots (the members with
   the most bucket mates, in random slices) are paired with all members;
3. pairs are verified on the multisets themselves: the two closest pivots of
   each node first, then all pairs still between different components;
4. components by alternating large-star and small-star;
5. buckets whose members beside the pivots are still of different components
   are open.  An exact join of their nodes finds every link between them that
   is left: with the shingles of each in one order, rarest first, two near
   copies have their first common shingle so early in both that enough can
   follow it (prefix and position filter).  Those pairs are verified too, so
   no two nodes of a bucket go without being compared or ruled out.

Defined results: texts without words (null, empty) are near copies of
nothing, each row is a class of its own; repeated rows and equal multisets
share a class; a class is shown by its smallest id, null before all, which
several classes can have in common (null or repeated ids): classes are told
apart by their root.  One row of a class is kept, of the smallest id and
hash; ``dedup`` takes of rows equal in id and text the one whose columns
together have the least hash.  An empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .lines import HAS_WORD
from .textblocks import NON_SPACE_BYTES, Words, byte_table, inside_rows, lower_table, mix64, text_blocks, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 25, 5   # at 0.8 a pair shares a band with probability 0.99995
SLICES = 4
FIRST = 2                  # pivots of a node that are verified first
BROADCAST_ROWS = 200_000   # rows of two nodes that a join may broadcast
SLOT_BITS = 20             # shingles are ordered by the counts of 2^20 slots
TASK_ROWS = 50_000         # rows of nodes, pairs or links that are worth a task
TASK_PAIRS = 1_000         # pairs to be verified that are worth a task

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def _odd(i: int) -> np.ndarray:
    """The i-th of a sequence of 64-bit constants (wrapping)."""
    return np.array([i * _STEP & (1 << 64) - 1], dtype=np.uint64)


# ---- per block, in NumPy ---------------------------------------------------

def multisets(data, offsets, k: int = SHINGLE):
    """Row, hash and count of the distinct shingles of a block, sorted by row
    and hash."""
    w = Words(lower_table()[data], offsets, byte_table(NON_SPACE_BYTES))
    n_rows, sizes, h = len(offsets) - 1, np.diff(w.row_start), w.hashes()
    x = window_hashes(h, k)
    hashes, rows = [x[inside_rows(w.row_start, k, len(x))]], [np.repeat(np.arange(n_rows), np.maximum(sizes - k + 1, 0))]
    for n in range(1, k):
        short = np.flatnonzero(sizes == n)
        if len(short):
            hashes.append(window_hashes(h, n)[w.row_start[short]])
            rows.append(short)
    row, x = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((x, row))
    row, x = row[order], x[order]
    if not len(x):
        return row, x, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (x[1:] != x[:-1])]))
    return row[first], x[first], np.diff(np.append(first, len(x)))


def _processes(row, x, count):
    """One Poisson process per shingle and shell that its weight reaches into:
    row, seed, rate, first weight of the shell, weight."""
    parts, shell = [(row, mix64(x), np.ones(len(x)), np.zeros(len(x), np.int64), count)], 1
    low = 1
    while True:
        on = np.flatnonzero(count > low)
        if not len(on):
            return [np.concatenate(p) for p in zip(*parts)]
        parts.append((row[on], mix64(x[on] ^ _odd(shell)), np.full(len(on), float(low)), np.full(len(on), low), count[on]))
        shell, low = shell + 1, low * 2


def signatures(row, x, count, n_rows: int, m: int) -> np.ndarray:
    """BagMinHash signatures (earliest times) of the rows that have shingles;
    infinite elsewhere."""
    sig = np.full(n_rows * m, np.inf)
    weight = np.bincount(row, count, n_rows)
    until = np.where(weight > 0, m * (math.log(m) + 6) / np.maximum(weight, 1), 0)
    todo = weight > 0
    while todo.any():
        on = todo[row]
        r, seed, rate, low, w = _processes(row[on], x[on], count[on])
        t, step = np.zeros(len(r)), 0
        while len(r):
            step += 1
            u = ((mix64(seed + _odd(step)) >> _U(11)).astype(np.float64) + 1) * 2.0 ** -53
            t = t - np.log(u) / rate
            live = t < until[r]
            r, seed, rate, low, w, t = r[live], seed[live], rate[live], low[live], w[live], t[live]
            z = mix64(seed ^ mix64(_odd(step + (1 << 40))))
            at = low + ((z >> _U(32)).astype(np.float64) * 2.0 ** -32 * np.maximum(low, 1)).astype(np.int64)
            ok = at < w
            np.minimum.at(sig, r[ok] * m + ((z & _U(0xFFFFFFFF)) % _U(m)).astype(np.int64)[ok], t[ok])
        todo &= np.isinf(sig.reshape(n_rows, m)).any(axis=1)
        until = until * 2
    return sig.reshape(n_rows, m)


def band_hashes(sig: np.ndarray, bands: int, size: int) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), bands, size)
    h = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), bits.shape[:2])
    for i in range(size):
        h = mix64(h ^ bits[:, :, i]) * _odd(1)
    return h


def _segment_sums(row, values, n_rows):
    out = np.zeros(n_rows, np.uint64)
    if len(row):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[first]] = np.add.reduceat(values, first)
    return out


def _node(row, x, count, n_rows):
    """128-bit sum of the multiset of each row."""
    c = count.astype(np.uint64)
    return [_segment_sums(row, mix64(x ^ _U(salt)) * c + mix64(c + _U(salt)), n_rows).view(np.int64) for salt in (0x5BD1E995, 0xC2B2AE3D27D4EB4F)]


def _node_array(a, b):
    return pa.StructArray.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _signer(k: int, bands: int, size: int):
    def run(batches):
        for batch in batches:
            for first, n, data, offsets in text_blocks(batch.column("text")):
                row, x, count = multisets(data, offsets, k)
                a, b = _node(row, x, count, n)
                h = band_hashes(signatures(row, x, count, n, bands * size), bands, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid").slice(first, n), batch.column("id").slice(first, n), _node_array(a, b),
                     pa.array(np.bincount(row, count, n).astype(np.int64)), pa.ListArray.from_arrays(
                         np.arange(n + 1, dtype=np.int32) * bands, h.astype(np.uint64).view(np.int64).ravel())],
                    names=["rid", "id", "node", "n", "bands"])

    return run


def _multiset_maker(k: int):
    def run(batches):
        for batch in batches:
            for _, n, data, offsets in text_blocks(batch.column("text")):
                row, x, count = multisets(data, offsets, k)
                a, b = _node(row, x, count, n)
                at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_node_array(a, b), pa.ListArray.from_arrays(at, x.view(np.int64)), pa.ListArray.from_arrays(at, count.astype(np.int32))],
                    names=["node", "x", "c"])

    return run


def overlap(x1, c1, x2, c2) -> float:
    """Weighted Jaccard similarity of two multisets (distinct hashes sorted
    as unsigned numbers)."""
    x1, x2 = x1.view(np.uint64), x2.view(np.uint64)
    at = np.minimum(np.searchsorted(x2, x1), len(x2) - 1)
    both = x2[at] == x1
    shared = int(np.minimum(c1[both], c2[at[both]]).sum())
    return shared / (int(c1.sum()) + int(c2.sum()) - shared)


def _verifier(similarity: float):
    def run(batches):
        for batch in batches:
            ends = {c: np.asarray(batch.column(c).offsets) for c in ("x1", "x2")}
            flat = {c: np.asarray(batch.column(c).values) for c in ("x1", "c1", "x2", "c2")}
            keep = []
            for i in range(batch.num_rows):
                p, q = (slice(ends[c][i], ends[c][i + 1]) for c in ("x1", "x2"))
                keep.append(overlap(flat["x1"][p], flat["c1"][p], flat["x2"][q], flat["c2"][q]) >= similarity)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([pc.filter(batch.column(c), keep) for c in ("u", "v")], names=["u", "v"])

    return run


def _slots(x) -> np.ndarray:
    return (mix64(x.view(np.uint64)) >> _U(64 - SLOT_BITS)).astype(np.int64)


def _slot_counter():
    def run(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            ends = np.asarray(batch.column("x").offsets)
            total += np.bincount(_slots(np.asarray(batch.column("x").values)[ends[0]:ends[-1]]), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    return run


def prefix(x, c, ends, counts, similarity: float):
    """Row, shingle, units from it on and all units, of the shingles that can
    be the first common one of a row and a near copy: rows are put in the
    order of slot counts and hashes."""
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    x, c = x[ends[0]:ends[-1]], c[ends[0]:ends[-1]].astype(np.int64)
    order = np.lexsort((x, counts[_slots(x)], row))
    x, c = x[order], c[order]
    n = np.bincount(row, c, len(ends) - 1).astype(np.int64)
    left = np.cumsum(n)[row] - np.cumsum(c) + c
    on = left >= similarity * n[row] - 1e-6
    return row[on], x[on], left[on], n[row[on]]


def _prefixer(counts, similarity: float):
    def run(batches):
        for batch in batches:
            xs, cs = batch.column("x"), batch.column("c")
            row, x, left, n = prefix(np.asarray(xs.values), np.asarray(cs.values), np.asarray(xs.offsets), counts.value, similarity)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(x), batch.column("node").take(row), batch.column("root").take(row), pa.array(left), pa.array(n)],
                                             names=["x", "node", "root", "left", "n"])

    return run


# ---- plans -------------------------------------------------------------------

def _few(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """What a shuffle gives for at most ``rows`` rows, in no more tasks than
    they are worth (without a further shuffle); their number grows with the
    rows up to that of the shuffle's partitions."""
    return df.coalesce(max(1, -(-rows // each)))


def _one(df: DataFrame, rows: int) -> DataFrame:
    """At most ``TASK_ROWS`` rows as one partition, which needs no shuffle to
    be grouped; more rows as they are."""
    return df.coalesce(1) if rows <= TASK_ROWS else df


_NODE = "struct<a:bigint,b:bigint>"


def row_id(doc_id: Column, text: Column) -> Column:
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit(1), doc_id, text).alias("b"))


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, bands: int = BANDS, size: int = BAND_ROWS) -> DataFrame:
    """``rid`` (hash of id and text), ``id``, ``node``, ``n`` shingles and
    ``bands`` of every row."""
    rows = docs.select(row_id(F.col(doc_id), F.col(text)).alias("rid"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    return rows.mapInArrow(_signer(k, bands, size), f"rid {_NODE}, id {kind}, node {_NODE}, n bigint, bands array<bigint>")


def candidate_pairs(nodes: DataFrame, slices: int = SLICES) -> tuple[DataFrame, DataFrame]:
    """``node``, ``pivot`` and the bands ``shared`` of members and pivots of
    common buckets, and ``bucket``, ``node`` of the members that are no pivot;
    ``nodes``: a written table of ``node`` and ``bands``."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    n = sizes.agg(F.sum("size")).first()[0] or 0  # members
    members = materialize(rows.join(_small(sizes, n, "buckets"), "bucket"), "bucket-members")
    mates = members.groupBy("node").agg(F.sum("size").alias("mates"))
    ranked = members.select("bucket", "node", F.pmod(F.xxhash64("bucket", "node"), F.lit(slices)).alias("slice")).join(_small(mates, n, "mates"), "node")
    pivots = ranked.groupBy("bucket", "slice").agg(F.max(F.struct("mates", "node")).alias("top"))
    pivots = materialize(_few(pivots.select("bucket", F.col("top.node").alias("pivot")), n), "pivots")
    near = _small(pivots, n, "pivots")
    pairs = members.join(near, "bucket").where(F.col("node") != F.col("pivot")).select("node", "pivot")
    others = members.select("bucket", "node").join(_small(pivots.withColumnRenamed("pivot", "node"), n, "pivots"), ["bucket", "node"], "left_anti")
    return _few(pairs.groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("shared")), slices * n), others


def open_nodes(others: DataFrame, comps: DataFrame) -> DataFrame:
    """``node`` and ``root`` of the members (no pivots) of buckets that have
    such members of different components; ``comps``: written."""
    root = _small(comps, comps.count(), "roots")
    rooted = materialize(others.join(root, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), "bucket-roots")
    n = rooted.count()
    opened = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    return _few(rooted.join(_small(_few(opened, n), n, "open-buckets"), "bucket", "left_semi").select("node", "root").distinct(), n)


def prefix_pairs(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``node`` and ``pivot`` of different roots among ``nodes`` (written:
    ``node``, ``root``), with all that are near copies: the pairs that share a
    shingle of their prefixes at which the overlap can still be large enough.
    A shingle's most frequent root is only joined with its other roots."""
    mine = sets.join(_small(nodes, nodes.count(), "open-nodes"), "node")
    slots = mine.select("x").mapInArrow(_slot_counter(), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[slots["slot"].to_numpy()] = slots["n"].to_numpy()
    counts = sets.sparkSession.sparkContext.broadcast(counts)
    rows = materialize(mine.select("node", "root", "x", "c").mapInArrow(
        _prefixer(counts, similarity), f"x bigint, node {_NODE}, root {_NODE}, left bigint, n bigint"), "prefixes")
    count = rows.count()
    # a near copy's size is at least similarity x n, the smaller one of a pair has its first common shingle earlier
    small = F.max(F.col("left") * (1 + similarity) >= 2 * similarity * F.col("n") - 1e-6).alias("small")
    roots = rows.groupBy("x", "root").agg(F.count(F.lit(1)).alias("k"), small)
    tops = roots.groupBy("x").agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.max("small").alias("small"))
    tops = materialize(_few(tops.where("roots > 1 and small").select("x", F.col("top.root").alias("top")), count), "prefix-shingles")
    shared = materialize(rows.join(_small(tops, tops.count(), "prefix-shingles"), "x"), "shared-prefixes")
    one, two = shared.where("root != top").alias("o"), shared.drop("top").alias("p")
    once = (F.col("p.root") == F.col("o.top")) | (F.col("o.node") < F.col("p.node"))
    enough = F.least("o.left", "p.left") * (1 + similarity) >= similarity * (F.col("o.n") + F.col("p.n")) - 1e-6
    both = one.join(two, (F.col("o.x") == F.col("p.x")) & (F.col("o.root") != F.col("p.root")) & once & enough)
    return _few(both.select(F.least("o.node", "p.node").alias("node"), F.greatest("o.node", "p.node").alias("pivot")).distinct(), shared.count())


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``u``, ``v`` among the pairs whose multisets overlap enough; both
    written tables, so that adaptive execution can split a hot pivot."""
    one = sets.select(F.col("node").alias("u"), F.col("x").alias("x1"), F.col("c").alias("c1"))
    two = sets.select(F.col("node").alias("v"), F.col("x").alias("x2"), F.col("c").alias("c2"))
    both = pairs.select(F.col("node").alias("u"), F.col("pivot").alias("v")).join(one, "u").join(two, "v")
    return _few(both, pairs.count() + sets.count(), TASK_PAIRS).mapInArrow(_verifier(similarity), f"u {_NODE}, v {_NODE}")


def _small(df: DataFrame, rows: int, name: str) -> DataFrame:
    """A side of a join, of at most ``rows`` rows: broadcast if they are few,
    else written, so that adaptive execution can split a hot key."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else materialize(df, name)


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``root`` (smallest node of the component) of every node
    that has a link (written), by alternating large-star and small-star."""
    n = links.count()
    edges = _one(links.select(F.least(u, v).alias("lo"), F.greatest(u, v).alias("hi")).where("lo < hi"), n)
    edges = materialize(_few(edges.distinct(), n), "edges")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("lo", "hi"))).first())
    before = mark(edges)
    while before[0]:
        n = 2 * before[0]
        around = edges.select(F.col("lo").alias("x"), F.col("hi").alias("y")).union(edges.select("hi", "lo"))
        around = _one(around, n)
        least = _small(_few(around.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m")), n), n, "large-star")
        far = around.where("y > x").join(least, "x").select(F.col("m").alias("lo"), F.col("y").alias("hi")).where("lo < hi")
        far = far if n <= BROADCAST_ROWS else materialize(far, "edges")
        least = _small(_few(far.groupBy("hi").agg(F.min("lo").alias("m")), n), n, "small-star")
        near = far.join(least, "hi").select("m", F.explode(F.array("hi", "lo")).alias("y"))
        edges = materialize(_few(near.select(F.col("m").alias("lo"), F.col("y").alias("hi")).where("lo < hi").distinct(), n), "edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    every = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(_one(edges.select("lo", "lo"), before[0]).distinct())
    return materialize(_few(every, 2 * before[0]), "components")


def _rooted(pairs: DataFrame, comps: DataFrame, n: int, *columns: str) -> DataFrame:
    """The pairs with the root of each of the columns (itself if it has none)
    as ``<column>_root``."""
    for c in columns:
        root = _small(comps.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), n, "roots")
        pairs = pairs.join(root, c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    return pairs


def contracted(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of all earlier links and these (written): only the roots
    that new links connect are worked on."""
    n = comps.count()
    over = _rooted(links, comps, n, "u", "v").select(F.col("u_root").alias("u"), F.col("v_root").alias("v")).where("u != v")
    m = links.count()
    over = components(materialize(_few(_one(over, m).distinct(), m), "root-links"))
    m = over.count()
    if not m:
        return comps
    moved = comps.join(_small(over.select(F.col("node").alias("root"), F.col("root").alias("top")), m, "tops"), "root", "left")
    new = over.join(_small(comps.select("node"), n, "components"), "node", "left_anti")  # nodes without a link so far
    return materialize(_few(moved.select("node", F.coalesce("top", "root").alias("root")).union(new), n + m), "components")


def _between(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component; ``comps``: written."""
    both = _rooted(pairs, comps, comps.count(), "node", "pivot")
    return both.where("node_root != pivot_root").select("node", "pivot", "shared")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``rid``, ``seq`` (a number of the row), ``id``, ``n`` shingles,
    ``class_id`` (smallest id of the class) and ``root`` (the class itself;
    null without words) of every document row."""
    signed = materialize(sign(docs, doc_id, text).withColumn("seq", F.monotonically_increasing_id()), "signed")
    nodes = materialize(signed.where("n > 0").groupBy("node").agg(F.min(F.struct("id", "rid")).alias("doc"), F.first("bands").alias("bands")), "nodes")
    pairs, others = candidate_pairs(nodes)
    pairs = materialize(pairs, "pairs")
    # the texts of the documents in pairs, once per node
    n = pairs.count()
    ends = _few(pairs.select("node").union(pairs.select("pivot")).distinct(), 2 * n)
    rids = materialize(nodes.join(_small(ends, 2 * n, "pair-nodes"), "node", "left_semi").select(F.col("doc.rid").alias("rid")), "pair-rows")
    # (a merge join at every size: a broadcast would hold for few pairs only)
    texts = docs.select(row_id(F.col(doc_id), F.col(text)).alias("rid"), F.col(text).alias("text")).join(rids.hint("merge"), "rid", "left_semi").select("text")
    made = texts.mapInArrow(_multiset_maker(SHINGLE), f"node {_NODE}, x array<bigint>, c array<int>")
    sets = materialize(made.dropDuplicates(["node"]), "multisets")

    closest = pairs.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("shared", "pivot")), asc=False), 1, FIRST).alias("p"))
    first = materialize(_few(closest.select("node", F.explode("p").alias("p")).select("node", "p.pivot"), n), "first-pairs")
    comps = components(materialize(verified(first, sets, similarity), "links"))
    rest = _few(_between(pairs.join(first, ["node", "pivot"], "left_anti"), comps), n)
    comps = contracted(comps, materialize(verified(materialize(rest, "open-pairs"), sets, similarity), "links"))
    opened = materialize(open_nodes(others, comps), "open-nodes")
    if not opened.isEmpty():
        last = materialize(prefix_pairs(opened, sets, similarity), "prefix-pairs")
        comps = contracted(comps, materialize(verified(last, sets, similarity), "links"))

    root = _small(comps, comps.count(), "roots")
    named = nodes.select("node", F.col("doc.id").alias("id")).join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min(F.struct("id")).alias("first"))
    named = materialize(_few(named.join(names, "root").select("node", "root", F.col("first.id").alias("class_id")), nodes.count()), "classes")
    alone = signed.where("n = 0").select("rid", "seq", "id", "n", F.col("id").alias("class_id"), F.lit(None).cast(_NODE).alias("root"))
    return signed.where("n > 0").join(named, "node").select("rid", "seq", "id", "n", "class_id", "root").union(alone)


def _stay(table: DataFrame) -> DataFrame:
    """``rid`` and ``seq`` of the row of each class that stays; rows without
    words are not in it."""
    first = table.where("n > 0").groupBy("root").agg(F.min(F.struct("id", "rid", "seq")).alias("m"))
    return first.select("m.rid", "m.seq")


def report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row: id, class (``class_id`` is its smallest id,
    ``class_key`` tells classes apart; null without words), shingles, and
    whether it is the document of its class that stays."""
    table = materialize(classes(docs, doc_id, **options), "near-classes")
    stay = materialize(_few(_stay(table).select("seq", F.lit(True).alias("stays")), table.count()), "near-kept")
    kept = F.coalesce(F.col("stays"), F.col("n") == 0)
    key = F.concat(F.hex("root.a"), F.lit("-"), F.hex("root.b"))
    return table.join(stay, "seq", "left").select(F.col("id").alias(doc_id), "class_id", key.alias("class_key"), F.col("n").alias("n_shingles"), kept.alias("kept"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of every class, and all without words; columns unchanged."""
    table = materialize(classes(docs, doc_id, text, **options), "near-classes")
    stay = materialize(_few(_stay(table).select("rid"), table.count()), "near-kept")
    rows = docs.select(row_id(F.col(doc_id), F.col(text)).alias("rid"), F.struct(*docs.columns).alias("row"))
    said = F.coalesce(F.col("row")[text].rlike(HAS_WORD), F.lit(False))
    kept = rows.where(said).join(stay.hint("merge"), "rid", "left_semi")
    # rows equal in id and text: the one of the least hash of all its columns
    kept = kept.groupBy("rid").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return kept.select("row.*").union(rows.where(~said).select("row.*"))
