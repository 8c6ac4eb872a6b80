"""Mixing sources to target weights by weighted fair queueing (9).

Every source has a target: its weight's share of the budget, at most
``MAX_EPOCHS`` times its size, with the excess shared again by weight.  The
documents of a source stand in a fixed random order; the virtual finish time
of a document's copy is the source's words up to its end, divided by the
source's target.  All copies (one per epoch) are sorted by finish time and
the order is cut where the running total reaches the budget, so that every
source stops close to its target.

Running totals are prefix sums in three levels: documents inside a slice of
the random order, slices inside a block of ``SLICES`` slices, blocks inside a
source.  A source with a third of all rows is spread over 65,536 slices, and
no window sees more than one slice's documents or ``SLICES`` rows.  The cut
is found from totals of ranges of finish time, twice refined; what reaches
the driver is bounded by the number of ranges.  The sources table (one row a
source) is ranked in one task.

Defined results: a null text has no words; null is a source, the last one; a
null id is ordered as ``''``; repeated rows are documents of their own; rows
of no words are taken as 0; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .lines import space_words

WEIGHTS = (3, 1, 2)   # of the sources in code-point order, repeating
SHARE = 1.5           # budget as a multiple of all words
MAX_EPOCHS = 2
SEED = "mix-1"
SLICES = 1024         # slices of a block; 64 blocks
RANGES = 1 << 10      # ranges of finish time that one refinement tells apart


def _size(text: Column) -> Column:
    return F.size(space_words(F.coalesce(text, F.lit("")))).cast("long")


def _ordered(docs: DataFrame, doc_id: str, text: str, source: str) -> list[Column]:
    """Source hash, position in the random order, its slice, size, tie-break."""
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return [F.xxhash64(F.col(source)).alias("_s"), key.alias("_key"), F.conv(F.substring(key, 1, 4), 16, 10).cast("int").alias("_slice"),
            _size(F.col(text)).alias("_size"), F.xxhash64(F.col(text)).alias("_text")]


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``_s``, ``source``, ``_all`` (its words), ``_target`` from rows of
    ``_s, source, _size``."""
    s = sizes.groupBy("_s").agg(F.first("source").alias("source"), F.sum("_size").alias("_all"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    s = s.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("_most", epochs * F.col("_all"))
    # water filling: in order of room per weight, sources that the common
    # level would overfill are full; the first that it does not sets it
    every, before = Window.partitionBy(), Window.orderBy(F.col("_most") / F.col("_w"), "_s").rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("_most").over(before), F.lit(0))
    weight = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    s = s.withColumn("_level", (F.sum("_all").over(every) * F.lit(share) - full) / weight)
    s = s.withColumn("_level", F.when(F.col("_most") >= F.col("_level") * F.col("_w"), F.col("_level")))
    s = s.withColumn("_level", F.max("_level").over(every))
    return s.select("_s", "source", "_all", F.least(F.col("_most").cast("double"), F.col("_level") * F.col("_w")).alias("_target"))


def _offsets(base: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and slice: words of the source before the slice, with the
    source's size and target."""
    block = F.expr(f"_slice div {SLICES}").cast("int").alias("_block")
    slices = base.groupBy("_s", "_slice").agg(F.sum("_size").alias("_n")).select("*", block)
    before = Window.partitionBy("_s", "_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inside = slices.select("_s", "_block", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_in"))
    blocks = base.groupBy("_s", block).agg(F.sum("_size").alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_s", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off")).join(targets.drop("source"), "_s")
    return inside.join(blocks, ["_s", "_block"]).select("_s", "_slice", (F.col("_off") + F.col("_in")).alias("_before"), "_all", "_target")


def _scheduled(rows: DataFrame, offsets: DataFrame, epochs: int) -> DataFrame:
    """Adds ``_finish``: the finish time of each of a document's copies."""
    run = Window.partitionBy("_s", "_slice").orderBy("_key", "_size", "_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_run", F.sum("_size").over(run)).join(offsets, ["_s", "_slice"])
    upto = F.col("_before") + F.col("_run")
    times = [F.when(F.col("_target") > 0, F.try_divide((e * F.col("_all") + upto).cast("double"), "_target")).otherwise(0.0) for e in range(epochs)]
    return rows.withColumn("_finish", F.array(*times)).drop("_run", "_before")


def find_cut(table: DataFrame, budget: float):
    """The last copy within the budget as ``(finish, key, source hash)``;
    ``None``: every copy fits.  ``table``: a written table.

    Finish times are numbered by ``RANGES`` ** 3 equal ranges.  Totals of
    groups of ranges find the group where the total passes the budget, and
    its parts in turn; only the last range is sorted."""
    copies = table.select("_s", "_key", F.col("_size").alias("n"), F.explode("_finish").alias("f"))
    end = copies.agg(F.max("f")).first()[0]
    if not end:
        return None
    copies = copies.withColumn("b", F.floor(F.col("f") * (RANGES ** 3 / end)).cast("long"))
    low, before, width = 0, 0, RANGES ** 3 * 2
    while width > 1:
        inside = (F.col("b") >= low) & (F.col("b") < low + width)
        width = -(-width // RANGES)
        part = F.expr(f"(b - {low}) div {width}").alias("part")
        totals = copies.where(inside).groupBy(part).agg(F.sum("n").alias("n")).collect()  # at most RANGES rows
        for r in sorted(totals):
            if before + r.n > budget:
                break
            before += r.n
        else:
            return None
        low += r["part"] * width
    last = copies.where(F.col("b") == low)
    order = Window.orderBy("f", "_key", "_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = last.withColumn("_sum", F.sum("n").over(order)).where(F.col("_sum") <= budget - before)
    found = fits.agg(F.max(F.struct("f", "_key", "_s")).alias("m")).first()["m"]
    if found:
        return tuple(found)
    return (last.agg(F.min("f")).first()[0], "", -(1 << 63))  # all before this range


def _included(finish: Column, cut) -> Column:
    if cut is None:
        return F.lit(True)
    f, key, s = cut
    later = (F.col("_key") < key) | ((F.col("_key") == key) & (F.col("_s") <= s))
    return (finish < f) | ((finish == f) & later)


def schedule(docs: DataFrame, keep=("doc_id",), doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Struct ``row`` of the ``keep`` columns of every document row, its
    ``size``, its source's size and ``target``, and ``copies``: how often the
    mix takes it."""
    order = _ordered(docs, doc_id, text, source)
    base = materialize(docs.select(*order, F.col(source).alias("source"), F.struct(doc_id).alias("row")), "mix-base")
    targets = materialize(source_targets(base.select("_s", "source", "_size"), weights, share, epochs), "mix-targets")
    offsets = materialize(_offsets(base, targets), "mix-offsets")
    light = materialize(_scheduled(base, offsets, epochs), "mix-schedule")
    budget = share * (targets.agg(F.sum("_all")).first()[0] or 0)
    cut = find_cut(light, budget)
    if list(keep) == [doc_id]:
        rows = light
    else:  # the whole rows go through the same windows once
        rows = _scheduled(docs.select(*order, F.struct(*keep).alias("row")), offsets, epochs)
    copies = sum((_included(F.get("_finish", F.lit(e)), cut).cast("int") for e in range(1, epochs)), _included(F.get("_finish", F.lit(0)), cut).cast("int"))
    return rows.select("row", F.col("_size").alias("size"), F.col("_all").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies"))


def report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row, with the words the mix takes of it."""
    s = schedule(docs, keep=[doc_id], doc_id=doc_id, **options)
    return s.select(F.col("row")[doc_id].alias(doc_id), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every document as often as it is taken, columns
    unchanged."""
    s = schedule(docs, keep=docs.columns, **options).where("copies > 0")
    return s.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
