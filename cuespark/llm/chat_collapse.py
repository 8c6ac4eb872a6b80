"""Chat formatting by cumulative-snapshot collapse (1).

A logged conversation that is a prefix of a longer one, turn by turn, is a
snapshot of it.  Every turn is hashed with its position, and the hash of a
prefix is the exclusive-or of its turns' hashes (128 bits), so that it rolls:
each turn changes the hash of the prefix before it in constant time.  All
turns are range-sorted by conversation and number and written once; a
conversation is then a run of rows in one file or in several, however long
it is.  Running aggregates over a conversation's rows in a file, and over one
row per conversation and file, give the prefixes without ever gathering a
conversation.  Conversations whose whole hash is a proper prefix of another's
are anti-joined away, equal ones keep their smallest id, and only the texts
of the rest are rendered, in pieces of at most ``PIECE`` turns.

DataFrame functions only.  Both sides of the anti-join are distinct by
prefix, so a first turn or a conversation that a third of all rows share is
one row.

Defined results: rows with a null conversation id form one conversation;
turns are ordered by number, null first, and ties by role and text hash;
every row is a turn, repeated rows too; a null role or text differs from an
empty one but renders like it; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PIECE = 256    # turns of a rendered piece
START, END = "<|im_start|>", "<|im_end|>"

_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _turns(chats: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``c`` (struct of the id), ``t``, role, text and the two hashes of both,
    written in order, with the ``file`` and ``row`` they are in.  ``salt``
    only spreads equal rows over files."""
    said = [F.col(role), F.col(role).isNull(), F.col(text), F.col(text).isNull()]
    turns = chats.select(F.struct(F.col(conv).alias("id")).alias("c"), F.col(turn).cast("long").alias("t"), F.col(role).alias("role"), F.col(text).alias("text"),
                         F.xxhash64(*said).alias("h1"), F.xxhash64(F.lit(1), *said).alias("h2"), F.monotonically_increasing_id().alias("salt"))
    written = materialize(turns.orderBy("c", "t", "h1", "h2", "salt"), "turns")
    name = F.col("_metadata.file_name")
    file = F.struct(F.regexp_extract(name, r"part-(\d+)", 1).cast("long").alias("task"), F.regexp_extract(name, r"-c(\d+)\.", 1).cast("int").alias("part"))
    return written.select("c", "role", "text", "h1", "h2", file.alias("file"), F.col("_metadata.row_index").alias("row"))


def _starts(turns: DataFrame) -> DataFrame:
    """Per conversation and file: ``off``, by which a row's place in the file
    and its place in the conversation differ, and ``n``, all its turns."""
    runs = turns.groupBy("c", "file").agg(F.count(F.lit(1)).alias("k"), F.min("row").alias("first"))
    w = Window.partitionBy("c")
    before = F.coalesce(F.sum("k").over(w.orderBy("file").rowsBetween(*_BEFORE)), F.lit(0))
    return runs.select("c", "file", (before - F.col("first") + 1).alias("off"), F.sum("k").over(w).alias("n"))


def _positions(turns: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds ``at``, the place of a turn in its conversation, from 1."""
    return turns.join(starts, ["c", "file"]).withColumn("at", F.col("row") + F.col("off"))


def _mixed(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "at", "h1", "h2")


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """``c``, ``n``, ``at`` and the hash ``p1, p2`` of the prefix that ends
    at each turn."""
    z = placed.select("c", "file", "n", "at", _mixed(0).alias("z1"), _mixed(1).alias("z2"))
    runs = z.groupBy("c", "file").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2"))
    before = Window.partitionBy("c").orderBy("file").rowsBetween(*_BEFORE)
    runs = runs.select("c", "file", *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(b) for b in ("b1", "b2")])
    run = Window.partitionBy("c", "file").orderBy("at").rowsBetween(*_UPTO)
    z = z.select("c", "file", "n", "at", F.bit_xor("z1").over(run).alias("z1"), F.bit_xor("z2").over(run).alias("z2")).join(runs, ["c", "file"])
    return z.select("c", "n", "at", F.col("z1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("z2").bitwiseXOR(F.col("b2")).alias("p2"))


def _collapsed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    starts = materialize(_starts(turns), "turn-runs")
    prefixes = materialize(prefix_hashes(_positions(turns, starts)), "prefixes")
    whole = prefixes.where("at = n").groupBy("n", "p1", "p2").agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("copies"))
    proper = prefixes.where("at < n").select(F.col("at").alias("n"), "p1", "p2").distinct()
    return materialize(whole.join(proper, ["n", "p1", "p2"], "left_anti").select("c", "n", "copies"), "maximal"), starts


def maximal(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Id, turns and equal copies of every conversation that no other
    extends, the smallest id of equal ones."""
    kept, _ = _collapsed(_turns(chats, conv, turn, role, text))
    return kept.select(F.col("c.id").alias(conv), F.col("n").alias("n_turns"), "copies")


def render(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> DataFrame:
    """Maximal conversations as text: id, ``piece`` number, turns and copies
    of the conversation, and the rendered turns of the piece in order."""
    turns = _turns(chats, conv, turn, role, text)
    kept, starts = _collapsed(turns)
    said = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    rows = _positions(turns, starts.join(kept.select("c", "copies"), "c")).select("c", "n", "copies", "at", said.alias("said"), F.expr(f"(at - 1) div {piece}").cast("int").alias("piece"))
    parts = rows.groupBy("c", "piece").agg(F.first("n").alias("n"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("at", "said"))).alias("s"))
    return parts.select(F.col("c.id").alias(conv), "piece", F.col("n").alias("n_turns"), "copies", F.array_join("s.said", "").alias("text"))
