"""Lemma / part-of-speech annotation.

A pretrained single-machine tagger is not a Spark job; annotation here is a
dictionary learned from a tagged token table (most frequent lemma and tag
per token, one partial aggregate) joined onto the corpus, with suffix rules
as the fallback for tokens the dictionary has not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.cues import PUNCTUATION
from .context import _BLK
from .lookup import join_chunks
from .packing import block_rows, packed_blocks


def rule_lemma(token="token"):
    """Suffix-stripping lemma: -ing (len > 5), -ed (len > 4), -s (len > 3)."""
    t = F.col(token) if isinstance(token, str) else token
    n = F.length(t)
    # the endings first: characters are counted only where one fits
    return (F.when(t.endswith("ing") & (n > 5), F.left(t, n - 3))
             .when(t.endswith("ed") & (n > 4), F.left(t, n - 2))
             .when(t.endswith("s") & (n > 3), F.left(t, n - 1))
             .otherwise(t))


def rule_pos(token="token"):
    """Suffix-based tag: PUNCT, VBG, VBD, RB, NNS, else NN."""
    t = F.col(token) if isinstance(token, str) else token
    return (F.when((F.length(t) == 1) & F.lit(PUNCTUATION).contains(t), F.lit("PUNCT"))
             .when(t.endswith("ing"), F.lit("VBG"))
             .when(t.endswith("ed"), F.lit("VBD"))
             .when(t.endswith("ly"), F.lit("RB"))
             .when(t.endswith("s"), F.lit("NNS"))
             .otherwise(F.lit("NN")))


def annotate_rules(df: DataFrame, token: str = "token") -> DataFrame:
    return df.withColumn("lemma", rule_lemma(token)).withColumn("pos", rule_pos(token))


def join_annotations(df: DataFrame, ann: DataFrame, keys=("doc_id", "tok_id"),
                     check: bool = False, wide: bool = False) -> DataFrame:
    """Attach annotation columns by key instead of by list position.

    With ``check=True`` the row counts of both sides and of the result are
    compared (one extra job) and a mismatch raises instead of truncating.

    Where the last key is a position, both sides meet as packed blocks of
    positions; blocks that hold the same positions once each are put side by
    side, the rows of others are joined one by one.  ``wide``: ``df`` has many
    columns and its rows in order, so it is not dealt out (``join_chunks``).
    """
    out = None
    if by_position(df, ann, keys):
        out = join_chunks(df, ann, list(keys)) if wide else None
        out = _joined_blocks(df, ann, list(keys)) if out is None else out
    out = df.join(ann, on=list(keys), how="inner") if out is None else out
    if check:
        a, b, c = df.count(), ann.count(), out.count()
        if not (a == b == c):
            raise ValueError(f"annotation join lost rows: tokens={a} annotations={b} joined={c}")
    return out


def by_position(df: DataFrame, ann: DataFrame, keys) -> bool:
    """Whether rows can be packed: keys of one kind on both sides, the last a
    whole number, and columns of different names."""
    kinds = [(df.schema[k].dataType, ann.schema[k].dataType) for k in keys]
    named = {c for c in df.columns if c not in keys} & set(ann.columns)
    return len(keys) > 1 and isinstance(kinds[-1][0], IntegralType) and all(a == b for a, b in kinds) and not named


def _joined_blocks(df: DataFrame, ann: DataFrame, keys: list) -> DataFrame:
    *scope, pos = keys
    sides = [(t, [c for c in t.columns if c not in keys]) for t in (df, ann)]
    one, two = [packed_blocks(t, scope, pos, cols).select(*scope, _BLK, F.col("_runs").alias(f"_r{i}")) for i, (t, cols) in enumerate(sides)]
    # judged by its bytes, a packed side would be sent through the driver
    both = one.hint("merge").join(two, on=[*scope, _BLK], how="inner")
    # judged by their positions alone, so that rows are unpacked once
    places = [block_rows(t, pos, [], f"_r{i}")["_p"].alias(f"_p{i}") for i, (t, _) in enumerate(sides)]
    both = both.select(*scope, "_r0", "_r1", F.inline(F.array(F.struct(*places))))
    same = (F.col("_p0") == F.col("_p1")) & (F.size(F.array_distinct("_p0")) == F.size("_p0")) & ~F.exists("_p0", lambda p: p.isNull())
    both = both.select(*scope, "_r0", "_r1", F.inline(F.array(F.struct(F.coalesce(same, F.lit(False)).alias("_same")))))
    rows = [block_rows(t, pos, cols, f"_r{i}").alias(f"_s{i}") for i, (t, cols) in enumerate(sides)]
    both = both.select(*scope, "_same", F.inline(F.array(F.struct(*rows))))
    columns = [F.col(f"_s{i}")[c].alias(c) for i, (_, cols) in enumerate(sides) for c in cols]
    out = both.where("_same").select(*scope, F.inline(F.arrays_zip(F.col("_s0")["_p"].alias(pos), *columns)))
    left, right = [both.where("not _same").select(*scope, F.inline(f"_s{i}")).withColumnRenamed("_p", pos) for i in (0, 1)]
    return out.unionByName(left.join(right, on=keys, how="inner")).select(*keys, *[c for _, cols in sides for c in cols])


def build_annotator(tagged: DataFrame, token: str = "token", lemma: str = "lemma", pos: str = "pos") -> DataFrame:
    """J2 (fit): ``(token, lemma, pos)`` - per token the most frequent
    (pos, lemma) pair; ties go to the smallest pos, then smallest lemma.

    ``min(struct(-count, pos, lemma))`` is an ordinary aggregate with a
    partial phase, so frequent tokens are combined map-side.
    """
    pairs = tagged.groupBy(token, pos, lemma).agg(F.count(F.lit(1)).alias("_n"))
    best = pairs.groupBy(token).agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col(pos).alias("p"),
                                                   F.col(lemma).alias("l"))).alias("_b"))
    return best.select(token, F.col("_b.l").alias(lemma), F.col("_b.p").alias(pos))


def annotate_by_lexicon(df: DataFrame, annotator: DataFrame, token: str = "token") -> DataFrame:
    """J2 (apply): dictionary lemma/pos, rule fallback for unseen tokens."""
    a = annotator.select(F.col(token), F.col("lemma").alias("_dl"), F.col("pos").alias("_dp"))
    return (df.join(a, on=token, how="left")
              .withColumn("lemma", F.coalesce(F.col("_dl"), rule_lemma(token)))
              .withColumn("pos", F.coalesce(F.col("_dp"), rule_pos(token)))
              .drop("_dl", "_dp"))
