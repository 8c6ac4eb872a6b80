"""Column expressions on words and lines, shared by the line operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]"          # [\x20\x09-\x0D]
HAS_WORD = r"[^ \t-\r]"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else unchanged.  ``lower`` does that, and faster,
    on a string of ASCII characters only."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def strip_space(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def hold(df: DataFrame, keep, **columns: Column) -> DataFrame:
    """``keep`` columns and ``columns``, computed once per row.  The generator
    keeps the optimizer from moving their expressions into lambdas above,
    where they would be computed for every element."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))
