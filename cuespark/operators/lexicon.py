"""Corpus-frequency lexicon and the substring-count feature (A1-A4).

All four operators work on *types* first: tokens are counted per
``(token, pos)`` with a partial (map-side) aggregate, so a hot token that
holds a third of the corpus becomes one row per task before the shuffle.
Character n-grams are exploded from the type table, weighted by the type
count, and summed again by ``(gram, pos)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cues import NEG_PREFIXES, NEG_SUFFIX, NGRAM_SIZE
from ..functions.text import start_ngrams, strip_affix


def type_counts(tokens: DataFrame, token: str = "token", pos: str | None = "pos") -> DataFrame:
    keys = [token] + ([pos] if pos else [])
    return tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def lexicon(tokens: DataFrame, n: int = NGRAM_SIZE, by_pos: bool = True, token: str = "token",
            pos: str = "pos") -> DataFrame:
    """A1 / A2: ``(gram[, pos], n)`` - each token counts once for itself and
    once for each word-initial n-gram of size 1..min(n, len); tokens of at
    most ``n`` characters therefore count twice for themselves."""
    keys = [pos] if by_pos else []
    return lexicon_from_types(type_counts(tokens, token, pos if by_pos else None), n, token, keys)


def affixed_types(tokens: DataFrame, token: str = "token", pos: str | None = "pos") -> DataFrame:
    """Distinct ``(token[, pos])`` whose negation affix leaves a non-empty base."""
    keys = [token] + ([pos] if pos else [])
    return (tokens.select(*keys).distinct()
                  .withColumn("base", strip_affix(token))
                  .where(F.length("base") > 0))


def lexicon_from_types(types: DataFrame, n: int = NGRAM_SIZE, token: str = "token", keys=("pos",)) -> DataFrame:
    """A1 from a type-count table ``(token, keys..., n)``."""
    grams = types.select(F.explode(F.concat(F.array(F.col(token)), start_ngrams(token, n))).alias("gram"),
                         *keys, "n")
    return grams.groupBy("gram", *keys).agg(F.sum("n").cast("long").alias("n"))


def sbs_counts(tokens: DataFrame, lex: DataFrame | None = None, n: int = NGRAM_SIZE,
               token: str = "token", pos: str = "pos") -> DataFrame:
    """A3 per type: ``(token, pos, sbs_count)`` for affixed types only - the
    sum over the word-initial n-grams of the stripped token of
    ``lexicon[(gram, pos)]``.  Lexicon and affixed types both come from one
    type-count aggregate of ``tokens``."""
    types = type_counts(tokens, token, pos)
    lex = lexicon_from_types(types, n, token, (pos,)) if lex is None else lex
    # tokens without affix strip to '' and explode no n-grams; no filter, and the
    # types' counts stay in use, so both branches share one type-count exchange
    grams = types.select(token, pos, F.col("n").alias("_n"), F.explode(start_ngrams(strip_affix(token), n)).alias("gram"))
    # longer entries, whole words, are never looked up: most of the lexicon is left out before it is summed
    return (grams.join(lex.where(F.length("gram") <= n), on=["gram", pos], how="left")
                 .groupBy(token, pos, "_n")
                 .agg(F.sum(F.coalesce(F.col("n"), F.lit(0))).cast("long").alias("sbs_count")).drop("_n"))


def has_affix(token):
    """Whether the negation affix of a token leaves a non-empty base; the base
    is made only for tokens that have a prefix or the suffix."""
    some = token.endswith(NEG_SUFFIX)
    for p in NEG_PREFIXES:
        some = some | token.startswith(p)
    return F.when(some, F.length(strip_affix(token)) > 0).otherwise(F.lit(False))


def text_sbs_counts(docs: DataFrame, tokens, per_type: DataFrame, pos_fn, text_col: str = "text", name: str = "_sbs") -> DataFrame:
    """A3 for document rows: ``docs`` with a map of the affixed tokens of each
    text to their ``sbs_count`` (null: none).

    ``tokens``: the text's token array, an expression.  Each text's distinct
    affixed tokens meet the types and come back as one map, found by the text's
    hash, so equal texts share it and ids may repeat or be null.  Token rows
    need no join then, and are made once."""
    x = docs.withColumn("_text", F.unhex(F.sha2(F.col(text_col), 256)))
    own = F.array_distinct(F.filter(tokens, has_affix))
    words = x.select("_text", F.explode(own).alias("token")).distinct().withColumn("pos", pos_fn(F.col("token")))
    found = words.join(per_type, ["token", "pos"]).where(F.col("sbs_count") > 0)
    maps = found.groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct("token", "sbs_count"))).alias(name))
    return x.join(maps, "_text", "left").drop("_text")


def sbs_of(tokens, counts):
    """``sbs_count`` of each token of an array by the map of ``text_sbs_counts``."""
    zero = F.lit(0).cast("long")
    return F.transform(tokens, lambda t: F.when(has_affix(t), F.coalesce(F.try_element_at(counts, t), zero)).otherwise(zero))


def _attach(tokens: DataFrame, per_type: DataFrame, keys, name: str, token: str) -> DataFrame:
    """Join ``name`` to the tokens that have an affix; for all others, most of
    the corpus and its most frequent words, it is 0 without a shuffle."""
    affixed = F.length(strip_affix(token)) > 0
    zero = F.lit(0).cast("long")
    hit = tokens.where(affixed).join(per_type, on=list(keys), how="left").withColumn(name, F.coalesce(F.col(name), zero))
    rest = tokens.where(~F.coalesce(affixed, F.lit(False))).withColumn(name, zero)
    return rest.unionByName(hit)


def with_sbs_count(tokens: DataFrame, lex: DataFrame | None = None, n: int = NGRAM_SIZE,
                   token: str = "token", pos: str = "pos", types_from: DataFrame | None = None) -> DataFrame:
    """A3: attach ``sbs_count`` (0 for tokens without affix)."""
    per_type = sbs_counts(tokens if types_from is None else types_from, lex, n, token, pos)
    return _attach(tokens, per_type, [token, pos], "sbs_count", token)


def with_sbs_count_exact(tokens: DataFrame, lex_nopos: DataFrame | None = None, token: str = "token") -> DataFrame:
    """A4: count of the whole affix-stripped token in the POS-free lexicon
    (0 without affix)."""
    lex_nopos = lexicon(tokens, by_pos=False, token=token) if lex_nopos is None else lex_nopos
    per_type = (affixed_types(tokens, token, None)
                .join(lex_nopos.withColumnRenamed("gram", "base"), on="base", how="left")
                .select(token, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("sbs_count_exact")))
    return _attach(tokens, per_type, [token], "sbs_count_exact", token)
