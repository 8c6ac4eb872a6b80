"""Token-level column expressions.

Every function takes and returns a ``Column`` built from Spark SQL built-ins,
so it stays inside whole-stage code generation and works unchanged on batch
and streaming DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cues import INFIX_ENDINGS, NEG_PREFIXES, NEG_SUFFIX, NGRAM_SIZE, ONE_WORD_CUES, PUNCTUATION


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(conds):
    return reduce(lambda a, b: a | b, conds)


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def lower_token(c) -> Column:
    """Lower-cased surface token."""
    return F.lower(_c(c))


def has_neg_prefix(c, prefixes=NEG_PREFIXES) -> Column:
    """1 when the token starts with a negation prefix."""
    c = _c(c)
    return _flag(_any([c.startswith(p) for p in prefixes]))


def has_neg_suffix(c, suffix=NEG_SUFFIX) -> Column:
    """1 when the token ends with the negation suffix."""
    return _flag(_c(c).endswith(suffix))


def has_neg_infix(c, endings=INFIX_ENDINGS) -> Column:
    """1 for forms such as ``carelessness`` / ``restlessly``."""
    c = _c(c)
    return _flag(_any([c.endswith(e) for e in endings]))


def match_one(c, cues=ONE_WORD_CUES) -> Column:
    """1 when the token is one of the one-word cues (an ``InSet``)."""
    return _flag(_c(c).isin(list(cues)))


def is_punct(c, chars=PUNCTUATION) -> Column:
    """1 when the token is a substring of the punctuation string, so the
    empty token and ``()`` count, ``--`` does not."""
    return _flag(F.lit(chars).contains(_c(c)))


def punct_chars(c, chars=PUNCTUATION) -> Column:
    """0/1 per character (code point) of the token; empty for ''."""
    c = _c(c)
    per_char = F.transform(
        F.sequence(F.lit(1), F.length(c)),
        lambda i: F.when(F.lit(chars).contains(F.substring(c, i, 1)), F.lit(1)).otherwise(F.lit(0)))
    return F.when(F.length(c) > 0, per_char).otherwise(F.array().cast("array<int>"))


def strip_affix(c, prefixes=NEG_PREFIXES, suffix=NEG_SUFFIX) -> Column:
    """the token without its negation affix; the suffix rule overrides a
    prefix; '' when there is no affix (or nothing is left)."""
    c = _c(c)
    expr = F.lit("")
    # later prefixes win, as a scan over the list that keeps the last match
    for p in prefixes:
        expr = F.when(c.startswith(p), c.substr(F.lit(len(p) + 1), F.length(c))).otherwise(expr)
    return F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(expr)


def _ngrams(c, n: int, side: str) -> Column:
    c = _c(c)
    take = F.left if side == "start" else F.right
    size = F.least(F.lit(n), F.coalesce(F.length(c), F.lit(0)))
    # all sizes as plain expressions, cut to those the token has (a lambda over
    # the sizes would evaluate the token's own expression once for each)
    return F.slice(F.array(*[take(c, F.lit(k)) for k in range(n, 0, -1)]), F.lit(n + 1) - size, size)


def start_ngrams(c, n: int = NGRAM_SIZE) -> Column:
    """F8: word-initial character n-grams of sizes min(n, len) .. 1."""
    return _ngrams(c, n, "start")


def end_ngrams(c, n: int = NGRAM_SIZE) -> Column:
    """word-final character n-grams of sizes min(n, len) .. 1."""
    return _ngrams(c, n, "end")


def affix_base(c) -> Column:
    """The affix-stripped token when non-empty, else the token itself."""
    s = strip_affix(c)
    return F.when(F.length(s) > 0, s).otherwise(_c(c))


def affix_ngrams(c, n: int = NGRAM_SIZE) -> Column:
    """struct(start, end) n-grams of the affix-stripped token, or of the
    token itself when stripping leaves nothing."""
    b = affix_base(c)
    return F.struct(start_ngrams(b, n).alias("start"), end_ngrams(b, n).alias("end"))


def token_flags(token_col="token"):
    """The per-token 0/1 features in feature-table order."""
    t = _c(token_col)
    return {
        "punct": is_punct(t),
        "prefix": has_neg_prefix(t),
        "suffix": has_neg_suffix(t),
        "infix": has_neg_infix(t),
    }
