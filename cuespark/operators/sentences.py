"""Feature projections and ordered grouping.

Grouped lists are always built from bounded groups: a sentence longer than
``max_len`` tokens becomes several consecutive pieces (every token kept, in
order), and a document's token list is emitted per block of positions.  No
unbounded group is ever collected into one row or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .context import _BLK, BLOCK
from .packing import block_rows, packed_blocks

MAX_SENTENCE = 1024

# Features the embedding variants represent as dense vectors instead of
# one-hot values (P10).
DENSE_TRAIN = ("token", "lemma", "prev", "next")
DENSE_PREDICT = ("prev", "next")


# The value of a feature that a row does not have.
MISSING = "<none>"


def feature_value(name: str) -> F.Column:
    """A feature column as a categorical value: its string, ``MISSING`` where
    it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def feature_pairs(names) -> F.Column:
    """``array('name=value', ...)`` over the chosen feature columns; every
    value is categorical."""
    return F.array(*[F.concat(F.lit(f"{n}="), feature_value(n)) for n in names])


def features_and_labels(df: DataFrame, names, label: str = "negcuelabel", keys=("doc_id", "token_id")) -> DataFrame:
    """Keys, ``feats`` array and the gold label."""
    return df.select(*keys, feature_pairs(names).alias("feats"), F.col(label).alias("label"))


def features_only(df: DataFrame, names, keys=("doc_id", "token_id")) -> DataFrame:
    """Keys and the ``feats`` array."""
    return df.select(*keys, feature_pairs(names).alias("feats"))


def get_label(df: DataFrame, col: str = "negcuelabel", keys=("doc_id", "token_id")) -> DataFrame:
    """P5: the label column (and keys)."""
    return df.select(*keys, F.col(col).alias("label"))


def first_n(docs: DataFrame, n: int = 40000, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The first ``n`` tokens in corpus order.  Documents that start at
    or after token ``n`` (from their token counts) are left out before the
    others are tokenised and cut."""
    from ..sources.documents import token_counts, tokenize
    from .context import document_offsets
    offsets = document_offsets(token_counts(docs, text, keep=(doc,)), doc).where(F.col("_doff") < n)
    kept = docs.join(offsets, doc)
    tokens = tokenize(kept, text, keep=(*[c for c in docs.columns if c != text], "_doff"))
    return tokens.where(F.col("_doff") + F.col("tok_id") < n).drop("_doff")


def split_features(names, variant: str = "train"):
    """P10: (dense, one_hot) split of a feature set for the vector models.

    train: token/lemma/prev/next become vectors; predict: only prev/next are
    removed (the fitted one-hot vocabulary ignores the rest); 'keep_words'
    keeps token and lemma one-hot.
    """
    if variant == "train":
        dense = DENSE_TRAIN
    elif variant == "predict":
        dense = DENSE_PREDICT
    elif variant == "keep_words":
        dense = DENSE_PREDICT
    else:
        raise ValueError(variant)
    one_hot = [n for n in names if n not in dense]
    vec = [n for n in ("lemma", "prev", "next") if n == "lemma" or n in names]
    return vec, one_hot


def sentences(df: DataFrame, cols=("token", "label"), keep_tail: bool = True, token: str = "token",
              end_token: str = ".", scope=("doc_id",), pos: str = "tok_id", max_len: int = MAX_SENTENCE) -> DataFrame:
    """One row per (sentence, piece) with position-ordered arrays of the
    given columns.  Token rows are shuffled once, as packed blocks of positions
    (``packing``); sentences that end in the block they begin in are cut from it.

    ``keep_tail=False`` drops the tokens after the last end token of each
    scope, as a reader that only closes a sentence at its end token does.
    """
    scope, fields = list(scope), list(dict.fromkeys([*cols, token]))
    blocks = packed_blocks(df, scope, pos, fields)
    # sentences and the last end before each block, from one row a block
    is_end = F.col(token) == F.lit(end_token)
    totals = (df.withColumn(_BLK, F.floor(F.col(pos) / F.lit(BLOCK)).cast("long")).groupBy(*scope, _BLK)
                .agg(F.sum(is_end.cast("long")).alias("_ends"), F.max(F.when(is_end, F.col(pos))).alias("_last")))
    before = Window.partitionBy(*scope).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*scope, _BLK, F.sum("_ends").over(before).alias("_seq0"), (F.max("_last").over(before) + 1).alias("_start0"))
    blocks = blocks.join(offsets, on=[*scope, _BLK], how="left")
    items = block_rows(df, pos, fields)
    if not keep_tail:
        last = df.where(is_end).groupBy(*scope).agg(F.max(pos).alias("_last_dot"))
        blocks = blocks.join(last, on=scope, how="inner")
        items = F.filter(items, lambda x: x["_p"] <= F.col("_last_dot"))
    # generated columns are computed once, not once for each element of a lambda
    x = blocks.select(*scope, _BLK, "_seq0", "_start0", F.inline(F.array(F.struct(items.alias("_items")))))
    n = F.size("_items")
    begins = F.concat(F.array(F.lit(0)), F.filter(F.transform("_items", lambda t, i: F.when(t[token] == F.lit(end_token), i + 1)), lambda i: i.isNotNull()))
    x = x.select("*", F.inline(F.array(F.struct(F.filter(begins, lambda i: i < n).alias("_begins")))))

    known = F.lit(True)
    for k in scope:
        known = known & F.col(k).isNotNull()

    def sentence(i, j):
        start = F.when(j == 0, F.coalesce("_start0", F.lit(0))).otherwise(F.get("_items", i - 1)["_p"] + 1)
        return F.struct((F.coalesce("_seq0", F.lit(0)) + j).cast("int").alias("sent_seq"), start.alias("_from"), j.alias("_j"),
                        F.slice("_items", i + 1, F.coalesce(F.get("_begins", j + 1), n) - i).alias("_items"))

    x = x.select(*scope, _BLK, F.inline(F.transform("_begins", sentence)))
    piece = lambda p: F.floor((p - F.col("_from")) / F.lit(max_len)).cast("int")
    first, final = F.col("_items")[0], F.element_at("_items", -1)
    # a sentence that ends in the block it begins in, not longer than a piece, is a row already
    whole = known & ((F.col("_j") > 0) | (F.col(_BLK) == 0)) & (final[token] == F.lit(end_token)) & (piece(first["_p"]) == piece(final["_p"]))
    x = x.select(*scope, F.inline(F.array(F.struct("sent_seq", "_from", "_items", F.coalesce(whole, F.lit(False)).alias("_whole")))))
    done = x.where("_whole").select(*scope, "sent_seq", piece(first["_p"]).alias("piece"), first["_p"].alias("start"),
                                    F.size("_items").cast("long").alias("n_tokens"), *[F.col("_items")[c].alias(c) for c in cols])
    # the others, parts of sentences, meet their other parts
    rest = x.where("not _whole").select(*scope, "sent_seq", "_from", F.explode("_items").alias("_i")).withColumn("piece", piece(F.col("_i")["_p"]))
    rest = (rest.groupBy(*scope, "sent_seq", "piece")
                .agg(F.min(F.col("_i")["_p"]).alias("start"), F.count(F.lit(1)).alias("n_tokens"),
                     F.array_sort(F.collect_list(F.struct(F.col("_i")["_p"].alias("_p"), *[F.col("_i")[c].alias(c) for c in cols]))).alias("_items")))
    return done.unionByName(rest.select(*scope, "sent_seq", "piece", "start", "n_tokens", *[F.col("_items")[c].alias(c) for c in cols]))


def token_list(df: DataFrame, token: str = "token", scope=("doc_id",), pos: str = "tok_id",
               block: int = BLOCK) -> DataFrame:
    """The ordered token list of each document, one row per block of
    ``block`` positions."""
    g = packed_blocks(df, scope, pos, [token], block)
    return g.select(*scope, F.col(_BLK).cast("int").alias("block"), F.col("_rows").alias("n_tokens"),
                    block_rows(df, pos, [token])[token].alias("tokens"))
