"""Base relations and the feature table.

``tokens``    documents -> (doc_id, lang, tok_id, token, lemma, pos)
``gold``      + prev_token and gold / system label columns (test annotation)
``features``  the 17-column feature table

From document text the feature table needs no shuffle for context: the
neighbour tokens and sentence numbers come from each document's token
array.  From an arbitrary token table (e.g. read from files) one
ordered-context shuffle (block windows) provides them.  Either way the
lexicon aggregate and its per-type join are the only other data movement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cues import MULTI_WORD_CUES, ONE_WORD_CUES, TEST_MULTI_WORD_CUES, TEST_ONE_WORD_CUES
from ..functions.text import match_one, token_flags
from ..operators.annotate import annotate_rules, rule_lemma, rule_pos
from ..operators.context import form_flag, literal_forms, ordered_context, span_forms, tokenize_with_context
from ..operators.lexicon import sbs_counts, sbs_of, text_sbs_counts, with_sbs_count
from ..sources.documents import documents_tokens, load_table, spread, token_array, tokenize

FEATURE_COLUMNS = ["doc_id", "sentence_id", "token_id", "token", "lemma", "prev", "next", "pos", "punct",
                   "prefix", "suffix", "infix", "prev_tok_cue", "sbs_count", "match_one", "match_multi",
                   "negcuelabel"]
FEATURE_NAMES = ["token", "lemma", "prev", "next", "pos", "punct", "prefix", "suffix", "infix", "sbs_count",
                 "match_one", "match_multi", "prev_tok_cue"]

# ---------------------------------------------------------------------------
# Fixed annotation rules for the synthetic test corpus: gold labels and two
# systems' predictions derived from the token and its predecessor.
# ---------------------------------------------------------------------------
GOLD_B = ["no", "without", "is", "was"]
GOLD_I = ["the", "a", "that", "it"]


def gold_rule(t, prev):
    return (F.when(t.isin(GOLD_B), F.lit("B-NEG"))
             .when(prev.isin(GOLD_B) & t.isin(GOLD_I), F.lit("I-NEG"))
             .otherwise(F.lit("O")))


def sys_a_rule(t, prev):
    return (F.when(t.isin(["no", "is"]), F.lit("B-NEG"))
             .when((prev == F.lit("is")) & (t == F.lit("the")), F.lit("I-NEG"))
             .otherwise(F.lit("O")))


def sys_b_rule(t, prev):
    return (F.when(t.isin(["no", "is", "was", "with"]), F.lit("B-NEG"))
             .when(t == F.lit("|"), F.lit("X-NEG"))
             .otherwise(F.lit("O")))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tok`` with rule lemma and pos."""
    return annotate_rules(documents_tokens(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feat``: tokens + prev_token + label, sys_a, sys_b; the previous token
    comes from the document's token array (no shuffle)."""
    return gold_of(_documents(spark, sf_dir))


def gold_of(docs: DataFrame, keep=("doc_id", "lang")) -> DataFrame:
    """``gold`` of given documents, with their columns ``keep``."""
    t = tokenize_with_context(docs, keep=keep, reach=1, end_token=None)
    t = (annotate_rules(t).withColumn("prev_token", F.when(F.col("tok_id") > 0, F.col("_p1")))
         .drop("_p1", "_f1"))
    tok, prev = F.col("token"), F.col("prev_token")
    return (t.withColumn("label", gold_rule(tok, prev))
             .withColumn("sys_a", sys_a_rule(tok, prev))
             .withColumn("sys_b", sys_b_rule(tok, prev)))


def lemma_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens with rule lemma/pos and the previous / next lemma ('' at the
    document edges), from the document token arrays (no shuffle)."""
    t = annotate_rules(tokenize_with_context(_documents(spark, sf_dir), reach=1, end_token=None))
    return (t.withColumn("prev", F.when(F.col("tok_id") > 0, rule_lemma(F.col("_p1"))).otherwise(F.lit("")))
             .withColumn("next", F.when(F.length("_f1") > 0, rule_lemma(F.col("_f1"))).otherwise(F.lit("")))
             .drop("_p1", "_f1"))


def features_from_tokens(tok: DataFrame, one_cues=ONE_WORD_CUES, multi_cues=MULTI_WORD_CUES,
                         multi_mode: str = "span", label_rule=gold_rule, keep_extra=()) -> DataFrame:
    """The 17-column feature table from a token table with lemma and pos.

    ``label_rule(token, prev_token)`` derives the gold label from context
    (test corpus); pass ``None`` when ``tok`` already has a ``label`` column,
    which is then lagged for ``prev_tok_cue`` in the same window.
    """
    shifts = {"prev": ("lemma", -1, ""), "next": ("lemma", 1, "")}
    for k in (1, 2, 3):
        shifts[f"_p{k}"] = ("token", -k, "")
        shifts[f"_f{k}"] = ("token", k, "")
    if label_rule is None:
        shifts["prev_tok_cue"] = ("label", -1, "0")
    ctx = ordered_context(tok, shifts, running={"sentence_id": (F.col("token") == ".").cast("int")}, packed=True)
    return _finish(ctx, one_cues, multi_cues, multi_mode, label_rule, keep_extra, types_from=tok)


def _finish(ctx: DataFrame, one_cues, multi_cues, multi_mode, label_rule, keep_extra,
            types_from: DataFrame | None = None) -> DataFrame:
    t = F.col("token")
    p = {k: F.col(f"_p{k}") for k in (1, 2, 3)}
    f = {k: F.col(f"_f{k}") for k in (1, 2, 3)}
    if label_rule is not None:
        ctx = (ctx.withColumn("label", label_rule(t, p[1]))
                  .withColumn("prev_tok_cue", F.when(F.col("tok_id") == 0, F.lit("0"))
                              .otherwise(label_rule(p[1], p[2]))))
    forms = span_forms(t, p, f) if multi_mode == "span" else literal_forms(t, p, f)
    flags = {**token_flags("token"), "match_one": match_one(t, one_cues),
             "match_multi": form_flag(forms, multi_cues, t if multi_mode == "span" else None)}
    out = ctx.select("*", *[v.alias(k) for k, v in flags.items()])
    if "sbs_count" not in out.columns:
        # the lexicon needs only (token, pos): count types before any shuffle
        types = ctx.select("token", "pos") if types_from is None else types_from
        out = with_sbs_count(out, types_from=types)
    return out.select(
        "doc_id", F.col("sentence_id").cast("int").alias("sentence_id"), F.col("tok_id").alias("token_id"),
        "token", "lemma", "prev", "next", "pos", "punct", "prefix", "suffix", "infix", "prev_tok_cue",
        "sbs_count", "match_one", "match_multi", F.col("label").alias("negcuelabel"), *keep_extra)


def features_from_documents(docs: DataFrame, one_cues=ONE_WORD_CUES, multi_cues=MULTI_WORD_CUES,
                            multi_mode: str = "span", label_rule=gold_rule, keep_extra=(),
                            lemma_fn=rule_lemma, pos_fn=rule_pos) -> DataFrame:
    """The 17-column feature table straight from document text.

    Neighbours and sentence numbers come from each document's token array
    (no shuffle); lemma and tag are token-level functions, so the previous
    and next lemma are the lemma of the neighbour token.  Only the lexicon
    aggregate, the affixed tokens of each text that meet its types, and the
    texts that meet their tokens' counts move data.
    """
    # type counts need only the tokens: a plain tokenize, not the context arrays
    types = tokenize(docs, keep=()).select("token", pos_fn(F.col("token")).alias("pos"))
    docs = text_sbs_counts(docs, token_array("text"), sbs_counts(types), pos_fn)
    ctx = tokenize_with_context(docs, keep=("doc_id", "lang"), reach=3, end_token=".",
                                extra={"sbs_count": lambda t: sbs_of(t, F.col("_sbs"))}, using=("_sbs",), starts=False)
    ctx = (ctx.withColumn("lemma", lemma_fn(F.col("token"))).withColumn("pos", pos_fn(F.col("token")))
              .withColumn("prev", F.when(F.col("tok_id") > 0, lemma_fn(F.col("_p1"))).otherwise(F.lit("")))
              .withColumn("next", F.when(F.length("_f1") > 0, lemma_fn(F.col("_f1"))).otherwise(F.lit("")))
              .withColumnRenamed("sent_seq", "sentence_id"))
    return _finish(ctx, one_cues, multi_cues, multi_mode, label_rule, keep_extra)


def features(spark: SparkSession, sf_dir: str, one_cues=TEST_ONE_WORD_CUES, multi_cues=TEST_MULTI_WORD_CUES,
             multi_mode: str = "span", keep_extra=()) -> DataFrame:
    """Feature table of the test corpus (test cue lists by default)."""
    return features_from_documents(_documents(spark, sf_dir), one_cues, multi_cues, multi_mode, gold_rule,
                                   keep_extra)
