"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query runs the library operators over the whole given tables; the
DuckDB statement of the same result lives in ``oracle.ORACLE``.  Array
results are rendered with ``array_join`` so both engines compare scalars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.cues import MULTI_WORD_CUES, ONE_WORD_CUES, TEST_LONG_CUES, TEST_MULTI_WORD_CUES, TEST_ONE_WORD_CUES
from ..operators import context as C
from ..operators import lexicon as L
from ..sources.documents import documents_tokens, load_table, spread, token_counts, tokenize
from ..session import apply_runtime_defaults
from . import relations as R

QUERIES = {}


def register(name):
    def deco(fn):
        def run(spark, sf_dir):
            apply_runtime_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _tok(spark, sf_dir):
    return documents_tokens(spark, sf_dir)


def _raw_tok(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenize(spread(docs), keep=("doc_id",), lowercase=False)


# --------------------------------------------------------------------------
# S7, P1, F1-F10
# --------------------------------------------------------------------------

@register("tokenize_documents")
def q_tokenize(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "lang", "tok_id", "token")


@register("lower_token")
def q_lower(spark, sf_dir):
    return _raw_tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.lower_token("token").alias("lower_token"))


@register("has_neg_prefix")
def q_prefix(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.has_neg_prefix("token").alias("prefix"))


@register("has_neg_suffix")
def q_suffix(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.has_neg_suffix("token").alias("suffix"))


@register("has_neg_infix")
def q_infix(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.has_neg_infix("token").alias("infix"))


@register("match_one")
def q_match_one(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token",
                                      T.match_one("token", TEST_ONE_WORD_CUES).alias("match_one"),
                                      T.match_one("token", ONE_WORD_CUES).alias("match_one_ref"))


@register("is_punct")
def q_punct(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.is_punct("token").alias("punct"))


@register("punct_chars")
def q_punct_chars(spark, sf_dir):
    pc = T.punct_chars("token")
    return _raw_tok(spark, sf_dir).select(
        "doc_id", "tok_id", "token", F.array_join(F.transform(pc, lambda x: x.cast("string")), "").alias("punct_chars"))


@register("strip_affix")
def q_strip(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", T.strip_affix("token").alias("stripped"))


@register("start_ngrams")
def q_start(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token",
                                      F.array_join(T.start_ngrams("token"), "|").alias("start_ngrams"))


@register("end_ngrams")
def q_end(spark, sf_dir):
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token",
                                      F.array_join(T.end_ngrams("token"), "|").alias("end_ngrams"))


@register("affix_ngrams")
def q_affix_ngrams(spark, sf_dir):
    g = T.affix_ngrams("token")
    return _tok(spark, sf_dir).select("doc_id", "tok_id", "token", F.array_join(g["start"], "|").alias("affix_start"),
                                      F.array_join(g["end"], "|").alias("affix_end"))


# --------------------------------------------------------------------------
# W1-W8
# --------------------------------------------------------------------------

@register("prev_lemma")
def q_prev_lemma(spark, sf_dir):
    return C.prev_next_lemma(R.tokens(spark, sf_dir)).select("doc_id", "tok_id", "lemma", "prev")


@register("next_lemma")
def q_next_lemma(spark, sf_dir):
    return C.prev_next_lemma(R.tokens(spark, sf_dir)).select("doc_id", "tok_id", "lemma", "next")


@register("prev_label")
def q_prev_label(spark, sf_dir):
    return C.prev_label(R.gold(spark, sf_dir)).select("doc_id", "tok_id", "label", "prev_tok_cue")


def _multi(spark, sf_dir, mode):
    tok = _tok(spark, sf_dir)
    out = C.match_multi(tok, {"match_multi": TEST_MULTI_WORD_CUES, "match_multi_ref": MULTI_WORD_CUES}, mode=mode)
    return out.select("doc_id", "tok_id", "token", "match_multi", "match_multi_ref")


@register("match_multi_literal")
def q_multi_literal(spark, sf_dir):
    return _multi(spark, sf_dir, "literal")


@register("match_multi")
def q_multi_span(spark, sf_dir):
    return _multi(spark, sf_dir, "span")


@register("sentence_seq")
def q_sentence_seq(spark, sf_dir):
    return C.sentence_seq(_tok(spark, sf_dir)).select("doc_id", "tok_id", "token", "sent_seq")


@register("context_tokens")
def q_context_tokens(spark, sf_dir):
    return C.context_tokens(_raw_tok(spark, sf_dir), wrap=True).select("doc_id", "tok_id", "prev_token", "next_token")


@register("corpus_position")
def q_corpus_position(spark, sf_dir):
    docs = spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    # the offset is a fact of the document: joined before the text is tokenised
    tok = tokenize(docs.join(C.document_offsets(token_counts(docs)), "doc_id"), keep=("doc_id", "_doff"))
    return tok.select("doc_id", "tok_id", (F.col("_doff") + F.col("tok_id")).cast("long").alias("corpus_pos"))


# --------------------------------------------------------------------------
# W5 for cues of any length; W1, W2, W4, W7 over document borders
# --------------------------------------------------------------------------

def _texts(spark, sf_dir):
    return spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("match_cues")
def q_match_cues(spark, sf_dir):
    return C.match_cues(_texts(spark, sf_dir), TEST_MULTI_WORD_CUES + TEST_LONG_CUES)


@register("prev_next_lemma_corpus")
def q_prev_next_lemma_corpus(spark, sf_dir):
    tok = C.corpus_context(_texts(spark, sf_dir), reach=1)
    return tok.select("doc_id", "tok_id", "corpus_pos", *[
        F.when(F.length(c) > 0, R.rule_lemma(F.col(c))).otherwise("").alias(n)
        for n, c in (("lemma", "token"), ("prev", "_p1"), ("next", "_f1"))])


@register("context_tokens_corpus")
def q_context_tokens_corpus(spark, sf_dir):
    tok = C.corpus_context(_texts(spark, sf_dir), reach=1, wrap=True, after=1, lowercase=False)
    return tok.select("doc_id", "tok_id", F.lower("_p1").alias("prev_token"), F.lower("_f1").alias("next_token"))


@register("match_multi_literal_corpus")
def q_multi_literal_corpus(spark, sf_dir):
    tok = C.corpus_context(_texts(spark, sf_dir), wrap=True)
    return tok.select("doc_id", "tok_id", "token", C.cue_flag(TEST_MULTI_WORD_CUES, "literal").alias("match_multi"),
                      C.cue_flag(MULTI_WORD_CUES, "literal").alias("match_multi_ref"))


# --------------------------------------------------------------------------
# A1-A5, feature table
# --------------------------------------------------------------------------

@register("lexicon")
def q_lexicon(spark, sf_dir):
    return L.lexicon(R.tokens(spark, sf_dir)).select("gram", "pos", "n")


@register("lexicon_nopos")
def q_lexicon_nopos(spark, sf_dir):
    return L.lexicon(_tok(spark, sf_dir), by_pos=False).select("gram", "n")


@register("sbs_count")
def q_sbs(spark, sf_dir):
    return L.with_sbs_count(R.tokens(spark, sf_dir)).select("doc_id", "tok_id", "token", "pos", "sbs_count")


@register("sbs_count_exact")
def q_sbs_exact(spark, sf_dir):
    return L.with_sbs_count_exact(_tok(spark, sf_dir)).select("doc_id", "tok_id", "token", "sbs_count_exact")


@register("label_counts")
def q_label_counts(spark, sf_dir):
    from ..operators.evaluate import label_counts
    return label_counts(R.gold(spark, sf_dir))


@register("feature_table")
def q_feature_table(spark, sf_dir):
    return R.features(spark, sf_dir).select(*R.FEATURE_COLUMNS)


@register("flags_by_lang")
def q_flags_by_lang(spark, sf_dir):
    """The minimum end-to-end slice: tokenise, flag, substring counts, then
    aggregate per language."""
    feats = R.features(spark, sf_dir, keep_extra=("lang",))
    return flags_by_lang(feats)


def flags_by_lang(feats: DataFrame) -> DataFrame:
    s = lambda c: F.sum(c).cast("long")
    return feats.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_tokens"), s("punct").alias("punct"), s("prefix").alias("prefix"),
        s("suffix").alias("suffix"), s("infix").alias("infix"), s("match_one").alias("match_one"),
        s("sbs_count").alias("sbs_count"), s(F.when(F.col("sbs_count") > 0, 1).otherwise(0)).alias("n_sbs"))


# --------------------------------------------------------------------------
# P2-P5, P8, A6, A7
# --------------------------------------------------------------------------

from ..operators import sentences as S  # noqa: E402

PAIR_NAMES = ["token", "lemma", "pos", "punct", "sbs_count", "prev_tok_cue"]


@register("select_features")
def q_select_features(spark, sf_dir):
    f = R.features(spark, sf_dir)
    return f.select("doc_id", "token_id", F.array_join(S.feature_pairs(PAIR_NAMES), " ").alias("feats"))


@register("features_and_labels")
def q_features_and_labels(spark, sf_dir):
    x = S.features_and_labels(R.features(spark, sf_dir), PAIR_NAMES)
    return x.select("doc_id", "token_id", F.array_join("feats", " ").alias("feats"), "label")


@register("features_only")
def q_features_only(spark, sf_dir):
    x = S.features_only(R.features(spark, sf_dir), ["lemma", "prev", "next", "match_multi"])
    return x.select("doc_id", "token_id", F.array_join("feats", " ").alias("feats"))


@register("get_label")
def q_get_label(spark, sf_dir):
    return S.get_label(R.features(spark, sf_dir))


@register("first_n_tokens")
def q_first_n(spark, sf_dir):
    docs = spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return S.first_n(docs, 40000).select("doc_id", "tok_id", "token")


def _sentences(spark, sf_dir, keep_tail):
    s = S.sentences(R.gold(spark, sf_dir), cols=("token", "label"), keep_tail=keep_tail)
    return s.select("doc_id", "sent_seq", "piece", "start", "n_tokens", F.array_join("token", " ").alias("tokens"),
                    F.array_join("label", " ").alias("labels"))


@register("sentences")
def q_sentences(spark, sf_dir):
    return _sentences(spark, sf_dir, True)


@register("sentences_drop_tail")
def q_sentences_drop_tail(spark, sf_dir):
    return _sentences(spark, sf_dir, False)


@register("token_list")
def q_token_list(spark, sf_dir):
    t = S.token_list(_tok(spark, sf_dir))
    return t.select("doc_id", "block", "n_tokens", F.array_join("tokens", " ").alias("tokens"))


# --------------------------------------------------------------------------
# J1, J2, S6, J3, J4, M1
# --------------------------------------------------------------------------

from ..operators import annotate as An  # noqa: E402
from ..operators import vectors as V  # noqa: E402


@register("join_annotations")
def q_join_annotations(spark, sf_dir):
    tok = _tok(spark, sf_dir).select("doc_id", "tok_id", "token")
    ann = An.annotate_rules(_tok(spark, sf_dir)).select("doc_id", "tok_id", "lemma", "pos")
    return An.join_annotations(tok, ann).select("doc_id", "tok_id", "token", "lemma", "pos")


def tagged_sample(spark, sf_dir):
    """Tagged token table for the dictionary annotator: tokens of the
    documents listed in ``labels``, tagged with the suffix rules except that a
    word after an article is tagged NN."""
    g = R.gold(spark, sf_dir)
    labelled = load_table(spark, sf_dir, "labels").select("doc_id")
    g = g.join(labelled, "doc_id", "left_semi")
    tag = F.when(F.col("prev_token").isin("the", "a"), F.lit("NN")).otherwise(F.col("pos"))
    return g.select("token", "lemma", tag.alias("pos"))


@register("annotate_lexicon")
def q_annotate_lexicon(spark, sf_dir):
    annotator = An.build_annotator(tagged_sample(spark, sf_dir))
    out = An.annotate_by_lexicon(_tok(spark, sf_dir), annotator)
    return out.select("doc_id", "tok_id", "token", "lemma", "pos")


def _vsum(c):
    return F.round(F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double")), 5)


def _emb(spark, sf_dir):
    return V.vectors_by_frequency(_tok(spark, sf_dir), load_table(spark, sf_dir, "embeddings"))


@register("scan_embeddings")
def q_scan_embeddings(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("word", "vec_id", F.size("embedding").alias("dims"), _vsum(F.col("embedding")).alias("vsum"),
                    _vsum(F.transform("embedding", lambda x: x * x)).alias("vsumsq"))


def _dim(spark, sf_dir):
    return V.vector_dim(load_table(spark, sf_dir, "embeddings"))


@register("embedding_lookup")
def q_embedding_lookup(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    dim = _dim(spark, sf_dir)
    x = V.embed(R.tokens(spark, sf_dir), "lemma", emb, dim, out="vec")
    return x.select("doc_id", "tok_id", "lemma", F.size("vec").alias("dims"), _vsum(F.col("vec")).alias("vsum"))


@register("embedding_context")
def q_embedding_context(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    dim = _dim(spark, sf_dir)
    x = V.embed_context(R.lemma_context(spark, sf_dir), emb, ["lemma", "prev", "next"], dim)
    return x.select("doc_id", "tok_id", F.size("dense").alias("dims"), _vsum(F.col("dense")).alias("vsum"),
                    _vsum(F.slice("dense", dim + 1, dim)).alias("vsum_prev"))


ONE_HOT_NAMES = ["lemma", "pos", "prefix", "sbs_count", "prev_tok_cue"]


@register("one_hot")
def q_one_hot(spark, sf_dir):
    return V.vocabulary_table(R.features(spark, sf_dir), ONE_HOT_NAMES)


# --------------------------------------------------------------------------
# A8-A14, J5, J7, P6, P7, P9, M14
# --------------------------------------------------------------------------

from ..operators import evaluate as Ev  # noqa: E402

SYSTEMS = {"sys_a": "sys_a", "sys_b": "sys_b"}


def _pairs(spark, sf_dir):
    return Ev.stack_systems(R.gold(spark, sf_dir), SYSTEMS)


def _conf(spark, sf_dir):
    return Ev.confusion(_pairs(spark, sf_dir))


def _r6(df, cols):
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), 6))
    return df


@register("confusion_counts")
def q_confusion_counts(spark, sf_dir):
    return _conf(spark, sf_dir).select("system", "gold", "pred", "n")


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return Ev.confusion_matrix(_conf(spark, sf_dir))


@register("pr_stats")
def q_pr_stats(spark, sf_dir):
    return Ev.pr_stats(_conf(spark, sf_dir))


@register("prf")
def q_prf(spark, sf_dir):
    return _r6(Ev.prf(_conf(spark, sf_dir), with_avg=False), ["precision", "recall", "fscore"])


@register("macro_avg")
def q_macro_avg(spark, sf_dir):
    p = Ev.prf(_conf(spark, sf_dir))
    return _r6(p.where(F.col("class") == "avg"), ["precision", "recall", "fscore"])


@register("classification_report")
def q_report(spark, sf_dir):
    return _r6(Ev.classification_report(_conf(spark, sf_dir)), ["precision", "recall", "f1", "support"])


@register("distinct_classes")
def q_classes(spark, sf_dir):
    return Ev.gold_classes(_conf(spark, sf_dir))


@register("evaluate_systems")
def q_evaluate_systems(spark, sf_dir):
    return _r6(Ev.prf(_conf(spark, sf_dir)), ["precision", "recall", "fscore"])


@register("score_lookup")
def q_score_lookup(spark, sf_dir):
    long = Ev.scores_long(Ev.prf(_conf(spark, sf_dir)))
    return _r6(Ev.score(long, "sys_a", "O", "f-score"), ["value"])


@register("filter_mismatch")
def q_filter_mismatch(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.where(F.col("gold") != F.col("pred")).select("system", "doc_id", "tok_id", "gold", "pred")


def _sys_b_pred(spark, sf_dir):
    return R.gold(spark, sf_dir).select("doc_id", F.col("tok_id").alias("token_id"), F.col("sys_b").alias("pred"))


@register("error_rows")
def q_error_rows(spark, sf_dir):
    return Ev.error_rows(R.features(spark, sf_dir), _sys_b_pred(spark, sf_dir), keys=("doc_id", "token_id"))


@register("filter_category")
def q_filter_category(spark, sf_dir):
    return Ev.error_rows(R.features(spark, sf_dir), _sys_b_pred(spark, sf_dir), keys=("doc_id", "token_id"),
                         category="I-NEG")


@register("gold_vs_system")
def q_gold_vs_system(spark, sf_dir):
    g = R.gold(spark, sf_dir)
    last = g.where(F.col("token") == ".").groupBy("doc_id").agg(F.max("tok_id").alias("_last"))
    # the last end token is a fact of the document: joined before it is tokenised
    cut = R.gold_of(R._documents(spark, sf_dir).join(last, "doc_id"), keep=("doc_id", "_last"))
    sa = (cut.where(F.col("tok_id") <= F.col("_last"))
           .select("doc_id", "tok_id", F.lit("sys_a").alias("system"), F.col("sys_a").alias("pred")))
    sb = g.select("doc_id", "tok_id", F.lit("sys_b").alias("system"), F.col("sys_b").alias("pred"))
    return Ev.unpaired(g, sa.unionByName(sb), ["sys_a", "sys_b"])


# --------------------------------------------------------------------------
# Written under the shared checkpoint folder, read back
# --------------------------------------------------------------------------

from pyspark.sql import types as Ty  # noqa: E402

from ..session import materialize, scratch_path  # noqa: E402
from ..sources import conll as IO  # noqa: E402


def _raw_token_table(spark, sf_dir):
    # what is packed is not pruned: the columns that the table has
    g = C.sentence_seq(R.gold(spark, sf_dir).select("doc_id", "tok_id", "token", "label"), packed=True)
    return g.select("doc_id", F.col("sent_seq").alias("sentence_id"), F.col("tok_id").alias("token_id"),
                    "token", "label")


@register("scan_tokens")
def q_scan_tokens(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    IO.write_token_lines(_raw_token_table(spark, sf_dir), path)
    return IO.read_tokens(spark, path, Ty.LongType())


@register("drop_blank_rows")
def q_drop_blank(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    IO.write_token_lines(_raw_token_table(spark, sf_dir), path)
    x = IO.read_lines_drop_blank(spark, path)
    return x.select(F.col("c0").cast("long").alias("doc_id"), F.col("c1").cast("int").alias("sentence_id"),
                    F.col("c2").cast("int").alias("token_id"), F.col("c3").alias("token"), F.col("c4").alias("label"))


def _written_features(spark, sf_dir):
    path = scratch_path(spark, "features")
    IO.write_features(R.features(spark, sf_dir), path)
    return path


@register("write_features")
def q_write_features(spark, sf_dir):
    return IO.read_features(spark, _written_features(spark, sf_dir), Ty.LongType())


@register("scan_features")
def q_scan_features(spark, sf_dir):
    return IO.read_features(spark, _written_features(spark, sf_dir), Ty.LongType())


@register("scan_label_column")
def q_scan_labels(spark, sf_dir):
    """S4 on a feature table: column found by the header's name."""
    labels = IO.read_labels(spark, _written_features(spark, sf_dir))
    return labels.withColumn("doc_id", F.col("doc_id").cast("long"))


def _predictions(spark, sf_dir, columns=tuple(R.FEATURE_COLUMNS)):
    """Feature rows (``columns``) with the labels of both rule systems: joined as
    blocks and written once, a row for each token; systems are told apart as it
    is read."""
    f = R.features(spark, sf_dir).select(*columns)
    g = R.gold(spark, sf_dir).select("doc_id", F.col("tok_id").alias("token_id"), "sys_a", "sys_b")
    x = materialize(An.join_annotations(f, g, ["doc_id", "token_id"], wide=True), "predictions")
    each = F.array(*[F.struct(F.lit(n).alias("system"), F.col(c).alias("predicted")) for n, c in SYSTEMS.items()])
    return x.select(*columns, F.inline(each))


@register("write_predictions")
def q_write_predictions(spark, sf_dir):
    """K2: fitted models' predictions, one table per (model, feature set):
    the 17 input columns and the prediction."""
    f = _split_features(spark, sf_dir)
    base, parts = scratch_path(spark, "predictions"), []
    for names in (["lemma", "pos"], ["lemma", "pos", "prev_tok_cue"]):
        model = M.train(f.where(F.col("split") == "train"), names, kind="nb")
        out = model.predict(f.where(F.col("split") == "test"))
        parts.append(out.select(F.lit("nb").alias("model"), F.lit("_".join(names)).alias("feature_set"), *R.FEATURE_COLUMNS, "predicted"))
    IO.write_predictions(parts[0].unionByName(parts[1]), base)
    return IO.read_predictions(spark, base, Ty.LongType())


def _system_files(spark, sf_dir):
    base = scratch_path(spark, "predictions")
    IO.write_system_files(_predictions(spark, sf_dir), base, "run", SYSTEMS)
    return base


@register("scan_systems")
def q_scan_systems(spark, sf_dir):
    rows = IO.read_system_files(spark, _system_files(spark, sf_dir), "run", IO.feature_schema(Ty.LongType(), ("predicted",)))
    return rows.select("system", "doc_id", "token_id", "token", "negcuelabel", "predicted")


@register("evaluate_files")
def q_evaluate_files(spark, sf_dir):
    """M14 on files: every ``run*.txt`` prediction table joined with the gold
    label column of the feature table (J7), ids as strings."""
    systems = IO.read_system_files(spark, _system_files(spark, sf_dir), "run")
    systems = systems.select("system", "doc_id", F.col("token_id").cast("int").alias("token_id"), "predicted")
    gold = IO.read_labels(spark, _written_features(spark, sf_dir))
    pairs = Ev.pair(gold, systems, keys=("doc_id", "token_id"), gold_col="negcuelabel", pred_col="predicted")
    return _r6(Ev.prf(Ev.confusion(pairs)), ["precision", "recall", "fscore"])


@register("evaluate_by_position")
def q_evaluate_by_position(spark, sf_dir):
    """M14 on files without keys: a gold table and two system tables that hold
    labels only, paired line by line."""
    base, gold = scratch_path(spark, "labels"), scratch_path(spark, "gold")
    rows = _predictions(spark, sf_dir, ("doc_id", "token_id", "negcuelabel"))
    for name in SYSTEMS:
        one = rows.where(F.col("system") == name)
        IO.write_ordered(one, f"{base}/run_{name}.txt", ("doc_id", "token_id"), ["predicted"])
    IO.write_ordered(one, gold, ("doc_id", "token_id"), ["negcuelabel"])
    systems = IO.read_system_lines(spark, base, "run", "predicted")
    pairs = Ev.pair(IO.read_label_lines(spark, gold), systems, keys=("line",), gold_col="negcuelabel", pred_col="predicted")
    return _r6(Ev.prf(Ev.confusion(pairs)), ["precision", "recall", "fscore"])


@register("preprocess_file")
def q_preprocess_file(spark, sf_dir):
    """The main pipeline: a labelled token file (six columns, string ids,
    label last) -> features -> feature file."""
    raw, out = scratch_path(spark, "labelled"), scratch_path(spark, "features")
    named = _raw_token_table(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    IO.write_token_lines(named.withColumn("c4", F.lit("_")), raw, ("doc_id", "sentence_id", "token_id", "token", "c4", "label"))
    tok = An.annotate_rules(IO.read_tokens(spark, raw)).withColumnRenamed("token_id", "tok_id").drop("sentence_id")
    IO.write_features(R.features_from_tokens(tok, TEST_ONE_WORD_CUES, TEST_MULTI_WORD_CUES, label_rule=None), out)
    return IO.read_features(spark, out)


@register("write_errors")
def q_write_errors(spark, sf_dir):
    path = scratch_path(spark, "errors")
    err = Ev.error_rows(R.features(spark, sf_dir), _sys_b_pred(spark, sf_dir), keys=("doc_id", "token_id"))
    IO.write_errors(err, path)
    return IO.read_tsv(spark, path, IO.feature_schema(Ty.LongType(), ("predictedlabel",)))


CONTEXT_SCHEMA = Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in ("token", "prev", "next")] +
                               [Ty.StructField(c, Ty.IntegerType()) for c in ("infix", "match_one", "match_multi")])


@register("write_context_features")
def q_write_context(spark, sf_dir):
    tok = _tok(spark, sf_dir)
    # the flag is a number, the neighbours are strings: cues go first
    ctx = C.match_multi(tok.select("doc_id", "tok_id", "token"), TEST_MULTI_WORD_CUES, mode="span", packed=True)
    ctx = C.context_tokens(ctx, wrap=True, packed=True)
    out = ctx.select("token", F.col("prev_token").alias("prev"), F.col("next_token").alias("next"),
                     T.has_neg_infix("token").alias("infix"), T.match_one("token", TEST_ONE_WORD_CUES).alias("match_one"),
                     "match_multi")
    path = scratch_path(spark, "context")
    IO.write_context(out, path)
    return IO.read_tsv(spark, path, CONTEXT_SCHEMA, header=False)


# --------------------------------------------------------------------------
# Learning operators.  Naive Bayes has a closed form, so
# its predictions are compared row by row; of the iterative models the queries
# return facts that SQL can count.
# --------------------------------------------------------------------------

from . import models as M  # noqa: E402

LABELS = ["B-NEG", "I-NEG", "O"]


def _split_features(spark, sf_dir):
    return materialize(M.split_documents(R.features(spark, sf_dir)), "features")


def prediction_facts(pred, by=("split",), label="negcuelabel"):
    """Per group: rows, rows without a prediction, predictions outside the
    label domain, and whether accuracy reaches the majority label's share."""
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    majority = F.greatest(*[count(F.col(label) == v) for v in LABELS])
    return pred.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), count(F.col("predicted").isNull()).alias("n_unpredicted"),
                                 count(~F.col("predicted").isin(LABELS)).alias("n_foreign"),
                                 (count(F.col("predicted") == F.col(label)) >= majority).alias("reaches_majority"))


def _predicted(spark, sf_dir, kind):
    f = _split_features(spark, sf_dir)
    return M.train(f.where(F.col("split") == "train"), kind=kind).predict(f)


@register("train_nb")
def q_train_nb(spark, sf_dir):
    return _predicted(spark, sf_dir, "nb").select("doc_id", "token_id", "split", "negcuelabel", "predicted")


def _emb_features(spark, sf_dir):
    f = _split_features(spark, sf_dir)
    emb = materialize(_emb(spark, sf_dir), "vectors")
    return f, emb, _dim(spark, sf_dir)


def _vector_summary(x):
    dims, entries, _ = V.vector_entries(F.col("x"))
    return x.select("doc_id", "token_id", dims.alias("dims"), entries.alias("nnz"))


@register("one_hot_rows")
def q_one_hot_rows(spark, sf_dir):
    """M1 applied: the encoder of the train split on every row; a value that
    the train split lacks has no index."""
    f = _split_features(spark, sf_dir)
    enc = V.fit_one_hot(f.where(F.col("split") == "train"), ONE_HOT_NAMES)
    x = enc.transform(f.select("doc_id", "token_id", S.feature_pairs(ONE_HOT_NAMES).alias("feats")), ONE_HOT_NAMES, keep=["doc_id", "token_id"])
    _, _, indices = V.vector_entries(F.col("onehot"))
    return x.select("doc_id", "token_id", F.array_join(indices.cast("array<string>"), ",").alias("indices"))


@register("embedding_features")
def q_embedding_features(spark, sf_dir):
    f, emb, dim = _emb_features(spark, sf_dir)
    _, one_hot_names = S.split_features(R.FEATURE_NAMES, "train")
    enc = V.fit_one_hot(f.where(F.col("split") == "train"), one_hot_names)
    return _vector_summary(M.embedding_vectors(f, R.FEATURE_NAMES, emb, dim, enc, keep=["doc_id", "token_id"]))


@register("combine_vectors")
def q_combine_vectors(spark, sf_dir):
    f, emb, dim = _emb_features(spark, sf_dir)
    names = ["lemma", "pos", "prefix", "suffix"]
    enc = V.fit_one_hot(f.where(F.col("split") == "train"), ["pos", "prefix", "suffix"])
    x = enc.transform(f.withColumn("feats", S.feature_pairs(["pos", "prefix", "suffix"])), ["pos", "prefix", "suffix"],
                      keep=["doc_id", "token_id", "lemma"])
    x = V.embed_context(x, emb, names, dim, out="dense")
    return _vector_summary(V.combine(x, "onehot", "dense", "x", keep=["doc_id", "token_id"]))


@register("predict")
def q_predict(spark, sf_dir):
    f = _split_features(spark, sf_dir)
    model = M.train(f.where(F.col("split") == "train"), kind="nb")
    return model.predict(f.where(F.col("split") == "test")).select(*R.FEATURE_COLUMNS, "predicted")


ATTACH_NAMES = ["lemma", "pos", "prev_tok_cue"]


@register("attach_predictions")
def q_attach(spark, sf_dir):
    f = _split_features(spark, sf_dir)
    model = M.train(f.where(F.col("split") == "train"), ATTACH_NAMES, kind="nb")
    pred = model.predict(f).select("doc_id", "token_id", "predicted")
    return An.join_annotations(f.select(*R.FEATURE_COLUMNS), pred, ["doc_id", "token_id"], wide=True).select(*R.FEATURE_COLUMNS, "predicted")


@register("pick_dense_onehot")
def q_pick_dense_onehot(spark, sf_dir):
    _, one_hot = S.split_features(R.FEATURE_NAMES, "train")
    f = R.features(spark, sf_dir)
    return f.select("doc_id", "token_id", F.array_join(S.feature_pairs(one_hot), " ").alias("onehot_feats"))


# --------------------------------------------------------------------------
# Streaming: stateless features
# --------------------------------------------------------------------------

@register("stream_token_features")
def q_stream_token_features(spark, sf_dir):
    import os
    from ..streaming.features import run_token_features
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    run_token_features(spark, os.path.join(sf_dir, "documents.parquet*"), sink, ckpt, TEST_ONE_WORD_CUES)
    return spark.read.parquet(sink)


# --------------------------------------------------------------------------
# Iterative learning (M2, M3, M5, M9-M13), the longest queries last
# --------------------------------------------------------------------------

from . import ablation as Ab  # noqa: E402
from . import tagger as TG  # noqa: E402

TAGGER_NAMES = ["lemma", "pos", "prefix", "suffix", "infix", "match_one", "match_multi", "prev_tok_cue"]
TUNE_NAMES = ["lemma", "pos", "prefix", "suffix", "prev_tok_cue"]


def _fit_tagger(spark, sf_dir, all_transitions=True):
    f = _split_features(spark, sf_dir)
    return f, TG.train_tagger(f.where(F.col("split") == "train"), TAGGER_NAMES, all_transitions=all_transitions)


@register("train_tagger")
def q_train_tagger(spark, sf_dir):
    """M9: per label, the weights of the fitted model and their terms."""
    _, m = _fit_tagger(spark, sf_dir)
    return m.weights(spark).groupBy("label").agg(F.count(F.lit(1)).alias("n_weights"), F.countDistinct("term").alias("n_terms"),
                                                 F.max(F.col("weight") != 0).alias("fitted"))


@register("predict_tagger")
def q_predict_tagger(spark, sf_dir):
    """Best label path for every sentence of the whole table."""
    f, m = _fit_tagger(spark, sf_dir)
    return prediction_facts(m.predict(f, carry=["split", "negcuelabel"]))


PREDICTED = ["doc_id", "token_id", "split", "negcuelabel", "predicted"]


@register("train_svm")
def q_train_svm(spark, sf_dir):
    """M2: the fitted model's label of every row."""
    return _predicted(spark, sf_dir, "svm").select(*PREDICTED)


@register("train_logreg")
def q_train_logreg(spark, sf_dir):
    return prediction_facts(_predicted(spark, sf_dir, "logreg"))


@register("train_embeddings")
def q_train_embeddings(spark, sf_dir):
    f, emb, dim = _emb_features(spark, sf_dir)
    model = M.train_embeddings(f.where(F.col("split") == "train"), emb, dim, kind="svm")
    return model.predict(f).select(*PREDICTED)


@register("tune_svm")
def q_tune_svm(spark, sf_dir):
    """The loss x C x tol grid over all folds of the train split, with
    the score of every grid point."""
    f = _split_features(spark, sf_dir).where(F.col("split") == "train")
    _, results = M.tune_svm_grid(f, TUNE_NAMES)
    return spark.createDataFrame(results, "loss string, c double, tol double, n_folds int, macro_f1 double")


@register("tune_tagger")
def q_tune_tagger(spark, sf_dir):
    f = _split_features(spark, sf_dir).where(F.col("split") == "train")
    return spark.createDataFrame(TG.tune_tagger(f, TAGGER_NAMES))


@register("feature_ablation")
def q_feature_ablation(spark, sf_dir):
    """All 26 distinct feature sets x SVM, tagger and SVM with vectors,
    trained on the train split: precision, recall and F1 of each class on the
    test split."""
    f, emb, dim = _emb_features(spark, sf_dir)
    train, test = f.where(F.col("split") == "train"), f.where(F.col("split") == "test")
    return Ab.score_runs(Ab.ablate(train, test, emb=emb, dim=dim), test)


# many fits each: run after everything else
LONG_RUNNING = ("train_embeddings", "tune_tagger", "feature_ablation")
