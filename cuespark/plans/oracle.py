"""DuckDB SQL that states each registered query independently of Spark.

Every query text starts with the same ``WITH`` prefix of base relations;
DuckDB skips the ones a query does not reference.
"""

from __future__ import annotations

from ..functions.cues import (MULTI_WORD_CUES, NEG_PREFIXES, NEG_SUFFIX, ONE_WORD_CUES, PUNCTUATION,
                              TEST_LONG_CUES, TEST_MULTI_WORD_CUES, TEST_ONE_WORD_CUES, TOKEN_PATTERN)


def once(body: str) -> str:
    """A statement whose annotated tokens are computed once, not inlined into
    each of its uses."""
    return q(body).replace("ann AS (", "ann AS MATERIALIZED (").replace("feat AS (", "feat AS MATERIALIZED (")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "(" + ", ".join(lit(x) for x in items) + ")"


PUNCT = lit(PUNCTUATION)


def strip_sql(t: str) -> str:
    whens = [f"WHEN suffix({t}, {lit(NEG_SUFFIX)}) THEN left({t}, length({t}) - {len(NEG_SUFFIX)})"]
    for p in reversed(NEG_PREFIXES):
        whens.append(f"WHEN prefix({t}, {lit(p)}) THEN substr({t}, {len(p) + 1})")
    return "(CASE " + " ".join(whens) + " ELSE '' END)"


def grams_sql(t: str, n: int = 5, side: str = "left") -> str:
    return f"list_transform(range(least({n}, length({t})), 0, -1), lambda k: {side}({t}, k))"


def flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def prefix_any(t: str) -> str:
    return " OR ".join(f"prefix({t}, {lit(p)})" for p in NEG_PREFIXES)


def infix_cond(t: str) -> str:
    return f"(suffix({t}, 'lessness') OR suffix({t}, 'lessly'))"


def j(*parts) -> str:
    return " || ' ' || ".join(parts)


def span_forms_sql(t="token", p=("p1", "p2", "p3"), f=("f1", "f2", "f3")):
    p1, p2, p3 = p
    f1, f2, f3 = f
    return [j(t, f1), j(p1, t), j(t, f1, f2), j(p1, t, f1), j(p2, p1, t), j(t, f1, f2, f3),
            j(p1, t, f1, f2), j(p2, p1, t, f1), j(p3, p2, p1, t)]


def literal_forms_sql(t="token", p=("p1", "p2", "p3"), f=("f1", "f2", "f3")):
    p1, p2, p3 = p
    f1, f2, f3 = f
    return [j(t, f1), j(p1, t), j(f1, t, p1), j(f2, f1, t), j(t, p1, p2), j(f3, f2, f1, t),
            f"{f2} || ' ' || {f2} || ' ' || {t} || {p1}", j(f1, t, p1, p2), j(t, p1, p2, p3)]


def multi_sql(forms, cues) -> str:
    return flag(" OR ".join(f"({e}) IN {lst(cues)}" for e in forms))


def gold_sql(t, prev):
    return (f"CASE WHEN {t} IN ('no','without','is','was') THEN 'B-NEG' "
            f"WHEN {prev} IN ('no','without','is','was') AND {t} IN ('the','a','that','it') THEN 'I-NEG' ELSE 'O' END")


W = "PARTITION BY doc_id ORDER BY tok_id"
RX = lit(TOKEN_PATTERN)

BASE = f"""
WITH tok AS (
  SELECT doc_id, lang, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS tok_id, unnest(t) AS token
  FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), {RX}) AS t FROM documents)
), rawtok AS (
  SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS tok_id, unnest(t) AS token
  FROM (SELECT doc_id, regexp_extract_all(text, {RX}) AS t FROM documents)
), ann AS (
  SELECT *,
    CASE WHEN length(token) > 5 AND suffix(token, 'ing') THEN left(token, length(token) - 3)
         WHEN length(token) > 4 AND suffix(token, 'ed') THEN left(token, length(token) - 2)
         WHEN length(token) > 3 AND suffix(token, 's') THEN left(token, length(token) - 1)
         ELSE token END AS lemma,
    CASE WHEN length(token) = 1 AND contains({PUNCT}, token) THEN 'PUNCT'
         WHEN suffix(token, 'ing') THEN 'VBG' WHEN suffix(token, 'ed') THEN 'VBD'
         WHEN suffix(token, 'ly') THEN 'RB' WHEN suffix(token, 's') THEN 'NNS' ELSE 'NN' END AS pos
  FROM tok
), feat AS (
  SELECT *,
    {gold_sql('token', 'prev_token')} AS label,
    CASE WHEN token IN ('no','is') THEN 'B-NEG' WHEN prev_token = 'is' AND token = 'the' THEN 'I-NEG'
         ELSE 'O' END AS sys_a,
    CASE WHEN token IN ('no','is','was','with') THEN 'B-NEG' WHEN token = '|' THEN 'X-NEG' ELSE 'O' END AS sys_b
  FROM (SELECT *, lag(token) OVER ({W}) AS prev_token FROM ann)
), ctx AS (
  SELECT *,
    coalesce(lag(lemma) OVER ({W}), '') AS prev, coalesce(lead(lemma) OVER ({W}), '') AS next,
    coalesce(lag(token, 1) OVER ({W}), '') AS p1, coalesce(lag(token, 2) OVER ({W}), '') AS p2,
    coalesce(lag(token, 3) OVER ({W}), '') AS p3, coalesce(lead(token, 1) OVER ({W}), '') AS f1,
    coalesce(lead(token, 2) OVER ({W}), '') AS f2, coalesce(lead(token, 3) OVER ({W}), '') AS f3,
    CAST(coalesce(sum(CASE WHEN token = '.' THEN 1 ELSE 0 END)
         OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS sent_seq
  FROM ann
), lex AS (
  SELECT gram, pos, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT unnest(list_concat([token], {grams_sql('token')})) AS gram, pos, n
        FROM (SELECT token, pos, count(*) AS n FROM ann GROUP BY token, pos))
  GROUP BY gram, pos
), lex_nopos AS (
  SELECT gram, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT unnest(list_concat([token], {grams_sql('token')})) AS gram, n
        FROM (SELECT token, count(*) AS n FROM tok GROUP BY token))
  GROUP BY gram
), sbs AS (
  SELECT g.token, g.pos, CAST(sum(coalesce(l.n, 0)) AS BIGINT) AS sbs_count
  FROM (SELECT token, pos, unnest({grams_sql('base')}) AS gram
        FROM (SELECT DISTINCT token, pos, {strip_sql('token')} AS base FROM ann) WHERE length(base) > 0) g
  LEFT JOIN lex l ON l.gram = g.gram AND l.pos = g.pos
  GROUP BY g.token, g.pos
), features AS (
  SELECT c.doc_id, c.sent_seq AS sentence_id, c.tok_id AS token_id, c.token, c.lemma, c.prev, c.next, c.pos,
    {flag(f'contains({PUNCT}, c.token)')} AS punct,
    {flag(prefix_any('c.token'))} AS prefix,
    {flag("suffix(c.token, 'less')")} AS suffix,
    {flag(infix_cond('c.token'))} AS infix,
    CASE WHEN c.tok_id = 0 THEN '0' ELSE {gold_sql('c.p1', 'c.p2')} END AS prev_tok_cue,
    coalesce(s.sbs_count, CAST(0 AS BIGINT)) AS sbs_count,
    {flag(f'c.token IN {lst(TEST_ONE_WORD_CUES)}')} AS match_one,
    {multi_sql(span_forms_sql('c.token', ('c.p1', 'c.p2', 'c.p3'), ('c.f1', 'c.f2', 'c.f3')), TEST_MULTI_WORD_CUES)} AS match_multi,
    {gold_sql('c.token', 'c.p1')} AS negcuelabel, c.lang
  FROM ctx c LEFT JOIN sbs s ON s.token = c.token AND s.pos = c.pos
)
"""


def q(body: str) -> str:
    return BASE + body


ORACLE: dict[str, str] = {}

ORACLE["tokenize_documents"] = q("SELECT doc_id, lang, tok_id, token FROM tok")
ORACLE["lower_token"] = q("SELECT doc_id, tok_id, token, lower(token) AS lower_token FROM rawtok")
ORACLE["has_neg_prefix"] = q(f"SELECT doc_id, tok_id, token, {flag(prefix_any('token'))} AS prefix FROM tok")
_suffix_cond = f"suffix(token, {lit(NEG_SUFFIX)})"
ORACLE["has_neg_suffix"] = q(f"SELECT doc_id, tok_id, token, {flag(_suffix_cond)} AS suffix FROM tok")
ORACLE["has_neg_infix"] = q(f"SELECT doc_id, tok_id, token, {flag(infix_cond('token'))} AS infix FROM tok")
ORACLE["match_one"] = q(f"""SELECT doc_id, tok_id, token, {flag(f'token IN {lst(TEST_ONE_WORD_CUES)}')} AS match_one,
  {flag(f'token IN {lst(ONE_WORD_CUES)}')} AS match_one_ref FROM tok""")
ORACLE["is_punct"] = q(f"SELECT doc_id, tok_id, token, {flag(f'contains({PUNCT}, token)')} AS punct FROM tok")
ORACLE["punct_chars"] = q(f"""SELECT doc_id, tok_id, token,
  array_to_string(list_transform(range(1, length(token) + 1),
                  lambda i: CASE WHEN contains({PUNCT}, substr(token, i, 1)) THEN 1 ELSE 0 END), '') AS punct_chars
  FROM rawtok""")
ORACLE["strip_affix"] = q(f"SELECT doc_id, tok_id, token, {strip_sql('token')} AS stripped FROM tok")
ORACLE["start_ngrams"] = q(f"SELECT doc_id, tok_id, token, array_to_string({grams_sql('token')}, '|') AS start_ngrams FROM tok")
ORACLE["end_ngrams"] = q(f"SELECT doc_id, tok_id, token, array_to_string({grams_sql('token', side='right')}, '|') AS end_ngrams FROM tok")
_base = f"(CASE WHEN length({strip_sql('token')}) > 0 THEN {strip_sql('token')} ELSE token END)"
ORACLE["affix_ngrams"] = q(f"""SELECT doc_id, tok_id, token,
  array_to_string({grams_sql(_base)}, '|') AS affix_start,
  array_to_string({grams_sql(_base, side='right')}, '|') AS affix_end FROM tok""")

ORACLE["prev_lemma"] = q("SELECT doc_id, tok_id, lemma, prev FROM ctx")
ORACLE["next_lemma"] = q("SELECT doc_id, tok_id, lemma, next FROM ctx")
ORACLE["prev_label"] = q(f"SELECT doc_id, tok_id, label, coalesce(lag(label) OVER ({W}), '0') AS prev_tok_cue FROM feat")
ORACLE["match_multi_literal"] = q(f"""SELECT doc_id, tok_id, token,
  {multi_sql(literal_forms_sql(), TEST_MULTI_WORD_CUES)} AS match_multi,
  {multi_sql(literal_forms_sql(), MULTI_WORD_CUES)} AS match_multi_ref FROM ctx""")
ORACLE["match_multi"] = q(f"""SELECT doc_id, tok_id, token,
  {multi_sql(span_forms_sql(), TEST_MULTI_WORD_CUES)} AS match_multi,
  {multi_sql(span_forms_sql(), MULTI_WORD_CUES)} AS match_multi_ref FROM ctx""")
ORACLE["sentence_seq"] = q("SELECT doc_id, tok_id, token, sent_seq FROM ctx")
ORACLE["context_tokens"] = q(f"""SELECT doc_id, tok_id,
  coalesce(lag(lower(token)) OVER ({W}), last_tok) AS prev_token,
  coalesce(lead(lower(token)) OVER ({W}), second_tok, first_tok) AS next_token
  FROM rawtok JOIN (SELECT doc_id, arg_max(lower(token), tok_id) AS last_tok,
                           max(CASE WHEN tok_id = 1 THEN lower(token) END) AS second_tok,
                           max(CASE WHEN tok_id = 0 THEN lower(token) END) AS first_tok
                    FROM rawtok GROUP BY doc_id) e USING (doc_id)""")
ORACLE["corpus_position"] = q("""SELECT doc_id, tok_id, CAST(off + tok_id AS BIGINT) AS corpus_pos
  FROM tok JOIN (SELECT doc_id, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
                 FROM (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id)) d USING (doc_id)""")

_BY_LENGTH = {}
for _cue in TEST_MULTI_WORD_CUES + TEST_LONG_CUES:
    _BY_LENGTH.setdefault(len(_cue.split()), []).append(_cue)
_LONGEST = max(_BY_LENGTH)
_STARTS = " ".join(
    "WHEN " + " || ' ' || ".join(["token"] + [f"lead(token, {k}) OVER ({W})" for k in range(1, n)]) + f" IN {lst(c)} THEN {n}"
    for n, c in sorted(_BY_LENGTH.items(), reverse=True))
ORACLE["match_cues"] = q(f"""SELECT doc_id, tok_id, token, cue_length,
  CASE WHEN max(tok_id + cue_length) OVER ({W} ROWS BETWEEN {_LONGEST - 1} PRECEDING AND CURRENT ROW) > tok_id THEN 1 ELSE 0 END AS match_cues
  FROM (SELECT doc_id, tok_id, token, CASE {_STARTS} ELSE 0 END AS cue_length FROM tok)""")
G = "ORDER BY doc_id, tok_id"
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
ORACLE["prev_next_lemma_corpus"] = q(f"""SELECT doc_id, tok_id, row_number() OVER ({G}) - 1 AS corpus_pos, lemma,
  coalesce(lag(lemma) OVER ({G}), '') AS prev, coalesce(lead(lemma) OVER ({G}), '') AS next FROM ann""")
ORACLE["context_tokens_corpus"] = q(f"""SELECT doc_id, tok_id,
  coalesce(lag(lower(token)) OVER ({G}), last_value(lower(token)) OVER ({G} {WHOLE})) AS prev_token,
  coalesce(lead(lower(token)) OVER ({G}), nth_value(lower(token), 2) OVER ({G} {WHOLE})) AS next_token FROM rawtok""")
_SHIFTS = ", ".join([f"coalesce(lag(token, {k}) OVER o, '') AS p{k}, coalesce(lead(token, {k}) OVER o, '') AS f{k}" for k in (1, 2, 3)])
ORACLE["match_multi_literal_corpus"] = q(f"""SELECT doc_id, tok_id, token,
  {multi_sql(literal_forms_sql(), TEST_MULTI_WORD_CUES)} AS match_multi,
  {multi_sql(literal_forms_sql(), MULTI_WORD_CUES)} AS match_multi_ref
  FROM (SELECT *, {_SHIFTS}
        FROM (SELECT row_number() OVER ({G}) AS i, doc_id, tok_id, token FROM tok
              UNION ALL SELECT * FROM (SELECT 1 - row_number() OVER (ORDER BY doc_id DESC, tok_id DESC) AS i, doc_id, tok_id, token FROM tok) WHERE i > -3)
        WINDOW o AS (ORDER BY i)) WHERE i > 0""")

ORACLE["lexicon"] = q("SELECT gram, pos, n FROM lex")
ORACLE["lexicon_nopos"] = q("SELECT gram, n FROM lex_nopos")
ORACLE["sbs_count"] = q("""SELECT a.doc_id, a.tok_id, a.token, a.pos, coalesce(s.sbs_count, CAST(0 AS BIGINT)) AS sbs_count
  FROM ann a LEFT JOIN sbs s ON s.token = a.token AND s.pos = a.pos""")
ORACLE["sbs_count_exact"] = q(f"""SELECT t.doc_id, t.tok_id, t.token,
  coalesce(CASE WHEN length({strip_sql('t.token')}) > 0 THEN l.n END, CAST(0 AS BIGINT)) AS sbs_count_exact
  FROM tok t LEFT JOIN lex_nopos l ON l.gram = {strip_sql('t.token')}""")
ORACLE["label_counts"] = q("""SELECT CASE WHEN label IN ('B-NEG', 'I-NEG') THEN label ELSE 'O' END AS label,
  count(*) AS n FROM feat GROUP BY 1""")
ORACLE["feature_table"] = q("""SELECT doc_id, sentence_id, token_id, token, lemma, prev, next, pos, punct, prefix,
  suffix, infix, prev_tok_cue, sbs_count, match_one, match_multi, negcuelabel FROM features""")
ORACLE["flags_by_lang"] = q("""SELECT lang, count(*) AS n_tokens, CAST(sum(punct) AS BIGINT) AS punct,
  CAST(sum(prefix) AS BIGINT) AS prefix, CAST(sum(suffix) AS BIGINT) AS suffix, CAST(sum(infix) AS BIGINT) AS infix,
  CAST(sum(match_one) AS BIGINT) AS match_one, CAST(sum(sbs_count) AS BIGINT) AS sbs_count,
  CAST(sum(CASE WHEN sbs_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_sbs
  FROM features GROUP BY lang""")

# --------------------------------------------------------------------------
# P2-P5, P8, A6, A7
# --------------------------------------------------------------------------


def pairs_sql(names, alias=""):
    a = f"{alias}." if alias else ""
    return " || ' ' || ".join(f"'{n}=' || CAST({a}{n} AS VARCHAR)" for n in names)


PAIR_NAMES = ["token", "lemma", "pos", "punct", "sbs_count", "prev_tok_cue"]
ORACLE["select_features"] = q(f"SELECT doc_id, token_id, {pairs_sql(PAIR_NAMES)} AS feats FROM features")
ORACLE["features_and_labels"] = q(f"SELECT doc_id, token_id, {pairs_sql(PAIR_NAMES)} AS feats, negcuelabel AS label FROM features")
ORACLE["features_only"] = q(f"SELECT doc_id, token_id, {pairs_sql(['lemma', 'prev', 'next', 'match_multi'])} AS feats FROM features")
ORACLE["get_label"] = q("SELECT doc_id, token_id, negcuelabel AS label FROM features")
ORACLE["first_n_tokens"] = q("SELECT doc_id, tok_id, token FROM tok ORDER BY doc_id, tok_id LIMIT 40000")

_SENT = f"""sp AS (
  SELECT *, CAST(coalesce(sum(CASE WHEN token = '.' THEN 1 ELSE 0 END)
                 OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS sent_seq,
    coalesce(max(CASE WHEN token = '.' THEN tok_id END)
             OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0) AS sent_start
  FROM feat)"""


def _sentences_sql(keep_tail: bool) -> str:
    tail = "" if keep_tail else """ WHERE tok_id <= (SELECT max(tok_id) FROM feat f2 WHERE f2.doc_id = sp.doc_id AND f2.token = '.')"""
    return q(f""", {_SENT}
SELECT doc_id, sent_seq, CAST((tok_id - sent_start) // 1024 AS INTEGER) AS piece, min(tok_id) AS start,
  count(*) AS n_tokens, string_agg(token, ' ' ORDER BY tok_id) AS tokens, string_agg(label, ' ' ORDER BY tok_id) AS labels
FROM sp{tail} GROUP BY doc_id, sent_seq, piece""")


ORACLE["sentences"] = _sentences_sql(True)
ORACLE["sentences_drop_tail"] = _sentences_sql(False)
ORACLE["token_list"] = q("""SELECT doc_id, CAST(tok_id // 4096 AS INTEGER) AS block, count(*) AS n_tokens,
  string_agg(token, ' ' ORDER BY tok_id) AS tokens FROM tok GROUP BY doc_id, block""")

# --------------------------------------------------------------------------
# J1, J2, S6, J3, J4, M1
# --------------------------------------------------------------------------

ORACLE["join_annotations"] = q("SELECT doc_id, tok_id, token, lemma, pos FROM ann")
ORACLE["annotate_lexicon"] = once(""", tagged AS (
  SELECT token, lemma, CASE WHEN prev_token IN ('the', 'a') THEN 'NN' ELSE pos END AS pos
  FROM feat WHERE doc_id IN (SELECT doc_id FROM labels)
), dict AS (
  SELECT token, lemma, pos FROM (
    SELECT token, lemma, pos, row_number() OVER (PARTITION BY token ORDER BY n DESC, pos, lemma) AS rn
    FROM (SELECT token, pos, lemma, count(*) AS n FROM tagged GROUP BY token, pos, lemma)) WHERE rn = 1
)
SELECT a.doc_id, a.tok_id, a.token, coalesce(d.lemma, a.lemma) AS lemma, coalesce(d.pos, a.pos) AS pos
FROM ann a LEFT JOIN dict d ON d.token = a.token""")

_EMB = """, emb AS (
  SELECT word, vec_id, embedding FROM (
    SELECT token AS word, CAST(row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS BIGINT) AS vec_id
    FROM tok GROUP BY token) JOIN embeddings USING (vec_id)
)"""


def vsum(e: str) -> str:
    return f"round(list_sum(list_transform({e}, lambda x: CAST(x AS DOUBLE))), 5)"


def zeros_or(e: str) -> str:
    return f"coalesce({e}, list_transform(range(64), lambda i: CAST(0 AS FLOAT)))"


ORACLE["scan_embeddings"] = q(_EMB + f"""
SELECT word, vec_id, CAST(len(embedding) AS INTEGER) AS dims, {vsum('embedding')} AS vsum,
  round(list_sum(list_transform(embedding, lambda x: CAST(x * x AS DOUBLE))), 5) AS vsumsq FROM emb""")
ORACLE["embedding_lookup"] = q(_EMB + f"""
SELECT a.doc_id, a.tok_id, a.lemma, CAST(len({zeros_or('e.embedding')}) AS INTEGER) AS dims,
  {vsum(zeros_or('e.embedding'))} AS vsum
FROM ann a LEFT JOIN emb e ON e.word = a.lemma""")
ORACLE["embedding_context"] = q(_EMB + f"""
SELECT c.doc_id, c.tok_id, CAST(192 AS INTEGER) AS dims,
  {vsum(f"list_concat({zeros_or('e1.embedding')}, {zeros_or('e2.embedding')}, {zeros_or('e3.embedding')})")} AS vsum,
  {vsum(zeros_or('e2.embedding'))} AS vsum_prev
FROM ctx c LEFT JOIN emb e1 ON e1.word = c.lemma LEFT JOIN emb e2 ON e2.word = c.prev LEFT JOIN emb e3 ON e3.word = c.next""")

_OH = ["lemma", "pos", "prefix", "sbs_count", "prev_tok_cue"]
ORACLE["one_hot"] = q(f"""SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM (
  SELECT DISTINCT unnest([{', '.join(f"'{n}=' || CAST({n} AS VARCHAR)" for n in _OH)}]) AS term FROM features)""")

# --------------------------------------------------------------------------
# A8-A14, J5, J7, P6, P7, P9, M14
# --------------------------------------------------------------------------

_EVAL = """, pairs AS (
  SELECT doc_id, tok_id, label AS gold, 'sys_a' AS system, sys_a AS pred FROM feat
  UNION ALL SELECT doc_id, tok_id, label, 'sys_b', sys_b FROM feat
), conf AS (
  SELECT system, gold, pred, count(*) AS n FROM pairs GROUP BY system, gold, pred
), cls AS (
  SELECT system, gold AS class, CASE WHEN gold = pred THEN n ELSE 0 END AS tp, 0 AS fp,
         CASE WHEN gold <> pred THEN n ELSE 0 END AS fn, 1 AS is_gold FROM conf
  UNION ALL
  SELECT system, pred, 0, CASE WHEN gold <> pred THEN n ELSE 0 END, 0, 0 FROM conf
), st AS (
  SELECT system, class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
         CAST(max(is_gold) AS INTEGER) AS is_gold FROM cls GROUP BY system, class
), stats AS (
  SELECT system, class, tp, fp, fn,
    CAST(CASE WHEN is_gold = 1 THEN sum(tp) OVER (PARTITION BY system) - tp ELSE 0 END AS BIGINT) AS tn,
    CAST(sum(tp + fn) OVER (PARTITION BY system) - tp - fp - fn AS BIGINT) AS tn_full, is_gold FROM st
), pr AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
            CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r FROM stats
), prf AS (
  SELECT system, class, p AS precision, r AS recall, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS fscore
  FROM pr WHERE is_gold = 1
), prf_avg AS (
  SELECT * FROM prf UNION ALL
  SELECT system, 'avg', avg(precision), avg(recall), avg(fscore) FROM prf GROUP BY system
), rep AS (
  SELECT system, class, p AS precision, r AS recall, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1,
         CAST(tp + fn AS DOUBLE) AS support, tp FROM pr
), rep_sum AS (
  SELECT system, sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
         sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM rep GROUP BY system
), report AS (
  SELECT system, class, precision, recall, f1, support FROM rep
  UNION ALL SELECT system, 'accuracy', tp / n, tp / n, tp / n, tp / n FROM rep_sum
  UNION ALL SELECT system, 'macro avg', mp, mr, mf, n FROM rep_sum
  UNION ALL SELECT system, 'weighted avg', wp / n, wr / n, wf / n, n FROM rep_sum
)"""


def r6(*cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


ORACLE["confusion_counts"] = q(_EVAL + " SELECT system, gold, pred, n FROM conf")
ORACLE["confusion_matrix"] = q(_EVAL + """ SELECT system, gold,
  CAST(coalesce(sum(CASE WHEN pred = 'B-NEG' THEN n END), 0) AS BIGINT) AS "B-NEG",
  CAST(coalesce(sum(CASE WHEN pred = 'I-NEG' THEN n END), 0) AS BIGINT) AS "I-NEG",
  CAST(coalesce(sum(CASE WHEN pred = 'O' THEN n END), 0) AS BIGINT) AS "O"
  FROM conf GROUP BY system, gold""")
ORACLE["pr_stats"] = q(_EVAL + " SELECT system, class, tp, fp, fn, tn, tn_full, is_gold FROM stats")
ORACLE["prf"] = q(_EVAL + f" SELECT system, class, {r6('precision', 'recall', 'fscore')} FROM prf")
ORACLE["macro_avg"] = q(_EVAL + f" SELECT system, class, {r6('precision', 'recall', 'fscore')} FROM prf_avg WHERE class = 'avg'")
ORACLE["classification_report"] = q(_EVAL + f" SELECT system, class, {r6('precision', 'recall', 'f1', 'support')} FROM report")
ORACLE["distinct_classes"] = q(_EVAL + " SELECT DISTINCT system, gold AS class FROM conf")
ORACLE["evaluate_systems"] = q(_EVAL + f" SELECT system, class, {r6('precision', 'recall', 'fscore')} FROM prf_avg")
ORACLE["score_lookup"] = q(_EVAL + """ SELECT system, class, 'f-score' AS metric, round(fscore, 6) AS value FROM prf_avg
  WHERE system = 'sys_a' AND class = 'O'""")
ORACLE["filter_mismatch"] = q(_EVAL + " SELECT system, doc_id, tok_id, gold, pred FROM pairs WHERE gold <> pred")
_ERR = """ SELECT f.*, s.sys_b AS predictedlabel FROM features f JOIN feat s ON s.doc_id = f.doc_id AND s.tok_id = f.token_id
  WHERE f.negcuelabel <> s.sys_b"""
ORACLE["error_rows"] = q(_ERR.replace("f.*", "f.* EXCLUDE (lang)"))
ORACLE["filter_category"] = q(_ERR.replace("f.*", "f.* EXCLUDE (lang)") + " AND f.negcuelabel = 'I-NEG'")
ORACLE["gold_vs_system"] = q(""", last AS (SELECT doc_id, max(tok_id) AS last_dot FROM feat WHERE token = '.' GROUP BY doc_id),
sysrows AS (
  SELECT f.doc_id, f.tok_id, 'sys_a' AS system FROM feat f JOIN last l ON l.doc_id = f.doc_id WHERE f.tok_id <= l.last_dot
  UNION ALL SELECT doc_id, tok_id, 'sys_b' FROM feat
), g AS (SELECT doc_id, tok_id, s.system FROM feat, (VALUES ('sys_a'), ('sys_b')) s(system))
SELECT coalesce(g.system, r.system) AS system,
  CAST(sum(CASE WHEN g.doc_id IS NOT NULL AND r.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS paired,
  CAST(sum(CASE WHEN r.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS gold_only,
  CAST(sum(CASE WHEN g.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sys_only
FROM g FULL JOIN sysrows r ON g.doc_id = r.doc_id AND g.tok_id = r.tok_id AND g.system = r.system
GROUP BY 1""")

# --------------------------------------------------------------------------
# S1-S5, K1-K4 (round trips: the read-back equals the written relation)
# --------------------------------------------------------------------------

_RAW = f""" SELECT doc_id, CAST(coalesce(sum(CASE WHEN token = '.' THEN 1 ELSE 0 END)
    OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS sentence_id,
  tok_id AS token_id, token, label FROM feat"""
ORACLE["scan_tokens"] = q(_RAW)
ORACLE["drop_blank_rows"] = q(_RAW)
_FEAT17 = ("doc_id, sentence_id, token_id, token, lemma, prev, next, pos, punct, prefix, suffix, infix, "
           "prev_tok_cue, sbs_count, match_one, match_multi, negcuelabel")
ORACLE["write_features"] = q(f"SELECT {_FEAT17} FROM features")
ORACLE["scan_features"] = q(f"SELECT {_FEAT17} FROM features")
ORACLE["preprocess_file"] = q(f"SELECT {_FEAT17} FROM features".replace("doc_id", "'doc-' || doc_id AS doc_id"))
ORACLE["evaluate_by_position"] = ORACLE["evaluate_systems"].replace("'sys_a'", "'run-sys-a'").replace("'sys_b'", "'run-sys-b'")
ORACLE["evaluate_files"] = ORACLE["evaluate_systems"].replace("'sys_a'", "'run-sys-a'").replace("'sys_b'", "'run-sys-b'")
ORACLE["scan_label_column"] = q("SELECT doc_id, token_id, negcuelabel FROM features")
_PRED = """ SELECT {name_a} AS system, f.doc_id, f.token_id, f.token, f.negcuelabel, s.sys_a AS predicted
  FROM features f JOIN feat s ON s.doc_id = f.doc_id AND s.tok_id = f.token_id
  UNION ALL SELECT {name_b}, f.doc_id, f.token_id, f.token, f.negcuelabel, s.sys_b
  FROM features f JOIN feat s ON s.doc_id = f.doc_id AND s.tok_id = f.token_id"""
ORACLE["scan_systems"] = q(_PRED.format(name_a="'run-sys-a'", name_b="'run-sys-b'"))
ORACLE["write_errors"] = q(_ERR.replace("f.*", "f.* EXCLUDE (lang)"))
ORACLE["write_context_features"] = q(f"""SELECT token,
  coalesce(lag(token) OVER ({W}), last_tok) AS prev, coalesce(lead(token) OVER ({W}), second_tok, first_tok) AS next,
  {flag(infix_cond('token'))} AS infix, {flag(f'token IN {lst(TEST_ONE_WORD_CUES)}')} AS match_one,
  {multi_sql(span_forms_sql(), TEST_MULTI_WORD_CUES)} AS match_multi
  FROM ctx JOIN (SELECT doc_id, arg_max(token, tok_id) AS last_tok,
                        max(CASE WHEN tok_id = 1 THEN token END) AS second_tok,
                        max(CASE WHEN tok_id = 0 THEN token END) AS first_tok FROM tok GROUP BY doc_id) e USING (doc_id)""")

_ONEHOT_TRAIN = ["pos", "punct", "prefix", "suffix", "infix", "sbs_count", "match_one", "match_multi", "prev_tok_cue"]
ORACLE["pick_dense_onehot"] = q(f"SELECT doc_id, token_id, {pairs_sql(_ONEHOT_TRAIN)} AS onehot_feats FROM features")

ORACLE["stream_token_features"] = q(f"""SELECT doc_id, tok_id, token, lemma, pos,
  {flag(f'contains({PUNCT}, token)')} AS punct, {flag(prefix_any('token'))} AS prefix,
  {flag("suffix(token, 'less')")} AS suffix, {flag(infix_cond('token'))} AS infix,
  {flag(f'token IN {lst(TEST_ONE_WORD_CUES)}')} AS match_one, {strip_sql('token')} AS stripped FROM ann""")

# --------------------------------------------------------------------------
# Learning: split by a hash of the document id; naive Bayes in closed form,
# counts for the iterative models
# --------------------------------------------------------------------------

_NAMES = ["token", "lemma", "prev", "next", "pos", "punct", "prefix", "suffix", "infix", "prev_tok_cue", "sbs_count", "match_one", "match_multi"]


def _split_sql() -> str:
    return """, sp AS MATERIALIZED (SELECT *, CASE WHEN ('0x' || substr(md5('17:' || doc_id), 1, 8))::BIGINT % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM features)"""


def _terms(names) -> str:
    return "[" + ", ".join(f"'{n}=' || CAST({n} AS VARCHAR)" for n in names) + "]"


def _nb_sql(names, columns: str, where: str = "true", prefix: str = "") -> str:
    """Complement naive Bayes: a class scores minus the log share that each
    of the row's terms has among the rows of the other classes."""
    return once(_split_sql() + f""", tr AS (SELECT unnest({_terms(names)}) AS term, negcuelabel AS y FROM sp WHERE split = 'train'),
cnt AS (SELECT term, count(*) AS n, count(*) FILTER (y = 'B-NEG') AS b, count(*) FILTER (y = 'I-NEG') AS i, count(*) FILTER (y = 'O') AS o FROM tr GROUP BY term),
tot AS (SELECT sum(n) AS n, sum(b) AS b, sum(i) AS i, sum(o) AS o, count(*) AS v FROM cnt),
th AS (SELECT term, -ln((cnt.n - cnt.b + 1) / (tot.n - tot.b + v)) AS b, -ln((cnt.n - cnt.i + 1) / (tot.n - tot.i + v)) AS i,
       -ln((cnt.n - cnt.o + 1) / (tot.n - tot.o + v)) AS o FROM cnt, tot),
row_terms AS (SELECT doc_id, token_id, unnest({_terms(names)}) AS term FROM sp WHERE {where}),
score AS (SELECT doc_id, token_id, coalesce(sum(b), 0) AS b, coalesce(sum(i), 0) AS i, coalesce(sum(o), 0) AS o FROM row_terms LEFT JOIN th USING (term) GROUP BY doc_id, token_id),
out AS (SELECT doc_id, token_id, CASE WHEN b >= i AND b >= o THEN 'B-NEG' WHEN i >= o THEN 'I-NEG' ELSE 'O' END AS predicted FROM score)
SELECT {prefix}{columns} FROM sp JOIN out USING (doc_id, token_id)""")


ORACLE["train_nb"] = _nb_sql(_NAMES, "doc_id, token_id, split, negcuelabel, predicted")
ORACLE["predict"] = _nb_sql(_NAMES, _FEAT17 + ", predicted", "split = 'test'")
ORACLE["attach_predictions"] = _nb_sql(["lemma", "pos", "prev_tok_cue"], _FEAT17 + ", predicted")
_TWO = [["lemma", "pos"], ["lemma", "pos", "prev_tok_cue"]]
ORACLE["write_predictions"] = " UNION ALL ".join("SELECT * FROM (" + _nb_sql(n, _FEAT17 + ", predicted", "split = 'test'", f"'nb' AS model, '{'_'.join(n)}' AS feature_set, ") + ")" for n in _TWO)

ORACLE["one_hot_rows"] = once(_split_sql() + f""", vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM
  (SELECT DISTINCT unnest({_terms(["lemma", "pos", "prefix", "sbs_count", "prev_tok_cue"])}) AS term FROM sp WHERE split = 'train')),
rt AS (SELECT doc_id, token_id, unnest({_terms(["lemma", "pos", "prefix", "sbs_count", "prev_tok_cue"])}) AS term FROM sp)
SELECT doc_id, token_id, coalesce(string_agg(idx::VARCHAR, ',' ORDER BY idx), '') AS indices FROM rt LEFT JOIN vocab USING (term) GROUP BY doc_id, token_id""")


def _vector_sql(onehot, words) -> str:
    joins = " ".join(f"LEFT JOIN nz {w}_ ON {w}_.word = sp.{w}" for w in words)
    found = " + ".join(f"coalesce({w}_.n, 0)" for w in words)
    return once(_EMB + _split_sql() + f""", nz AS (SELECT word, len(list_filter(embedding, lambda x: x <> 0)) AS n FROM emb),
vocab AS (SELECT DISTINCT unnest({_terms(onehot)}) AS term FROM sp WHERE split = 'train'),
rt AS (SELECT doc_id, token_id, unnest({_terms(onehot)}) AS term FROM sp),
hot AS (SELECT doc_id, token_id, count(vocab.term) AS n FROM rt LEFT JOIN vocab USING (term) GROUP BY doc_id, token_id)
SELECT sp.doc_id, sp.token_id, CAST({len(words)} * (SELECT max(len(embedding)) FROM embeddings) + (SELECT count(*) FROM vocab) AS INTEGER) AS dims,
       CAST(hot.n + {found} AS INTEGER) AS nnz FROM sp JOIN hot USING (doc_id, token_id) {joins}""")


ORACLE["embedding_features"] = _vector_sql(_ONEHOT_TRAIN, ["lemma", "prev", "next"])
ORACLE["combine_vectors"] = _vector_sql(["pos", "prefix", "suffix"], ["lemma"])

_FACTS = once(_split_sql() + """ SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unpredicted, CAST(0 AS BIGINT) AS n_foreign, true AS reaches_majority FROM sp GROUP BY split""")
for _k in ("train_logreg", "predict_tagger"):
    ORACLE[_k] = _FACTS
_TAGGER = ["lemma", "pos", "prefix", "suffix", "infix", "match_one", "match_multi", "prev_tok_cue"]
ORACLE["train_tagger"] = once(_split_sql() + f""", v AS (SELECT count(DISTINCT term) AS n FROM (SELECT unnest({_terms(_TAGGER)}) AS term FROM sp WHERE split = 'train')),
l AS (SELECT DISTINCT negcuelabel AS label FROM sp WHERE split = 'train')
SELECT label, (SELECT n FROM v) + (SELECT count(*) FROM l) + 2 AS n_weights, (SELECT n FROM v) + (SELECT count(*) FROM l) + 2 AS n_terms, true AS fitted FROM l""")
