"""Neighbour columns, multi-word cues, sentence numbers, positions;
block windows agree with a plain per-document window at every block edge."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cuespark.functions.cues import MULTI_WORD_CUES
from cuespark.operators import context as C


def _doc(spark, tokens, doc=0, **cols):
    data = [(doc, i, t) + tuple(v[i] for v in cols.values()) for i, t in enumerate(tokens)]
    schema = "doc_id long, tok_id int, token string" + "".join(f", {k} string" for k in cols)
    return spark.createDataFrame(data, schema)


def test_prev_next_lemma_and_label(spark):
    df = _doc(spark, ["He", "is", "not"], lemma=["he", "be", "not"], label=["O", "O", "B-NEG"])
    out = C.prev_label(C.prev_next_lemma(df)).orderBy("tok_id").collect()
    assert [r.prev for r in out] == ["", "he", "be"]
    assert [r.next for r in out] == ["be", "not", ""]
    assert [r.prev_tok_cue for r in out] == ["0", "O", "O"]


def test_multi_literal_vs_span(spark):
    df = _doc(spark, ["by", "no", "means"])
    lit = C.match_multi(df, MULTI_WORD_CUES, mode="literal").orderBy("tok_id").collect()
    span = C.match_multi(df, MULTI_WORD_CUES, mode="span").orderBy("tok_id").collect()
    assert [r.match_multi for r in lit] == [0, 0, 0]
    assert [r.match_multi for r in span] == [1, 1, 1]
    df = _doc(spark, ["no", "longer"])
    for mode in ("literal", "span"):
        assert [r.match_multi for r in C.match_multi(df, MULTI_WORD_CUES, mode=mode).orderBy("tok_id").collect()] \
            == [1, 1]


def test_literal_matches_subset_of_span_for_two_word_cues(spark):
    toks = "it was no longer there rather than here , no more".split()
    df = _doc(spark, toks)
    lit = {r.tok_id: r.match_multi for r in C.match_multi(df, MULTI_WORD_CUES, mode="literal").collect()}
    span = {r.tok_id: r.match_multi for r in C.match_multi(df, MULTI_WORD_CUES, mode="span").collect()}
    assert all(span[k] >= v for k, v in lit.items())


def test_sentence_seq(spark):
    out = C.sentence_seq(_doc(spark, ["a", ".", "b", "."])).orderBy("tok_id").collect()
    assert [r.sent_seq for r in out] == [0, 0, 1, 1]


def test_block_window_equals_plain_window(spark):
    rnd = random.Random(7)
    data = []
    for d, n in enumerate([1, 2, 3, 4, 5, 9, 17, 40]):
        for i in range(n):
            data.append((d, i, rnd.choice(["x", "y", ".", "z"])))
    df = spark.createDataFrame(data, "doc_id long, tok_id int, token string")
    shifts = {f"s{k}": ("token", k, "") for k in (-3, -2, -1, 1, 2, 3)}
    got = C.ordered_context(df, shifts, running={"dots": (F.col("token") == ".").cast("int"),
                                                 "last": ("max", F.when(F.col("token") == ".", F.col("tok_id")))},
                            block=4)
    w = Window.partitionBy("doc_id").orderBy("tok_id")
    wr = w.rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("doc_id", "tok_id", *[
        F.coalesce((F.lag("token", -k) if k < 0 else F.lead("token", k)).over(w), F.lit("")).alias(f"s{k}")
        for k in (-3, -2, -1, 1, 2, 3)],
        F.coalesce(F.sum((F.col("token") == ".").cast("long")).over(wr), F.lit(0)).alias("dots"),
        F.max(F.when(F.col("token") == ".", F.col("tok_id"))).over(wr).alias("last"))
    cols = ["doc_id", "tok_id"] + [f"s{k}" for k in (-3, -2, -1, 1, 2, 3)] + ["dots", "last"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in exp.select(*cols).collect())
    assert a == b


def test_context_tokens_wrap(spark):
    df = _doc(spark, ["A", "B", "C"])
    out = C.context_tokens(df, wrap=True).orderBy("tok_id").collect()
    assert [r.prev_token for r in out] == ["c", "a", "b"]
    assert [r.next_token for r in out] == ["b", "c", "b"]
    plain = C.context_tokens(df).orderBy("tok_id").collect()
    assert plain[0].prev_token == "" and plain[-1].next_token == ""


def test_corpus_position_dense(spark):
    data = [(d, i, "t") for d, n in [(3, 2), (0, 3), (7, 1)] for i in range(n)]
    df = spark.createDataFrame(data, "doc_id long, tok_id int, token string")
    out = C.corpus_position(df).orderBy("corpus_pos").collect()
    assert [(r.doc_id, r.tok_id) for r in out] == [(0, 0), (0, 1), (0, 2), (3, 0), (3, 1), (7, 0)]
    assert [r.corpus_pos for r in out] == list(range(6))


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_match_cues_of_any_length_equals_brute_force(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices("abc", k=n)) for n in (0, 1, 2, 5, 40, 400)] + [None, "", "a b c a b c a"]
    cues = ["a b", "b c a b c", "c c", "a", "b b b a a c", "", "  ", "x y"] + [f"q{i} r{i} s{i}" for i in range(2000)]
    known = {tuple(c.split()) for c in cues if c.split()}
    want = []
    for d, text in enumerate(texts):
        t = (text or "").split()
        longest = [max([n for n in range(1, 7) if i + n <= len(t) and tuple(t[i:i + n]) in known], default=0) for i in range(len(t))]
        want += [(d, i, w, int(any(longest[j] > i - j for j in range(i + 1))), longest[i]) for i, w in enumerate(t)]
    df = _texts(spark, texts).selectExpr("*", "1 as _t", "2 as _m", "3 as token")
    got = C.match_cues(df, cues)
    assert got.columns == ["doc_id", "tok_id", "token", "match_cues", "cue_length"]
    assert sorted(map(tuple, got.collect())) == want
    assert "Exchange" not in C.match_cues(spark.range(3).selectExpr("id doc_id", "'a b' text"), cues)._jdf.queryExecution().executedPlan().toString()
    assert C.match_cues(df, []).where("match_cues > 0 or cue_length > 0").count() == 0


def _corpus_brute(texts, reach, wrap, after):
    flat = [(d, i, w) for d, t in enumerate(texts) for i, w in enumerate((t or "").lower().split())]
    n, out = len(flat), []
    for at, (d, i, w) in enumerate(flat):
        row = [d, i, at, w]
        for k in range(1, reach + 1):
            p, f = at - k, at + k
            row.append(flat[p][2] if p >= 0 or (wrap and p >= -n) else "")
            again = f - n + min(after or 0, n - 1)
            row.append(flat[f][2] if f < n else flat[again][2] if after is not None and again < n else "")
        out.append(tuple(row))
    return out


def test_corpus_context_crosses_document_borders(spark):
    rnd = random.Random(5)
    for texts in ([" ".join(f"W{rnd.randint(0, 99)}" for _ in range(n)) for n in (1, 0, 2, 9, 1, 1, 0, 30, 2)] + [None, "", "end"],
                  ["one"], ["a b", "", "c"]):
        for wrap, after in ((False, None), (True, None), (True, 1)):
            got = C.corpus_context(_texts(spark, texts).selectExpr("*", "1 as _before", "2 as _tok"), 3, wrap, after)
            assert sorted(map(tuple, got.collect())) == _corpus_brute(texts, 3, wrap, after)
    assert C.corpus_context(_texts(spark, ["", None]), 2, True, 1).count() == 0


def test_cue_flag_crosses_document_borders(spark):
    tok = C.corpus_context(_texts(spark, ["he said by no", "means at all"]))
    got = [r.f for r in tok.select("corpus_pos", C.cue_flag(MULTI_WORD_CUES).alias("f")).orderBy("corpus_pos").collect()]
    assert got == [0, 0, 1, 1, 1, 0, 0]


def test_context_tokens_wrap_over_blocks_without_a_join(spark, monkeypatch):
    """Scopes of one block, of several and of one token; a null scope has no
    edges to wrap to; the tokens are joined with nothing."""
    monkeypatch.setattr(C, "BLOCK", 4)
    monkeypatch.setattr(C.ordered_context, "__defaults__", tuple(4 if d == 4096 else d for d in C.ordered_context.__defaults__))
    texts = {1: "A", 2: "a B", 3: "a b C d", 4: "a b c d E", 5: "a b c d e f g h i j k L", None: "x y z"}
    rows = [(d, i, t) for d, s in texts.items() for i, t in enumerate(s.split())]
    out = C.context_tokens(spark.createDataFrame(rows, "doc_id long, tok_id int, token string"), wrap=True)
    got = {(r.doc_id, r.tok_id): (r.prev_token, r.next_token) for r in out.collect()}
    assert len(got) == len(rows)
    for d, s in texts.items():
        w = s.lower().split()
        for i in range(len(w)):
            prev, nxt = w[i - 1], w[i + 1] if i + 1 < len(w) else w[min(1, len(w) - 1)]
            if d is None:
                prev, nxt = prev if i else None, nxt if i + 1 < len(w) else None
            assert got[d, i] == (prev, nxt), (d, i)


def test_context_tokens_reads_long_scopes_only_for_the_edges(spark):
    df = _doc(spark, ["A", "B", "C"])
    plan = C.context_tokens(df, wrap=True)._jdf.queryExecution().optimizedPlan().toString()
    kept = [x for x in plan.splitlines() if "Join" in x]
    assert all("Inner" not in x for x in kept) and plan.count("Window") == 1 and plan.index("Window") < plan.index("Join")


def test_span_cues_are_found_behind_the_gate(spark):
    """Only tokens that are words of a cue build forms, also tokens that hold
    a space themselves."""
    df = _doc(spark, ["by", "no means", "x", "by", "no", "means", "no", "", "by", "means"])
    out = C.match_multi(df, ["by no means", "no means x"]).orderBy("tok_id")
    assert [r.match_multi for r in out.collect()] == [1, 1, 1, 1, 1, 1, 0, 0, 0, 0]
