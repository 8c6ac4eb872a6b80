import random
from collections import Counter, defaultdict

import pytest

from cuespark.llm import chat_collapse as C

SCHEMA = "conv_id bigint, turn int, role string, text string"


def show(r, t):
    return f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n"


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r, x))
    seqs = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda k: k[:2])] for c, v in by.items()}
    order = lambda c: (c is not None, c or 0)
    out = {}
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            continue
        same = sorted((d for d, o in seqs.items() if o == s), key=order)
        if same[0] == c:
            out[c] = (len(s), len(same), "".join(show(*p) for p in s))
    return out


def sample(seed):
    rnd = random.Random(seed)
    rows, chats = [], []
    for c in range(120):
        s = list(rnd.choice(chats))[: rnd.randint(1, 9)] if chats and rnd.random() < 0.6 else []
        s += [(rnd.choice(["user", "assistant"]), rnd.choice(["hi", "ok", "more please", "", None, "é"])) for _ in range(rnd.randint(0 if s else 1, 3))]
        chats.append(s)
        start = rnd.choice([0, 1, -2000])
        rows += [(c, start + 3 * i if c % 2 else start + i, r, t) for i, (r, t) in enumerate(s)]
    rows += [(None, 0, "user", "hi"), (None, None, "user", "first"), (500, 0, None, "a"), (501, 0, "a", None), (502, 0, "", "a")]
    rows += [(600, i, "user", f"t{i}") for i in range(3000)] + [(601, 10 + i, "user", f"t{i}") for i in range(2500)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_render_matches_brute_force(spark, seed):
    rows = sample(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as c", "2 as n", "3 as block", "4 as h1").repartition(3)
    got, facts = defaultdict(dict), {}
    for r in C.render(df, piece=100).collect():
        got[r.conv_id][r.piece] = r.text
        facts[r.conv_id] = (r.n_turns, r.copies)
    want = brute(rows)
    assert {c: (*facts[c], "".join(p[i] for i in range(len(p)))) for c, p in got.items()} == want
    assert 601 not in want and 600 in want


def test_tied_and_repeated_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 1, "user", "c"), (3, 0, "user", "z"), (3, 0, "user", "z"), (4, 0, "user", "z")]
    got = {r.conv_id: (r.n_turns, r.copies) for r in C.maximal(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2: (3, 1), 3: (2, 1)}


def test_hot_null_id_lies_in_many_files(spark):
    """A third of the rows have no id, all with one turn number, some equal:
    one conversation, spread over the files of the sort."""
    hot = spark.range(20000).selectExpr("cast(null as bigint) conv_id", "7 turn", "'user' role", "concat('h', id % 5000) text")
    rest = spark.range(40000).selectExpr("id div 8 conv_id", "cast(id % 8 as int) turn", "'user' role", "concat('t', id div 8 % 900, ' ', id % 8) text")
    df = hot.unionByName(rest).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for files of full size
    try:
        turns = C._turns(df, "conv_id", "turn", "role", "text")
        assert turns.where("c.id is null").groupBy("file").count().count() > 1
        got = {r.conv_id: (r.n_turns, r.copies) for r in C.maximal(df).collect()}
        pieces = C.render(df).where("conv_id is null").selectExpr("piece", "size(split(text, '<.im_end.>')) - 1 k").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.pop(None) == (20000, 1)
    assert got == {c: (8, 6 if c < 500 else 5) for c in range(900)}
    assert sorted(r.piece for r in pieces) == list(range(79)) and sum(r.k for r in pieces) == 20000


def test_null_turns_come_first(spark):
    rows = [(1, None, "user", "a"), (1, -5000, "user", "b"), (1, -1, "user", "c")]
    assert C.render(spark.createDataFrame(rows, SCHEMA)).first().text == show("user", "a") + show("user", "b") + show("user", "c")


def test_hashes_tell_null_from_empty(spark):
    rows = [(1, 0, None, "a"), (2, 0, "a", None), (3, 0, "", "a"), (4, 0, "a", "")]
    assert C.maximal(spark.createDataFrame(rows, SCHEMA)).count() == 4


def test_empty_table(spark):
    assert C.render(spark.createDataFrame([], SCHEMA)).count() == 0
