import hashlib
import pickle
import random
import re

import numpy as np

from cuespark.llm import decontaminate as D
from cuespark.llm.textblocks import ALNUM_BYTES, Words, byte_table, lower_table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(docs, items, k=10):
    win = {}
    for item, t in items:
        w = words(t)
        if w:
            n = min(k, len(w))
            for i in range(len(w) - n + 1):
                win.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in win}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in win:
                    hit.update(range(i, i + n))
                    found |= win[tuple(w[i:i + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def sample():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(30)] + ["É", "日本", "naïve", "x9"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 4, 12, 25])))) for i in range(25)]
    items += [(None, "null id item " * 5), (90, None), (91, ""), (92, "... --"), (3, items[3][1])]
    docs = []
    for d in range(120):
        t = rnd.choices(vocab, k=rnd.randint(0, 60))
        if d % 3 == 0:
            t[len(t) // 2:len(t) // 2] = rnd.choice(items[:26])[1].upper().split()
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(t)))
    docs += [(500, None), (501, ""), (7, docs[7][1]), (None, docs[0][1]), (502, " ".join(rnd.choices(vocab, k=30000)))]
    return docs, items


def bench(spark, items):
    return spark.createDataFrame([(i, t) for i, t in items], "item_id bigint, text string")


def test_matches_brute_force(spark, make_docs):
    docs, items = sample()
    got = [tuple(r) for r in D.report(make_docs(docs), bench(spark, items)).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_benchmark_in_blocks_gives_the_same(spark, make_docs):
    docs, items = sample()
    got = [tuple(r) for r in D.report(make_docs(docs), bench(spark, items), max_bytes=400).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_long_items_are_many_pieces(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "PIECE", 3)
    docs, items = sample()
    assert D.pieces(bench(spark, items)).count() > len(items)
    got = [tuple(r) for r in D.report(make_docs(docs), bench(spark, items)).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_window_set_keeps_to_its_bound():
    rnd = random.Random(1)
    pieces = [(str(i), 10, " ".join(rnd.choices([f"word{j}" for j in range(5000)], k=4105))) for i in range(40)]
    held = sum(len(s) + D.WORD_BYTES * 4105 for _, _, s in pieces)
    ws = D.WindowSet(pieces)
    assert ws.nbytes <= 1.2 * held and len(pickle.dumps(ws)) <= 1.2 * held


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(D, "window_hashes", lambda h, k: np.full(max(len(h) - k + 1, 0), 7, np.uint64))
    ws = D.WindowSet([("a", 2, "x y z"), ("b", 2, "y z"), ("c", 2, "x y"), ("c", 2, "q x y")])
    data = np.frombuffer(b"x y / y z / z y", dtype=np.uint8)
    counts, hits = D.scan_block(data, np.array([0, 4, 9, 15]), ws, byte_table(ALNUM_BYTES), lower_table())
    assert {r: (w, {ws.names[i] for i in n}) for r, (w, n) in hits.items()} == {0: ({0, 1}, {"a", "c"}), 1: ({0, 1}, {"a", "b"})}


def test_empty_tables_and_clashing_columns(spark, make_docs):
    docs, items = sample()
    assert D.report(make_docs([]), bench(spark, items)).count() == 0
    clean = D.report(make_docs(docs), bench(spark, []))
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.count() == len(docs)
    odd = make_docs(docs).selectExpr("*", "1 as hit_words", "'a' as items", "2 as n_words", "3 as row")
    kept = D.clean_documents(odd, bench(spark, items))
    assert kept.columns == odd.columns
    want = {r[0] for r in brute(docs, items) if not r[5]}
    assert {r.doc_id for r in kept.collect()} == want


def test_remove_spans(spark, make_docs):
    docs = [(1, "Aa bb. One two Three four five six seven eight nine ten eleven! cc"), (2, "nothing here"), (3, None)]
    items = [(1, "one two three four five six seven eight nine ten eleven")]
    got = {r.doc_id: r.text for r in D.remove_spans(make_docs(docs), bench(spark, items)).collect()}
    assert got == {1: "Aa bb. ! cc", 2: "nothing here", 3: None}


def test_word_blocks_do_not_join_rows():
    data = np.frombuffer(b"abcDEf 12", dtype=np.uint8)
    w = Words(lower_table()[data], np.array([0, 3, 3, 9]), byte_table(ALNUM_BYTES))
    assert w.row_start.tolist() == [0, 1, 1, 3]
    assert [bytes(lower_table()[data][a:b]) for a, b in zip(w.start, w.end)] == [b"abc", b"def", b"12"]
