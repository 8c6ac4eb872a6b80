import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cuespark.llm import fingerprints as P

W, UNIT = P.WINDOW, 1 << 20


def level(window):
    total = sum(round(c * math.log2(c) * UNIT) for c in Counter(window).values())
    return P.LEVELS * (W * 6 * UNIT - total) // (W * 6 * UNIT)


def windows(raw):
    return [raw[i:i + W] for i in range(len(raw) - W + 1)]


def brute_ranks(texts):
    n = Counter(level(w) for t in texts for w in windows((t or "").encode()))
    ranks = [0] * (P.LEVELS + 1)
    for r, lv in enumerate(sorted(range(P.LEVELS + 1), key=lambda lv: (n[lv], lv))):
        ranks[lv] = r
    return ranks


def mix(x):
    full = (1 << 64) - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & full
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & full
    return x ^ x >> 31


def feature_hash(w):
    h = 0x9E3779B97F4A7C15
    for i in range(0, W, 8):
        h = mix(h ^ int.from_bytes(w[i:i + 8], "little")) * 0xD6E8FEB86659FD93 & (1 << 64) - 1
    return mix(h)


def brute_digest(raw, ranks):
    ws = windows(raw)
    ok = [(ranks[level(w)], i) for i, w in enumerate(ws) if level(w) >= P.LEAST]
    votes = Counter()
    for s in range(1 - W, len(ws)):
        here = [x for x in ok if s <= x[1] < s + W]
        if here:
            votes[min(here)[1]] += 1
    features = [feature_hash(ws[i]) for i in sorted(votes) if votes[i] >= P.VOTES]
    if not features and raw:
        features = [int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")]
    features = list(dict.fromkeys(features))
    filters = []
    for k in range(0, len(features), P.FULL):
        f = bytearray(P.FILTER)
        for h in features[k:k + P.FULL]:
            for i in range(P.BITS):
                bit = h >> (11 * i) & 2047
                f[bit // 8] |= 128 >> bit % 8
        filters.append(bytes(f))
    return filters, (len(features) - 1) % P.FULL + 1 if features else 0


def brute_likeness(x, y):
    if (len(x[0]), x[1]) > (len(y[0]), y[1]):
        x, y = y, x
    if not x[0]:
        return float(not y[0])
    sizes = lambda d: [P.FULL] * (len(d[0]) - 1) + [d[1]]
    total = 0
    for f, n in zip(x[0], sizes(x)):
        best = 0
        for g, k in zip(y[0], sizes(y)):
            a, b = int.from_bytes(f, "big"), int.from_bytes(g, "big")
            p = lambda k: (1 - 1 / 2048) ** (5 * k)
            chance = 2048 * (1 - p(n) - p(k) + p(n + k))
            most = min(a.bit_count(), b.bit_count())
            best = max(best, ((a & b).bit_count() - chance) / (most - chance) if most > chance else float(a == b))
        total += n * min(max(best, 0), 1)
    return total / sum(sizes(x))


def text(rnd, n):
    return "".join(rnd.choices("etaoinshrdlu  \n.éß日", k=n))


def corpus(n=60):
    rnd = random.Random(13)
    docs = [(rnd.randint(-50, 10**6), text(rnd, rnd.choice([1, 3, 60, 64, 70, 130, 400, 900]))) for _ in range(n)]
    return docs + [(5, None), (6, ""), (None, "null id " * 30), (None, text(rnd, 300)), (7, "a" * 500), (8, text(rnd, 5_000)), (9, "xyz")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(b"aab cde\n"), max_size=300).map(bytes))
def test_entropies_of_all_windows(raw):
    assert P.entropies(np.frombuffer(raw, np.uint8)).tolist() == [level(w) for w in windows(raw)]


def test_digests_are_those_of_brute_force(monkeypatch):
    docs = [(t or "").encode() for _, t in corpus()]
    ranks = brute_ranks([d.decode() for d in docs])
    for block in (1 << 20, 700):
        monkeypatch.setattr(P, "BLOCK", block)
        got = P.text_digests(docs, np.array(ranks))
        for d, g in zip(docs, got):
            filters, last = brute_digest(d, ranks)
            assert [f.tobytes() for f in g.filters] == filters and g.last == last
            again = P.Digest.parse(str(g))
            assert (again.filters == g.filters).all() and again.last == g.last and len(again.filters) == len(g.filters)


def test_likeness_is_that_of_brute_force():
    docs = [(t or "").encode() for _, t in corpus()] + [(t or "").encode()[10:] for _, t in corpus()]
    ranks = brute_ranks([(t or "") for _, t in corpus()])
    got, want = P.text_digests(docs[:67], np.array(ranks)), [brute_digest(d, ranks) for d in docs[:67]]
    for i in range(67):
        for j in (i, (i * 7 + 1) % 67, (i + 1) % 67):
            x = P.likeness(got[i], got[j])
            assert x == pytest.approx(brute_likeness(want[i], want[j]), abs=1e-9) and 0 <= x <= 1
            assert x == P.likeness(got[j], got[i])
        assert P.likeness(got[i], got[i]) == 1


def table(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=str)


def brute_report(docs, order, ranks):
    out = []
    for k, i in enumerate(order):
        t, nxt = docs[i][1] or "", docs[order[(k + 1) % len(order)]][1] or ""
        copy = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        a, b, c = P.text_digests([t.encode(), copy.encode(), nxt.encode()], ranks)
        out.append((docs[i][0], len(t), hashlib.sha256(copy.encode()).hexdigest(), str(a), str(b), P.likeness(a, b), P.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 8])
def test_report(spark, make_docs, parts, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 2000 if parts == 1 else P.GROUP)
    docs = [d for d in corpus() if d[0] is not None] + [(None, "one null id " * 20)]
    docs = list({d[0]: d for d in docs}.values())
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = make_docs(docs).repartition(5).selectExpr("doc_id", "text", "1 AS id", "2 AS part", "3 AS edge")
        ranks = P.entropy_ranks(frame)
        assert ranks.tolist() == brute_ranks([t for _, t in docs])
        order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
        assert table(P.edited_report(frame)) == brute_report(docs, order, ranks)
        plain = {r.doc_id: r.fingerprint for r in P.fingerprints(frame, ranks).collect()}
        assert plain == {r[0]: r[3] for r in table(P.edited_report(frame))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_repeated_rows_one_row_and_no_row(spark, make_docs):
    rnd = random.Random(3)
    t, u = text(rnd, 500), text(rnd, 300)
    got = table(P.edited_report(make_docs([(1, t)] * 400 + [(2, u)])))
    ranks = P.entropy_ranks(make_docs([(1, t)] * 400 + [(2, u)]))
    docs = [(1, t)] * 400 + [(2, u)]
    assert got == brute_report(docs, list(range(401)), ranks)
    assert len(P.edited_report(make_docs([(1, t)])).collect()) == 1
    assert P.edited_report(make_docs([])).count() == 0


def test_edited_copies_are_near_and_others_are_not(spark, make_docs):
    rnd = random.Random(4)
    words = ["".join(rnd.choices("etaoinshrdlucmf", k=rnd.randint(2, 9))) for _ in range(400)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.choice([40, 200, 3000])))) for i in range(200)]
    got = P.edited_report(make_docs(docs)).collect()
    mean = lambda v: sum(v) / len(v)
    assert mean([r.near_edited for r in got]) > 0.65 and mean([r.near_next for r in got]) < 0.1
    # few features (texts of 200 letters have about five) leave more to chance
    assert all(r.near_edited > r.near_next for r in got)
    long = [r for r in got if r.n_chars > 10_000]
    assert long and min(r.near_edited for r in long) > 0.65 and max(r.near_next for r in long) < 0.4
    assert mean([r.near_next for r in long]) < 0.1
