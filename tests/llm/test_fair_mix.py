import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from cuespark.llm import fair_mix as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(t):
    return len(WORD.findall(t or ""))


def water(total, weights):
    """Share by weight; what is above twice a source's size goes to the others."""
    want, free, left = {}, set(total), 1.5 * sum(total.values())
    while free:
        w = sum(weights[s] for s in free)
        full = {s for s in free if left * weights[s] / w > 2 * total[s] + 1e-9}
        if not full:
            return want | {s: left * weights[s] / w for s in free}
        for s in full:
            want[s] = 2 * total[s]
        left -= sum(want[s] for s in full)
        free -= full
    return want


def sample(n=200, seed=1):
    rnd = random.Random(seed)
    docs = [(d, "w " * rnd.choice([0, 1, 5, 30, 100]), rnd.choice(["a", "a", "a", "b", "é", "z", None])) for d in range(n)]
    return docs + [(3, None, "only empty"), (4, docs[4][1], docs[4][2]), (None, "x y z", "b"), (4, "q " * 5, "b")]


def brute(docs):
    total = defaultdict(int)
    for _, t, s in docs:
        total[s] += size(t)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    target = water(total, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)})
    by, copies = defaultdict(list), []
    for i, (d, t, s) in enumerate(docs):
        by[s].append((hashlib.md5(f"mix-1:{'' if d is None else d}".encode()).hexdigest(), size(t), i))
    for s, rows in by.items():
        upto = 0
        for k, n, i in sorted(rows):
            upto += n
            copies += [((e * total[s] + upto) / target[s] if target[s] else 0, k, n, i) for e in (0, 1)]
    taken, at = Counter(), 0
    for _, _, n, i in sorted(copies):
        at += n
        if at > 1.5 * sum(total.values()):
            break
        taken[i] += n
    return [(d, size(t), total[s], round(target[s], 6), taken[i]) for i, (d, t, s) in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_report_matches_brute_force(spark, make_docs, seed):
    docs = sample(seed=seed)
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in M.report(make_docs(docs)).collect()]
    assert Counter(got) == Counter(brute(docs))


def test_sources_stop_near_their_target(spark, make_docs):
    docs = [(d, "w " * (1 + d % 7), "big" if d % 3 else f"s{d % 5}") for d in range(3000)]
    rows = M.report(make_docs(docs)).collect()
    taken, target = Counter(), {}
    for r, (_, _, s) in zip(sorted(rows, key=lambda r: r.doc_id), docs):
        taken[s] += r.taken
        target[s] = r.target
    assert all(abs(taken[s] - target[s]) <= 7 for s in target)


def test_mix_repeats_documents_and_agrees_between_runs(spark, make_docs):
    docs = sample()
    odd = make_docs(docs).selectExpr("*", "1 as size", "2 as target", "3 as row", "4 as copies").repartition(5)
    one, two = (Counter(tuple(r) for r in M.mix(x).collect()) for x in (odd, odd.repartition(3)))
    assert one == two and M.mix(odd).columns == odd.columns
    words = Counter()
    for r, n in one.items():
        words[r[0], r[3]] += n * size(r[1])
    want = Counter()
    for (d, _, s), b in zip(docs, brute(docs)):
        want[d, s] += b[4]
    assert +words == +want


def test_empty_tables(spark, make_docs):
    assert M.report(make_docs([])).count() == 0
    assert [r.taken for r in M.report(make_docs([(1, "", None), (2, None, "a")])).collect()] == [0, 0]
    assert M.mix(make_docs([])).count() == 0
