import random
import re
import time
from collections import Counter, defaultdict

from cuespark.llm import line_frequency as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    w = WORD.findall(t or "")
    win = defaultdict(list)
    for i in range(len(w) - 7):
        win[tuple(w[i:i + 8])].append(i)
    rep = {p for at in win.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    sym = sum(c in "#*$%&|<>" for c in t or "")
    failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
    return len(w), sum(map(len, w)), sym, len(lines) - len(set(lines)), len(rep), failed


def brute(docs, min_docs, share):
    norm = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    whole, seen = defaultdict(set), defaultdict(set)
    for _, t, h in docs:
        whole[h].add(t or "")
        for x in (t or "").split("\n"):
            if WORD.search(x):
                seen[h, norm(x)].add(t or "")
    freq = {k for k, v in seen.items() if len(v) > min_docs and len(v) > share * len(whole[k[0]])}
    out = []
    for d, t, h in docs:
        b = base(t)
        left = b[0] - sum(len(WORD.findall(x)) for x in (t or "").split("\n") if (h, norm(x)) in freq)
        kept = not b[5] and left >= 0.3 * b[0]
        text = "\n".join(x for x in (t or "").split("\n") if (h, norm(x)) not in freq) if kept else None
        out.append((d, *b, left, kept, text))
    return out


def sample():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["É", "#a|", "日本"]
    common = ["  Common Footer LINE é ", "All rights reserved", "x " * 30]
    docs = []
    for d in range(150):
        lines = [" ".join(rnd.choices(words, k=rnd.randint(0, 12))) for _ in range(rnd.randint(0, 9))]
        lines += rnd.sample(common, rnd.randint(0, 3))
        if d % 7 == 0:
            lines += [lines[0] + " tail"] * 3 if lines else []
        rnd.shuffle(lines)
        docs.append((d, rnd.choice(["\n", "\n\n", " \t\n"]).join(lines), rnd.choice(["a", "b", None])))
    docs += [(200, None, "a"), (201, "", None), (None, docs[3][1], "a"), (5, docs[5][1], docs[5][2]), (5, "other text", "a"),
             (202, " ".join(rnd.choices(words, k=20000)), "b"), (203, "a b c d e f g h " * 40, "b")]
    return docs + [(300 + i, docs[9][1], docs[9][2]) for i in range(60)]


def test_report_matches_brute_force(spark, make_docs):
    docs = sample()
    for few in (L.BROADCAST_ROWS, -1):
        old, L.BROADCAST_ROWS = L.BROADCAST_ROWS, few
        try:
            got = [tuple(r) for r in L.report(make_docs(docs), min_docs=4, share=0.1).collect()]
        finally:
            L.BROADCAST_ROWS = old
        assert Counter(got) == Counter(x[:-1] for x in brute(docs, 4, 0.1))


def test_clean_documents(spark, make_docs):
    docs = sample()
    odd = make_docs(docs).selectExpr("*", "1 as row", "2 as removed", "'k' as kept", "3 as n_words")
    got = L.clean_documents(odd, min_docs=4, share=0.1)
    assert got.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((x[0], x[-1]) for x in brute(docs, 4, 0.1) if x[-2])


def test_a_footer_in_11_of_10000_texts_is_removed(spark, make_docs):
    docs = [(i, " ".join(f"a{i}x{j}" for j in range(30)) + ("\nThe footer" if i < 11 else "\nten of these" if i < 21 else ""), "hot") for i in range(10000)]
    got = {r.doc_id: r.text for r in L.clean_documents(make_docs(docs)).where("doc_id < 21").collect()}
    assert got == {i: docs[i][1].split("\n")[0] if i < 11 else docs[i][1] for i in range(21)}


def test_many_removed_lines_take_linear_time(spark, make_docs):
    own = "\n".join(f"own {i} and some more words here" for i in range(100_000))
    docs = [(d, "\n".join(f"shared {i}" + (f"\nown {d} {i} with a few more words" if i % 2 == 0 else "") for i in range(100_000)), "s") for d in range(2)]
    docs.append((2, own, "s"))
    L.clean_documents(make_docs(docs[2:]), min_docs=1).count()
    start = time.monotonic()
    got = {r.doc_id: r.text for r in L.clean_documents(make_docs(docs), min_docs=1).collect()}
    assert time.monotonic() - start < 40
    assert got == {d: "\n".join(f"own {d} {i} with a few more words" for i in range(0, 100_000, 2)) for d in range(2)} | {2: own}


def test_empty_table(spark, make_docs):
    assert L.report(make_docs([])).count() == 0
    assert L.clean_documents(make_docs([])).count() == 0
