import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cuespark.llm import url_templates as U
from cuespark.llm.oracle import ORACLE
from cuespark.llm.queries import URL_RULES

SCHEMA = "page_id bigint, url string, bad int"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("url, host, path", [
    ("http://A.Example.COM/x/Y?q#z", "a.example.com", "/x/Y"), ("https://h", "h", ""), ("https://h?x", "h", ""), ("https://h#/x", "h", ""),
    ("//h/p", "", ""), (None, "", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"), ("x://É.Org/a\nb?c", "É.org", "/a\nb"), ("http:///p", "", "/p")])
def test_host_and_path(spark, url, host, path):
    h, p = U.host_and_path(F.col("url"))
    assert tuple(pages(spark, [(1, url, None)]).select(h, p).first()) == (host, path)


@pytest.mark.parametrize("host, path, rule, verdict", [
    ("a.org", "/x", "org/", "allow"), ("org", "/", "org/", "allow"), ("a.org", "", None, None), ("xorg", "/", None, None),
    ("www.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/es", "org/", "allow"), ("notexample.org", "/es/1", "org/", "allow"),
    ("example.org", "/en/12", "example.org/en/1", "block"), ("a.com", "/fr/", "com/fr/", "allow"), ("a.com", "/de/9", "com/de/", "block"), ("", "", None, None)])
def test_longest_rule(spark, host, path, rule, verdict):
    df = spark.createDataFrame([(host, path)], "host string, path string")
    assert tuple(df.select(*U.rule_of(F.col("host"), F.col("path"), URL_RULES)).first()) == (rule, verdict)


def test_branches_split_by_label_and_merge_otherwise(spark):
    rows = [(i, f"http://h.net/bad/{i}", 1) for i in range(30)] + [(100 + i, f"http://h.net/good/{i}", 0) for i in range(30)]
    rows += [(200 + i, f"http://h.net/fine/{i}.html", 0) for i in range(30)]
    rows += [(300 + i, f"http://h.net/bad/{900 + i}", None) for i in range(5)] + [(400, "http://h.net/good/77", None)]
    rows += [(500 + i, f"http://wide.net/{'abcdefghijklmnopqrstuvwxyz'[i]}x", None) for i in range(26)]
    rows += [(600, "http://deep.net/a/b/c/d/e/f/g/h", None), (601, "http://deep.net/a/b/c/d/e/zz/9", None)]
    got = {r.page_id: r for r in U.report(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert {got[i].template for i in (0, 300)} == {"/bad/{n}"} and all(got[i].verdict == "block" for i in (0, 29, 300))
    assert all(got[i].verdict == "allow" for i in (100, 200, 400, 500))
    assert {got[500 + i].template for i in range(26)} == {"/{*}"}
    assert got[600].template == got[601].template == "/a/b/c/d/e/{**}"


def test_a_bad_branch_below_many_segments(spark):
    deep = "http://d.net/a/b/c/d/e/f/"
    rows = [(i, f"{deep}bad/{i}", 1) for i in range(30)] + [(100 + i, f"{deep}good/{i}", 0) for i in range(30)]
    rows += [(200, f"{deep}bad/777", None), (201, f"{deep}good/777", None), (202, f"{deep}", None), (203, "http://d.net/a/b/c/d/e/q/r/s", None)]
    rows += [(300 + i, "http://long.net/" + "x/" * 3000 + f"{'bad' if i % 2 else 'good'}/{i}", i % 2) for i in range(60)]
    got = {r.page_id: r for r in U.report(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].verdict == ("block" if i < 30 or i == 200 else "allow") for i in got if i < 300)
    assert got[200].template == "/a/b/c/d/e/{*}/bad/{n}"  # f and q do not differ by label
    assert all((got[300 + i].verdict == "block") == bool(i % 2) for i in range(60))


def brute_templates(rows):
    """Template of each page, level by level, over plain lists."""
    import re
    from collections import defaultdict
    cut = lambda x: re.sub("[0-9]+", "{n}", re.sub("[0-9a-fA-F-]{16,}", "{h}", x))
    state = [[r[1].split("/")[2], [cut(x) for x in r[1].split("/")[3:]], r[2], ""] for r in rows]
    for k in range(max(len(s[1]) for s in state)):
        nodes = defaultdict(lambda: defaultdict(list))
        live = [s for s in state if len(s[1]) > k and not s[3].endswith("{**}")]
        for s in live:
            nodes[s[0], s[3]][s[1][k]].append(s[2])
        share = lambda v: (sum(x is not None for x in v), sum(x or 0 for x in v))
        for s in live:
            kids = nodes[s[0], s[3]]
            every = [x for v in kids.values() for x in v]
            (known, bad), (all_known, all_bad) = share(kids[s[1][k]]), share(every)
            rest, shown = all_known - known, s[1][k]
            differs = False
            if known and rest and 0 < all_bad < all_known:
                p = all_bad / all_known
                differs = (bad / known - (all_bad - bad) / rest) ** 2 / (p * (1 - p) * (1 / known + 1 / rest)) >= U.CRITICAL
            if len(kids) > 1 and ((len(kids) >= U.MAX_CHILDREN and len(kids) * 2 >= len(every)) or not differs):
                shown = "{*}"
            s.append("{**}" if k >= U.DEPTH and not all_known else shown)
        for s in live:
            s[3] += "/" + s.pop()
    return {r[0]: s[3] for r, s in zip(rows, state)}


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_match_brute_force_at_any_depth(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        segs = [rnd.choice(["a", "b"] if j in (0, 6, 8) else ["c"]) for j in range(rnd.choice([3, 7, 9, 12]))]
        bad = int((segs[6:7] == ["b"] and rnd.random() < 0.9) or (segs[8:9] == ["b"] and rnd.random() < 0.6))
        rows.append((i, f"http://h{rnd.randint(0, 2)}/" + "/".join(segs), rnd.choice([bad, bad, None]) if segs[0] == "a" else None))
    got = {r.page_id: r.template for r in U.report(pages(spark, rows)).collect()}
    assert got == brute_templates(rows)


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, 1), (2, "no scheme", None), (1, None, 1), (None, "http://h.net/a", 0), (3, "http://h.net/" + "a/" * 30000, None), (4, "http://h.net", None), (5, "http://h.net/", None)]
    odd = pages(spark, rows).selectExpr("*", "1 as row", "2 as host", "3 as verdict", "4 as n", "5 as prefix")
    got = U.report(odd).collect()
    assert len(got) == len(rows) and {r.host for r in got if r.page_id in (1, 2)} == {""}
    assert U.report(pages(spark, [])).count() == 0


def test_report_agrees_with_sql(spark):
    hosts = ["a.com", "b.net", "c.org", "x.example.org"]
    rows = [(i, f"http://{hosts[i // 2 % 4]}/{'x/y/z/u/v/w/' * (i % 5 == 0)}{['en', 'fr', 'de'][i % 3]}/{i}" + ["", ".html", "/", "?p=1"][i % 4], None) for i in range(400)]
    labels = [(i, int((i % 3 == 1) ^ (i % 11 == 0)), int(i % 17 == 0)) for i in range(0, 400, 2)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    want = con.execute(f"SELECT page_id, host, path, rule, verdict, template FROM ({ORACLE['op8_url_templates']}) ORDER BY 1").fetchall()
    bad = {i: int(q == 0 or t == 1) for i, q, t in labels}
    got = U.report(pages(spark, [(i, u, bad.get(i)) for i, u, _ in rows]), URL_RULES).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
