import gzip
import hashlib
import random
import re
import time
from html import unescape
from pathlib import Path

import pytest

from cuespark.llm import warc as W

SCHEMA = "page_id bigint, url string, html string"
PAGE = """<!DOCTYPE html><HTML lang="de"><head><title>T &amp; <b>x</b></title><style>p{}</style></head><body><!-- no -->
<header>Top&nbsp;line</header><p class="a">One<br>two &lt;3 &#233;</p><script>var t="</p>";</script><a href="/x?a=1&amp;b=2">li</a><A HREF='y'>nk</A></body>"""


def parse(raw):
    """Records of an uncompressed WARC file, by Content-Length."""
    out = []
    while raw:
        head, rest = raw.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        out.append((fields, rest[:n]))
        assert rest[n:n + 4] == b"\r\n\r\n"
        raw = rest[n + 4:]
    return out


def pages(spark):
    return spark.createDataFrame([(1, "http://h/p", PAGE), (2, None, None), (3, "http://h/\r\nX-Bad: 1", ""), (1, "http://h/p", PAGE), (None, "http://h/n", "plain " * 50000)], SCHEMA)


def test_text_and_facts():
    assert W.plain_text(PAGE) == "Top line\nOne\ntwo <3 é\nlink"
    assert W.page_facts(PAGE) == ("T & <b>x</b>", "de", ["/x?a=1&b=2", "y"])
    assert W.plain_text("") == "" and W.plain_text("< 3 & 4 > 2") == "< 3 & 4 > 2"


def test_records_are_linked_and_keep_the_source(spark):
    source = {r.record_id: r for r in W.responses(pages(spark)).collect()}
    rows = W.derive(W.responses(pages(spark)), keep=["page_id"]).collect()
    assert len(rows) == 10
    by = {(r.refers_to, r.warc_type): r for r in rows}
    for r in rows:
        s = source[r.refers_to]
        other = by[r.refers_to, "conversion" if r.warc_type == "metadata" else "metadata"]
        assert (r.payload_digest, r.http_headers, r.target_uri, r.date) == (s.payload_digest, s.http_headers, s.target_uri, s.date)
        assert r.concurrent_to == other.record_id and other.concurrent_to == r.record_id
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.block_bytes == len(r.block.encode())
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id)
    assert len({r.record_id for r in rows}) == 8  # the repeated page repeats its records
    facts = next(r.block for r in rows if r.page_id == 1 and r.warc_type == "metadata")
    assert "title: T & <b>x</b>\r\n" in facts and "outlink: y\r\n" in facts and "source-header: HTTP/1.1 200 OK\r\n" in facts


def test_ids_differ_where_pages_do(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (None, "5|x", "a"), (5, "x", "a"), (None, "", "a"), (None, None, "a")]
    got = W.derive(W.responses(spark.createDataFrame(rows, SCHEMA))).select("record_id").distinct()
    assert got.count() == 2 * len(rows)


# The page rules as plain expressions, which take quadratic time.
OLD_HIDDEN = re.compile(r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>")
OLD_TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)</title\s*>")
OLD_LANG = re.compile(r"""(?i)<html\b[^>]*?\blang=["']?([A-Za-z-]+)""")
OLD_LINK = re.compile(r"""(?i)<a\b[^>]*?\bhref=["']([^"']*)["']""")
BITS = ["<!--", "-->", "<script", "</script >", "<STYLE>", "</style>", "<head", "</head>", "<title", "</title>", "<html ", "lang=", " lang='", "de", ">", "<", "<a ", "<a", "href=\"", " href='",
        "'", "\"", "x", " ", "\n", "<p", "<b", "</p>", "&lt;", "<noscript>", "</noscript"]


def test_linear_rules_match_plain_expressions():
    rnd = random.Random(5)
    for _ in range(20000):
        page = "".join(rnd.choices(BITS, k=rnd.randint(0, 25)))
        assert W.without_hidden(page) == OLD_HIDDEN.sub(" ", page)
        title, lang = OLD_TITLE.search(page), OLD_LANG.search(page)
        assert (W._title(page), W._lang(page)) == (title.group(1) if title else "", lang.group(1).lower() if lang else "")
        assert W._links(page) == OLD_LINK.findall(page)
        said = W.TAGS.sub("", W.BREAKS.sub("\n", OLD_HIDDEN.sub(" ", page)))
        assert W.plain_text(page) == W.EDGES.sub("\n", W.BLANKS.sub(" ", unescape(said))).strip(" \n")


@pytest.mark.parametrize("bit", ["<script ", "<!--", "<head", "<title ", "<title>", "<html ", "<a ", "<a href=\"x\" ", "<a href='", "<p ", "<", "<script </script ", "<!-- --", "<p <"])
def test_a_page_of_unclosed_tags_takes_linear_time(bit):
    page = bit * (1_000_000 // len(bit))
    start = time.process_time()
    W.plain_text(page), W.page_facts(page)
    assert time.process_time() - start < 5


def test_written_files_round_trip(spark, tmp_path):
    records = W.derive(W.responses(pages(spark)))
    W.write_warc(records, str(tmp_path / "w"))
    got = [x for f in Path(tmp_path / "w").glob("*.gz") for x in parse(gzip.decompress(f.read_bytes()))]
    want = {(r.record_id, r.block.encode(), r.refers_to, r.payload_digest) for r in records.collect()}
    assert {(f["WARC-Record-ID"], b, f["WARC-Refers-To"], f["WARC-Source-Payload-Digest"]) for f, b in got} == want and len(got) == 10
    assert all("X-Bad" not in f for f, _ in got)


def test_empty_table_and_clashing_columns(spark):
    assert W.report(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = pages(spark).selectExpr("*", "1 as row", "2 as plain", "3 as payload", "4 as record_id")
    assert W.report(odd).count() == 10
