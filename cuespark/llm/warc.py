"""WARC derivative builder (4): responses into linked metadata and plain-text
conversion records.

Every response gives two records that name it in ``WARC-Refers-To`` and keep
its target URI, date, HTTP headers and payload digest: a ``metadata`` record
(title, language, out-links, source headers) and a ``conversion`` record (the
page's text).  They name each other in ``WARC-Concurrent-To``.  A response's id is made from
its page id, url and payload digest, the others from the response's, so a
repeated run gives the same records and different pages have different ids.

Texts are extracted in Arrow batches, a row at a time, in time linear in the
page, unclosed tags or not; nothing is shuffled.
``write_warc`` writes files that hold one record after the other, through
Spark's own writer.

Defined results: a null page is an empty one, with an empty text; a null url
gives no target URI; line breaks in a header's value become spaces; repeated
rows give repeated records; an empty table gives none; only the named columns
are read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "2000-01-01T00:00:00Z"  # of pages that come without a time of capture
CRLF = "\r\n"

HIDDEN = re.compile(r"(?i)<!--|<(script|style|head|noscript)\b")
CLOSERS = {k: re.compile(rf"(?i)</{k}\s*>") for k in ("script", "style", "head", "noscript")} | {None: re.compile("-->")}
BREAKS = re.compile(r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>")
TAGS = re.compile(r"<[a-zA-Z/!?][^>]*>")
TITLE, TITLE_END = re.compile(r"(?i)<title\b"), re.compile(r"(?i)</title\s*>")
HTML, LANG = re.compile(r"(?i)<html\b"), re.compile(r"""(?i)\blang=["']?([A-Za-z-]+)""")
ANCHOR, HREF, QUOTE = re.compile(r"(?i)<a\b"), re.compile(r"""(?i)\bhref=["']"""), re.compile("[\"']")
BLANKS, EDGES = re.compile(r"[ \t\x0b\f\r\xa0]+"), re.compile(r" ?\n[ \n]*")


def without_hidden(page: str) -> str:
    """The page with comments, scripts, styles and heads as a blank.  A kind
    that is not closed after one opener is not closed after later ones, so
    it is looked for once."""
    out, done, open_kinds = [], 0, set()
    for m in HIDDEN.finditer(page):
        kind = m.group(1) and m.group(1).lower()
        if m.start() < done or kind in open_kinds:
            continue
        close = CLOSERS[kind].search(page, m.end())
        if close is None:
            open_kinds.add(kind)
            continue
        out += [page[done:m.start()], " "]
        done = close.end()
    return "".join([*out, page[done:]])


def plain_text(page: str) -> str:
    """Visible text of a page, a line per block, blanks collapsed."""
    t = without_hidden(page)
    end = t.rfind(">") + 1  # no tag ends after it
    t = unescape(TAGS.sub("", BREAKS.sub("\n", t[:end])) + t[end:])
    return EDGES.sub("\n", BLANKS.sub(" ", t)).strip(" \n")


def _title(page: str) -> str:
    opened = TITLE.search(page)
    start = page.find(">", opened.end()) + 1 if opened else 0
    close = TITLE_END.search(page, start) if start else None
    return page[start:close.start()] if close else ""


def _in_tags(page: str, opener: re.Pattern, wanted: re.Pattern):
    """First match of ``wanted`` between an opener and the next ``>``, again
    from the place that the caller sends; every ``>`` is looked up once."""
    at, end = 0, -1
    while m := opener.search(page, at):
        if end < m.end():
            end = page.find(">", m.end())
            end = len(page) if end < 0 else end
        found = wanted.search(page, m.end(), end)
        at = end if found is None else (yield found)


def _lang(page: str) -> str:
    found = next(_in_tags(page, HTML, LANG), None)
    return found.group(1).lower() if found else ""


def _links(page: str) -> list[str]:
    links, tags = [], _in_tags(page, ANCHOR, HREF)
    found = next(tags, None)
    while found and (close := QUOTE.search(page, found.end())):
        links.append(page[found.end():close.start()])
        try:
            found = tags.send(close.end())
        except StopIteration:
            break
    return links


def page_facts(page: str) -> tuple[str, str, list[str]]:
    """Title, language and out-links as they stand."""
    one_line = lambda s: " ".join(unescape(s).split())
    return one_line(_title(page)), _lang(page), [one_line(x) for x in _links(page)]


def _extract(batches):
    for batch in batches:
        pages = [p or "" for p in batch.column("payload").to_pylist()]
        title, lang, links = zip(*map(page_facts, pages)) if pages else ((), (), ())
        cols = [pa.array(list(map(plain_text, pages)), pa.string()), pa.array(title, pa.string()), pa.array(lang, pa.string()), pa.array(links, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *cols], names=["row", "plain", "title", "lang", "links"])


def urn(*parts: Column) -> Column:
    """A record id made from the digest of ``parts``."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _marked(part: Column) -> Column:
    """``part`` after its length, so that neither a null nor a separator in
    it can be taken for another part."""
    return F.coalesce(F.concat(F.length(part).cast("string"), F.lit(":"), part), F.lit("null"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of stored pages: ``record_id, target_uri, date,
    http_headers, payload, payload_digest`` and the page's id."""
    body = F.coalesce(F.col(html), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(body).cast("string"))
    return pages.select(F.col(page_id).alias("page_id"), urn(F.lit("response"), digest(body), _marked(F.col(page_id).cast("string")), _marked(F.col(url))).alias("record_id"),
                        F.col(url).alias("target_uri"), F.lit(DATE).alias("date"), head.alias("http_headers"), body.alias("payload"), digest(body).alias("payload_digest"))


_KEPT = ("record_id", "target_uri", "date", "http_headers", "payload_digest")


def derive(source: DataFrame, keep=()) -> DataFrame:
    """Two rows per response: ``warc_type``, ids (``record_id, refers_to,
    concurrent_to``), ``target_uri``, ``date``, ``content_type``, the source's
    ``payload_digest`` and ``http_headers``, ``block``, ``block_digest`` and
    ``block_bytes``; with the ``keep`` columns of the response."""
    rows = source.select(F.struct(*_KEPT, F.struct(F.lit(0), *keep).alias("kept")).alias("row"), F.col("payload"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, plain string, title string, lang string, links array<string>"
    r = rows.mapInArrow(_extract, schema).select("row.*", "plain", "title", "lang", "links")
    ids = {k: urn(F.lit(k), F.col("record_id")) for k in ("metadata", "conversion")}
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    source_headers = F.array_join(F.transform(F.split("http_headers", CRLF), lambda h: line("source-header", h)), "")
    links = F.array_join(F.transform("links", lambda x: line("outlink", x)), "")
    facts = F.concat(line("title", F.col("title")), line("language", F.col("lang")), line("source-payload-digest", F.col("payload_digest")), source_headers, links)

    def record(kind, other, content_type, block):
        return F.struct(F.lit(kind).alias("warc_type"), ids[kind].alias("record_id"), F.col("record_id").alias("refers_to"), ids[other].alias("concurrent_to"),
                        "target_uri", "date", F.lit(content_type).alias("content_type"), "payload_digest", "http_headers", block.alias("block"),
                        digest(block).alias("block_digest"), F.octet_length(block).cast("long").alias("block_bytes"))

    both = F.array(record("metadata", "conversion", "application/warc-fields", facts), record("conversion", "metadata", "text/plain; charset=utf-8", F.col("plain")))
    return r.select("kept", F.explode(both).alias("r")).select(*[F.col("kept")[k].alias(k) for k in keep], "r.*")


def record_text(records: DataFrame) -> DataFrame:
    """``value``: each record's version line, headers and block."""
    clean = lambda c: F.regexp_replace(c, "[\r\n]+", " ")
    header = lambda name, c: F.coalesce(F.concat(F.lit(f"{name}: "), clean(c), F.lit(CRLF)), F.lit(""))
    names = {"WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Concurrent-To": "concurrent_to", "WARC-Target-URI": "target_uri",
             "WARC-Date": "date", "WARC-Block-Digest": "block_digest", "WARC-Source-Payload-Digest": "payload_digest", "Content-Type": "content_type"}
    heads = [header(n, F.col(c)) for n, c in names.items()] + [header("Content-Length", F.col("block_bytes").cast("string"))]
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), *heads, F.lit(CRLF), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Gzip files of records, each closed by two line breaks."""
    record_text(records).write.mode("overwrite").option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def report(pages: DataFrame) -> DataFrame:
    """The derivative records of a table of pages, blocks as digests."""
    d = derive(responses(pages), keep=["page_id"])
    return d.select("page_id", "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type", "payload_digest", "block_digest", "block_bytes")
