"""DuckDB statements of the queries in ``queries.QUERIES`` that SQL can
express (name -> SQL over the parquet views)."""

from __future__ import annotations

ORACLE = {}

ORACLE["op3_decontaminate"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(greatest(len(w) - 9, 1)),
                   lambda i: list_aggregate(w[i + 1 : i + 10], 'string_agg', ' '))) AS s FROM bw WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
cand AS (SELECT r, n, unnest(list_transform(range(len(w) - n + 1), lambda i: {'i': i, 's': list_aggregate(w[i + 1 : i + n], 'string_agg', ' ')})) AS c
         FROM dw, lens WHERE len(w) >= n),
hit AS (SELECT cand.r, cand.c.i AS i, win.n, win.item_id FROM cand JOIN win ON win.n = cand.n AND win.s = cand.c.s),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

ORACLE["op5_line_frequency"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT r, unnest(list_transform(range(len(w) - 7), lambda i: {'i': i, 's': list_aggregate(w[i + 1 : i + 8], 'string_agg', ' ')})) AS x
        FROM w WHERE len(w) > 8),
again AS (SELECT r, x.i AS i FROM win QUALIFY count(*) OVER (PARTITION BY r, x.s) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
ln AS (SELECT r, source, t, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS k FROM (SELECT r, source, t, unnest(l) AS line FROM w)),
freq AS (SELECT source, k FROM ln GROUP BY source, k HAVING count(DISTINCT t) > 10),
cut AS (SELECT r, sum(n) AS n FROM ln JOIN freq ON ln.k = freq.k AND ln.source IS NOT DISTINCT FROM freq.source GROUP BY r),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, (len(w) - coalesce(cut.n, 0))::BIGINT AS n_left
      FROM w LEFT JOIN rep USING (r) LEFT JOIN cut USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_left,
       NOT base_failed AND n_left >= n_words * 0.3 AS kept FROM b"""

ORACLE["op7_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT k.*, coalesce(k.doc_id > f.first_doc, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""

ORACLE["op9_fair_mix"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source),
s1 AS (SELECT source, total, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2 * total AS most FROM s0),
s2 AS (SELECT *, (sum(total) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM s1
       WINDOW b AS (ORDER BY most::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, least(most::DOUBLE, (SELECT max(level) FROM s2 WHERE most >= level * w) * w) AS target FROM s2),
c AS (SELECT d.*, s3.total, s3.target, sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN s3 ON d.source IS NOT DISTINCT FROM s3.source),
e AS (SELECT r, k, size, source, CASE WHEN target > 0 THEN (x * total + upto)::DOUBLE / target ELSE 0 END AS f FROM c, (VALUES (0), (1)) AS t(x)),
q AS (SELECT r, size, sum(size) OVER (ORDER BY f, k, source ROWS UNBOUNDED PRECEDING) <= 1.5 * (SELECT sum(total) FROM s0) AS fits FROM e),
t AS (SELECT r, sum(CASE WHEN fits THEN size ELSE 0 END)::BIGINT AS taken FROM q GROUP BY r)
SELECT doc_id, size, total AS source_size, target, taken FROM c JOIN t USING (r)"""


def _url_templates(depth: int = 10) -> str:
    """The template tree level by level, for paths of up to ``depth``
    segments; constants as in url_templates."""
    ctes = [r"""u AS (SELECT page_id, url, try_cast(nullif(regexp_extract(url, '/([0-9]{1,18})(?:\.html|/)?(?:[?#].*)?$', 1), '') AS BIGINT) AS doc_id FROM pages),
l AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
p AS (SELECT page_id, bad, translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2), '') AS path FROM u LEFT JOIN l USING (doc_id)),
p1 AS (SELECT *, list_transform(CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(CASE WHEN path LIKE '/%' THEN path[2:] ELSE path END, '/') END,
                 lambda s: regexp_replace(regexp_replace(s, '[0-9a-fA-F-]{16,}', '{h}', 'g'), '[0-9]+', '{n}', 'g')) AS s0 FROM p),
p2 AS (SELECT * EXCLUDE (s0), s0 AS segs FROM p1),
t0 AS (SELECT host, segs, count(*) AS n, count(bad) AS known, coalesce(sum(bad), 0) AS bad, '' AS prefix FROM p2 GROUP BY host, segs)"""]
    for k in range(1, depth + 1):
        ctes.append(f"""k{k} AS (SELECT host, prefix, segs[{k}] AS child, sum(n) AS n, sum(known) AS known, sum(bad) AS bad FROM t{k - 1} WHERE len(segs) >= {k} GROUP BY ALL),
n{k} AS (SELECT host, prefix, child, n, known, bad, count(*) OVER w AS kids, sum(n) OVER w AS an, sum(known) OVER w AS ak, sum(bad) OVER w AS ab FROM k{k} WINDOW w AS (PARTITION BY host, prefix)),
z{k} AS (SELECT host, prefix, child, kids, an, ak, power(bad / nullif(known, 0) - (ab - bad) / nullif(ak - known, 0), 2)
         / nullif(ab / nullif(ak, 0) * (1 - ab / nullif(ak, 0)) * (1 / nullif(known, 0) + 1 / nullif(ak - known, 0)), 0) AS z FROM n{k}),
t{k} AS (SELECT t.host, segs, n, known, bad, CASE WHEN len(segs) < {k} OR t.prefix LIKE '%/{{**}}' THEN t.prefix WHEN {k} > 5 AND ak = 0 THEN t.prefix || '/' || '{{**}}' WHEN kids > 1 AND ((kids >= 20 AND kids * 2 >= an) OR NOT coalesce(z >= 3.84, false))
         THEN t.prefix || '/' || '{{*}}' ELSE t.prefix || '/' || child END AS prefix
         FROM t{k - 1} t LEFT JOIN z{k} z ON z.host = t.host AND z.prefix = t.prefix AND z.child = t.segs[{k}])""")
    return "WITH " + ",\n".join(ctes) + f""",
h AS (SELECT host, (sum(bad) + 5 * (SELECT coalesce(sum(bad) / nullif(sum(known), 0), 0) FROM t{depth})) / (sum(known) + 5) AS hr FROM t{depth} GROUP BY host),
v AS (SELECT host, prefix, (sum(bad) + 5 * any_value(hr)) / (sum(known) + 5) > 0.5 AS blocked FROM t{depth} JOIN h USING (host) GROUP BY host, prefix),
r(verdict, rule, rhost, rpath) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
                                       ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p2 JOIN r
      ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, p2.host, path, rule, coalesce(verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, t.prefix AS template
FROM p2 JOIN t{depth} t ON t.host = p2.host AND t.segs = p2.segs JOIN v ON v.host = t.host AND v.prefix = t.prefix LEFT JOIN f USING (page_id)"""


ORACLE["op8_url_templates"] = _url_templates()

ORACLE["op1_chat_collapse"] = r"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS said
           FROM conversations),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS l, count(*) AS n FROM t GROUP BY conv_id),
w AS (SELECT min(conv_id) AS conv_id, l, n, count(*) AS copies FROM c GROUP BY l, n),
p AS (SELECT DISTINCT l[:k] AS l FROM (SELECT l, unnest(range(1, n)) AS k FROM w)),
m AS (SELECT conv_id, n, copies FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l = w.l))
SELECT conv_id, ((pos - 1) // 256)::INT AS piece, any_value(n)::BIGINT AS n_turns, any_value(copies)::BIGINT AS copies, string_agg(said, '' ORDER BY pos) AS text
FROM m JOIN t USING (conv_id) GROUP BY conv_id, (pos - 1) // 256"""

ORACLE["op4_warc"] = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
s AS (SELECT *, md5('response|sha256:' || sha256(h) || '|' || coalesce(length(page_id::VARCHAR) || ':' || page_id, 'null') || '|' || coalesce(length(url) || ':' || url, 'null')) AS m, regexp_replace(h, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>', ' ', 'g') AS v FROM p),
b AS (SELECT *, regexp_replace(regexp_replace(v, '(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>', chr(10), 'g'),
                              '<[a-zA-Z/!?][^>]*>', '', 'g') AS x FROM s),
e AS (SELECT *, replace(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&amp;', '&') AS y,
             trim(regexp_replace(replace(replace(replace(replace(regexp_extract(h, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS title,
             lower(regexp_extract(h, '(?i)<html\b[^>]*?\blang=["'']?([A-Za-z-]+)', 1)) AS lang, regexp_extract_all(h, '(?i)<a\b[^>]*?\bhref=["'']([^"'']*)["'']', 1) AS hrefs FROM b),
f AS (SELECT *, trim(regexp_replace(regexp_replace(y, '[ \t\x0b\f\r\x{A0}]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS plain,
             list_transform(hrefs, lambda u: trim(regexp_replace(replace(replace(u, '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS links,
             '<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' AS rid, chr(13) || chr(10) AS nl, 'sha256:' || sha256(h) AS pd FROM e),
g AS (SELECT *, md5('metadata|' || rid) AS mm, md5('conversion|' || rid) AS mc,
             'title: ' || title || nl || 'language: ' || lang || nl || 'source-payload-digest: ' || pd || nl || 'source-header: HTTP/1.1 200 OK' || nl
             || 'source-header: Content-Type: text/html; charset=utf-8' || nl || 'source-header: Content-Length: ' || strlen(h) || nl
             || coalesce(list_aggregate(list_transform(links, lambda u: 'outlink: ' || u || nl), 'string_agg', ''), '') AS facts FROM f),
i AS (SELECT *, '<urn:uuid:' || mm[1:8] || '-' || mm[9:12] || '-' || mm[13:16] || '-' || mm[17:20] || '-' || mm[21:32] || '>' AS im,
             '<urn:uuid:' || mc[1:8] || '-' || mc[9:12] || '-' || mc[13:16] || '-' || mc[17:20] || '-' || mc[21:32] || '>' AS ic FROM g)
SELECT page_id, 'metadata' AS warc_type, im AS record_id, rid AS refers_to, ic AS concurrent_to, url AS target_uri, '2000-01-01T00:00:00Z' AS date,
       'application/warc-fields' AS content_type, pd AS payload_digest, 'sha256:' || sha256(facts) AS block_digest, strlen(facts)::BIGINT AS block_bytes FROM i
UNION ALL SELECT page_id, 'conversion', ic, rid, im, url, '2000-01-01T00:00:00Z', 'text/plain; charset=utf-8', pd, 'sha256:' || sha256(plain), strlen(plain)::BIGINT FROM i"""

_PATTERNS = {"assign": r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
             "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}", "markov": "[A-Za-z0-9+/_=-]{16,}"}


def _spans(name: str, number: int, group: int, least: int, table: str = "d") -> str:
    """Matches of a pattern with their places: the lengths of the pieces
    between matches and of the matches before."""
    p = f"'{_PATTERNS[name]}'"
    return f"""{name}_m AS (SELECT r, string_split_regex(t, {p}) AS g, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS v
             FROM {table} WHERE regexp_matches(t, {p})),
{name} AS (SELECT r, x.s AS s, {number} AS k, x.s + length(x.m) AS e, x.v AS v FROM (SELECT r, unnest(list_transform(range(1, len(m) + 1), lambda i:
             {{'s': list_sum(list_transform(g[:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[:i - 1], lambda y: length(y))), 0), 'm': m[i], 'v': v[i]}})) AS x
             FROM {name}_m) WHERE length(x.v) >= {least})"""


def _blanked(name: str, group: int, least: int, table: str) -> str:
    """``table`` with blanks for the matches that have a value long enough."""
    p = f"'{_PATTERNS[name]}'"
    return f"""(SELECT r, CASE WHEN regexp_matches(t, {p}) THEN array_to_string(list_transform(range(1, len(string_split_regex(t, {p})) + 1), lambda i: string_split_regex(t, {p})[i]
             || CASE WHEN i > len(regexp_extract_all(t, {p}, 0)) THEN '' WHEN length(regexp_extract_all(t, {p}, {group})[i]) >= {least}
                     THEN repeat(' ', length(regexp_extract_all(t, {p}, 0)[i])) ELSE regexp_extract_all(t, {p}, 0)[i] END), '') ELSE t END AS t FROM {table})"""


def _cut() -> str:
    out = "t"
    for k in ("assign", "access", "hex"):
        out = f"regexp_replace({out}, '{_PATTERNS[k]}', ' ', 'g')"
    return out


ORACLE["op6_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{_spans('assign', 0, 2, 6)},
{_spans('access', 1, 0, 0)},
{_spans('hex', 2, 0, 0)},
rest1 AS MATERIALIZED {_blanked('assign', 2, 6, 'd')},
rest2 AS MATERIALIZED {_blanked('access', 0, 0, 'rest1')},
rest3 AS MATERIALIZED {_blanked('hex', 0, 0, 'rest2')},
{_spans('markov', 3, 0, 0, 'rest3')},
base AS (FROM assign UNION ALL FROM access UNION ALL FROM hex),
val AS (SELECT DISTINCT * FROM (SELECT true AS random, v FROM base UNION ALL SELECT false, unnest(regexp_extract_all({_cut()}, '[A-Za-z0-9+/_=-]{{8,}}')) FROM d)),
ch AS (SELECT random, list_filter(string_split(v, ''), lambda c: c <> '' AND contains('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-', c)) AS c FROM val),
pair AS (SELECT random, unnest(list_transform(range(1, len(c) + 1), lambda i: {{'a': CASE WHEN i = 1 THEN '' ELSE c[i - 1] END, 'b': c[i]}})) AS p FROM ch),
cnt AS (SELECT random, p.a AS a, p.b AS b, count(*) AS n FROM pair GROUP BY ALL),
tot AS (SELECT random, a, sum(n) AS n FROM cnt GROUP BY ALL),
free AS (SELECT row_number() OVER () AS q, * FROM markov),
step AS (SELECT q, unnest(list_transform(range(1, length(v) + 1), lambda i: {{'a': CASE WHEN i = 1 THEN '' ELSE v[i - 1] END, 'b': v[i]}})) AS p FROM free),
llr AS (SELECT q, sum(ln((coalesce(rc.n, 0) + 0.1) / (coalesce(rt.n, 0) + 6.7)) - ln((coalesce(oc.n, 0) + 0.1) / (coalesce(ot.n, 0) + 6.7))) AS l FROM step
        LEFT JOIN cnt rc ON rc.random AND rc.a = p.a AND rc.b = p.b LEFT JOIN cnt oc ON NOT oc.random AND oc.a = p.a AND oc.b = p.b
        LEFT JOIN tot rt ON rt.random AND rt.a = p.a LEFT JOIN tot ot ON NOT ot.random AND ot.a = p.a GROUP BY q),
spans AS (SELECT r, s, k, e FROM base UNION ALL SELECT r, s, k, e FROM free JOIN llr USING (q) WHERE l > 7.0),
named AS (SELECT *, ['assign', 'access', 'hex', 'markov'][k + 1] || ':' || s || ':' || e AS x FROM spans),
byrow AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
                 string_agg(x, ',' ORDER BY s, k, e) FILTER (k < 3) AS b, string_agg(x, ',' ORDER BY s, k, e) AS every FROM named GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN byrow USING (r)"""

# CRC-32 byte by byte: c is xored with the byte, then eight steps of the
# reversed polynomial 0xEDB88320 (a table of 256 entries built by the same rule).
_STEP = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"

ORACLE["op11_importance_resample"] = rf"""
WITH RECURSIVE crc(v, step, c) AS (SELECT range, 0, range::BIGINT FROM range(256) UNION ALL SELECT v, step + 1, {_STEP} FROM crc WHERE step < 8),
tab AS (SELECT list(c ORDER BY v) AS t FROM crc WHERE step = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY ALL),
v AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM b)),
bytes AS (SELECT w, hex(encode(w)) AS h FROM v),
k AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
             lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) % 10000 AS bucket FROM bytes, tab),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (w) GROUP BY bucket),
g AS (SELECT range AS bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000))::DOUBLE
             / ((coalesce(s.n, 0) + 1) * (coalesce((SELECT sum(n) FROM t), 0) + 10000))::DOUBLE))::BIGINT AS gain
      FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
m AS (SELECT r, sum(n * gain) AS total FROM dw JOIN k USING (w) JOIN g USING (bucket) GROUP BY r),
x AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, CASE WHEN len(w) > 0 THEN floor(total::DOUBLE / len(w))::BIGINT ELSE 0 END AS weight,
             ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d LEFT JOIN m USING (r)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS p, count(*) OVER () AS n FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 10 * n // 100 THEN p END AS rank FROM y LEFT JOIN z USING (r)"""
