"""Quality rules by cross-document line frequency (5).

Normalised lines (stripped of white space at both ends, lower-cased) are
hashed together with their host; a host's line is frequent if it stands in
more than ``min_docs`` distinct documents of the host, and, where a caller asks
for it, in more than ``share`` of them.  By default the limit is the same in a
host of any size.  Frequent lines are removed, and a document with too small a
share of its words left is rejected.  Documents are distinct by text, so exact
copies count once.

DataFrame functions only.  Lines travel as 64-bit hashes; the two counts are
pre-aggregated before each shuffle, so a line or a host with a third of all
rows is one row per task.  The frequent lines, and the line numbers of the
documents that have some, are broadcast if their counts show them to be few,
else joined by shuffle with the hot keys salted.  Lines are cut out as slices
between removed ones, in time linear in the text.

Defined results: a null or empty text has no words and fails the base rule;
a null host is a host of its own; a null id is an ordinary id; repeated rows
give repeated results; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .lines import HAS_WORD, hold, space_words, strip_space, text_lines

MIN_WORDS = 20        # base rule
MAX_REPEAT = 30       # base rule: percent of words in repeated windows
WINDOW = 8
MIN_DOCS = 10         # a line in no more documents of its host is kept
SHARE = 0.0           # nor one in no more than this share of its documents
MIN_LEFT = 0.3        # least share of words that must be left
BROADCAST_ROWS = 200_000  # frequent lines, or texts with some and their removed lines, that are broadcast at most
SALTS = 16


def repeat_words(df: DataFrame, keep, words: str, window: int = WINDOW, out: str = "n_repeat_words") -> DataFrame:
    """Adds ``out``: the words that lie in ``window``-word windows found
    twice or more in the row's ``words``."""
    n = F.size(words)
    at = F.sequence(F.lit(0), n - window)
    hashes = F.when(n > window, F.transform(at, lambda i: F.xxhash64(F.slice(F.col(words), i + 1, window))))
    df = hold(df, [*keep, words], _w=hashes)
    ranked = F.array_sort(F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = hold(df, [*keep, words], _r=F.when(F.size(F.array_distinct("_w")) < F.size("_w"), ranked))

    def repeated(x, k):  # the same hash before or after it in the sorted array
        beside = [F.get("_r", k - 1)["h"], F.get("_r", k + 1)["h"]]
        return x["h"].eqNullSafe(beside[0]) | x["h"].eqNullSafe(beside[1])

    found = F.array_sort(F.transform(F.filter("_r", repeated), lambda x: x["i"]))
    df = hold(df, [*keep, words], _p=found)
    covered = F.aggregate(
        "_p", F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return df.select(*keep, words, F.coalesce(covered, F.lit(0)).cast("long").alias(out))


def base_metrics(df: DataFrame, keep, text: str) -> DataFrame:
    """Adds the counts of the base rule and ``base_failed``; ``text`` may be
    the name of a nested field."""
    t = F.coalesce(F.col(text), F.lit(""))
    said = F.filter(text_lines(t), lambda line: line.rlike(HAS_WORD))
    df = hold(df, keep, _words=space_words(t), _lines=said, n_symbols=F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    df = df.select(*keep, "_words", F.size("_words").cast("long").alias("n_words"),
                   F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols",
                   (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    df = repeat_words(df, [*keep, *counts], "_words").drop("_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _same(host: Column, text: Column) -> Column:
    """128-bit key of a host's text: rows that share it share their result."""
    return F.struct(F.xxhash64(host, text).alias("a"), F.xxhash64(F.lit(1), host, text).alias("b"))


def _lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """One row per line with a word: key ``_doc`` of its host's text, host,
    line number ``_at``, host and line hash ``_key``, number of words ``_n``."""
    rows = docs.select(F.col(host).alias("_host"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = hold(rows, ["_host"], _doc=_same(F.col("_host"), F.col("_text")), _lines=text_lines(F.col("_text")))  # hashed once, not per line
    rows = rows.select("_host", "_doc", F.posexplode("_lines").alias("_at", "_line"))
    key = F.xxhash64(F.col("_host"), F.lower(strip_space(F.col("_line"))))
    return rows.where(F.col("_line").rlike(HAS_WORD)).select("_doc", "_host", "_at", key.alias("_key"),
                                                             F.size(space_words(F.col("_line"))).alias("_n"))


def _few(df: DataFrame, entries: Column | None = None) -> bool:
    """Whether rows and their ``entries`` are at most ``BROADCAST_ROWS``."""
    most = df.agg(F.count(F.lit(1)) + F.coalesce(F.sum(entries), F.lit(0)) if entries is not None else F.count(F.lit(1)))
    return most.first()[0] <= BROADCAST_ROWS


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = MIN_DOCS,
                   share: float = SHARE) -> DataFrame:
    """``_key``: host and line hash of every line above both limits."""
    seen = _lines(docs, text, host).select("_host", "_key", "_doc").distinct()
    counts = seen.groupBy("_key").agg(F.count(F.lit(1)).alias("_docs"), F.first("_host").alias("_host")).where(F.col("_docs") > min_docs)
    if not share:
        return counts.select("_key")
    whole = docs.select(F.col(host).alias("_h"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_t")).distinct()
    limits = whole.groupBy("_h").agg((F.count(F.lit(1)) * share).alias("_most"))
    return counts.join(limits, F.col("_host").eqNullSafe(F.col("_h"))).where(F.col("_docs") > F.col("_most")).select("_key")


def removed_lines(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """``_doc`` of every text that has frequent lines, and the set ``_out`` of
    their line numbers and word counts; written to the shared folder."""
    frequent = materialize(frequent_lines(docs, text, host, **limits), "frequent-lines")
    lines = _lines(docs, text, host).select("_doc", "_at", "_n", "_key")
    if _few(frequent):
        found = lines.join(F.broadcast(frequent), "_key", "left_semi")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = lines.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        found = salted.join(frequent.withColumn("_salt", salts), ["_key", "_salt"], "left_semi")
    return materialize(found.groupBy("_doc").agg(F.collect_set(F.struct("_at", "_n")).alias("_out")), "removed-lines")


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep=None, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """Struct ``row`` of the ``keep`` columns (all) of every row, the counts,
    ``removed`` (line numbers taken out, sorted), ``n_left`` words and ``kept``."""
    out = removed_lines(docs, text, host, **limits)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), _same(F.col(host), t).alias("_doc"), t.alias("_text"))
    rows = base_metrics(rows, ["row", "_doc"], "_text")
    rows = rows.join(F.broadcast(out) if _few(out, F.size("_out")) else out, "_doc", "left")
    gone = F.aggregate(F.coalesce("_out", F.array().cast(out.schema["_out"].dataType)), F.lit(0), lambda a, x: a + x["_n"])
    rows = rows.withColumn("n_left", F.col("n_words") - gone).withColumn("removed", F.array_sort(F.transform("_out", lambda x: x["_at"]))).drop("_out", "_doc")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= F.col("n_words") * min_left))


def report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row: id, counts, base rule, words left, verdict."""
    return judge(docs, keep=[doc_id], **options).select(F.col("row")[doc_id].alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                        "n_repeat_words", "base_failed", "n_left", "kept")


def clean_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The kept documents, their frequent lines taken out of the text; other
    columns and unaffected texts unchanged."""
    rows = judge(docs, text=text, **options).where("kept")
    said = F.col("row")[text]
    rows = hold(rows, ["row"], _said=F.when(F.col("removed").isNotNull(), text_lines(said)), _out=F.col("removed"))

    def between(i):  # the lines after removed line i - 1 and before removed line i
        after = F.coalesce(F.get("_out", i - 1) + 1, F.lit(0))
        return F.slice("_said", after + 1, F.coalesce(F.get("_out", i), F.size("_said")) - after)

    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_out")), between))
    cut = F.when(F.col("_out").isNull(), said).otherwise(F.array_join(left, "\n"))
    return rows.select(*[cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
