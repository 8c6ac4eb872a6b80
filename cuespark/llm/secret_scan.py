"""Secret scans (6): fixed patterns, and two character Markov models.

Patterns find assignments, access keys and long hexadecimal runs.  What they
find are labelled samples of random strings; the other identifier-like runs of
the texts are samples of ordinary ones.  A first-order character model is
trained on the distinct values of each label, over the whole table, and any
further run whose log-likelihood ratio (random over ordinary) exceeds
``MIN_LLR`` becomes a span of kind ``markov``.  Pattern spans always stay; runs
are looked for in what they leave (assignments blanked first, then access keys,
then hexadecimal runs), so a random string joined to a pattern's is scored too.

DataFrame functions only.  Texts are never shuffled; samples are distinct
values, pre-aggregated, and what reaches the driver are the counts of
character pairs, bounded by twice the square of the alphabet.

Positions are code points, ends exclusive; matches are leftmost and do not
overlap within a kind.  Defined results: null is the empty text; empty texts
have no span; repeated rows give repeated results; empty tables give an
untrained model (which adds nothing) or no rows; the row is carried as one
struct, so other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lines import hold

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The longest runs of at least so many characters are the leftmost matches of
# ``AKIA[A-Z0-9]+`` and ``[0-9a-f]+`` that are long enough.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6          # characters of an assigned value

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{8,}"
SMOOTHING = 0.1        # added to every count of a pair of characters
MIN_LLR = 7.0          # about 1000 to 1


def _find(df: DataFrame, keep, text: str, patterns: dict[str, tuple[str, int, int]]) -> DataFrame:
    """For each name: array of ``start, no, end, value`` of the matches of
    (pattern, value's group, kind number).  A start is the length of all
    pieces between matches and of all matches before it."""
    t, arrays = F.col(text), {}
    for name, (pattern, group, _) in patterns.items():
        has = t.rlike(pattern)
        arrays |= {f"{name}_m": F.when(has, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))),
                   f"{name}_v": F.when(has, F.regexp_extract_all(t, F.lit(pattern), F.lit(group))), f"{name}_g": F.when(has, F.split(t, pattern))}
    df = hold(df, keep, **arrays)
    names = list(patterns)
    values = [f"{n}_v" for n in names]
    df = hold(df, [*keep, *values], **{f"{n}_{c}": F.transform(f"{n}_{c}", F.length) for n in names for c in "mg"})

    def starts(n):
        steps = F.sequence(F.lit(0), F.size(f"{n}_m") - 1)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))

        def step(a, i):
            at = a["at"] + F.get(f"{n}_g", i)
            return F.struct((at + F.get(f"{n}_m", i)).alias("at"), F.array_append(a["all"], at).alias("all"))

        return F.aggregate(steps, zero, step, lambda a: a["all"])

    df = hold(df, [*keep, *values, *(f"{n}_m" for n in names)], **{f"{n}_s": starts(n) for n in names})
    empty = F.array().cast("array<struct<start:int,no:int,end:int,value:string>>")

    def spans(n, no):
        return F.coalesce(F.transform(f"{n}_s", lambda s, i: F.struct(
            s.alias("start"), F.lit(no).alias("no"), (s + F.get(f"{n}_m", i)).alias("end"), F.get(f"{n}_v", i).alias("value"))), empty)

    return df.select(*keep, *[spans(n, no).alias(n) for n, (_, _, no) in patterns.items()])


_BASE = {"_assign": (ASSIGN, 2, 0), "_access": (ACCESS, 0, 1), "_hex": (HEX, 0, 2)}


def _base_only(df: DataFrame, keep) -> DataFrame:
    long = F.filter("_assign", lambda x: F.length(x["value"]) >= MIN_VALUE)
    return df.select(*keep, F.concat(long, "_access", "_hex").alias("_base"))


def _blanked(t: Column, pattern: str, group: int, least: int) -> Column:
    """``t`` with blanks for every match whose group has ``least`` characters."""
    whole, value = (F.regexp_extract_all(t, F.lit(pattern), F.lit(g)) for g in (0, group))
    blanks = F.zip_with(whole, value, lambda m, v: F.when(F.length(v) >= least, F.repeat(F.lit(" "), F.length(m))).otherwise(m))
    return F.array_join(F.zip_with(F.split(t, pattern), blanks, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``random`` (true or false) and ``value``: what the patterns
    find, and the identifier-like runs of the rest of the texts."""
    t = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_t"))
    found = _base_only(_find(t, [], "_t", _BASE), []).select(F.explode("_base").alias("b")).select(F.lit(True).alias("random"), F.col("b")["value"].alias("value"))
    rest = F.col("_t")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.when(F.col("_t").rlike(pattern), F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    runs = t.select(F.lit(False).alias("random"), F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("value"))
    return found.union(runs).distinct()


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs, from rows of ``random`` and
    ``value``: entry ``before * n + character`` with characters numbered from
    1, and 0 for the start of a value.  Counts are smoothed by ``SMOOTHING``."""
    chars = samples.where("value is not null").select("random", F.filter(F.regexp_extract_all("value", F.lit("(?s)."), F.lit(0)), lambda c: F.lit(ALPHABET).contains(c)).alias("c"))
    pairs = chars.select("random", F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), "c").alias("a"), F.col("c").alias("b"))).alias("p"))
    counts = pairs.where("p.b is not null").groupBy("random", "p.a", "p.b").count().collect()  # a row per label and pair of characters
    n, place = len(ALPHABET), {c: i + 1 for i, c in enumerate(ALPHABET)} | {"": 0}
    seen = {r: [[SMOOTHING] * n for _ in range(n + 1)] for r in (True, False)}
    for r in counts:
        seen[r.random][place[r.a]][place[r.b] - 1] += r["count"]
    ratios = []
    for random, ordinary in zip(seen[True], seen[False]):
        sums = sum(random), sum(ordinary)
        ratios += [math.log(x / sums[0]) - math.log(y / sums[1]) for x, y in zip(random, ordinary)]
    return ratios


def log_ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string over ``ALPHABET``."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    at = F.transform(F.regexp_extract_all(value, F.lit("."), F.lit(0)), lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("before"))

    def step(a, c):
        return F.struct((a["sum"] + F.element_at(table, a["before"] * len(ALPHABET) + c)).alias("sum"), c.alias("before"))

    return F.aggregate(at, start, step, lambda a: a["sum"])


def scan(docs: DataFrame, model: list[float], text: str = "text", keep=None, min_llr: float = MIN_LLR) -> DataFrame:
    """Struct ``row`` of the ``keep`` columns (all) of every row, and its
    ``spans``, sorted: ``start, no`` (place of the kind in ``KINDS``), ``end,
    value``."""
    df = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    df = _find(df, ["row", "_t"], "_t", _BASE)
    for name, (pattern, group, _) in _BASE.items():  # few texts have matches
        least = MIN_VALUE if name == "_assign" else 1
        df = hold(df, ["row", *_BASE], _t=F.when(F.size(name) > 0, _blanked(F.col("_t"), pattern, group, least)).otherwise(F.col("_t")))
    df = hold(_base_only(df, ["row", "_t"]), ["row", "_t"], _base=F.col("_base"))
    df = _find(df, ["row", "_base"], "_t", {"_more": (CANDIDATE, 0, 3)})
    found = F.filter("_more", lambda m: log_ratio(m["value"], model) > min_llr)
    return df.select("row", F.array_sort(F.concat("_base", found)).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the table and scan it: counts, digest and list of spans."""
    rows = hold(scan(docs, train(labelled_samples(docs, text)), text, keep=[doc_id]), ["row"], spans=F.col("spans"))
    count = lambda no: F.size(F.filter("spans", lambda s: s["no"] == no)).cast("long")
    base = _listed(F.filter("spans", lambda s: s["no"] < 3))
    return rows.select(F.col("row")[doc_id].alias(doc_id), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(base, 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: list[float], text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span's text replaced by ``mark``; other
    columns unchanged, null stays null."""
    rows = scan(docs, model, text)
    said = F.col("row")[text]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, s):
        gap = F.substring(said, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        put = F.when(s["start"] >= a["at"], F.concat(a["out"], gap, F.lit(mark))).otherwise(a["out"])
        return F.struct(put.alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    cut = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(said, a["at"] + 1, F.length(said))))
    new = F.when(F.size("spans") > 0, cut).otherwise(said)
    return rows.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
