"""Ordered context over token positions.

Every operator here works on *blocks* of positions instead of one window
partition per document: a row at position ``p`` lives in block ``p div B``
and is copied into the neighbouring block when it lies within ``reach``
positions of the border (a halo).  A window partitioned by
``(scope keys, block)`` then sees at most ``B + 2*reach`` rows, so one huge
document (or the whole corpus, for corpus-wide context) is spread over many
tasks instead of being sorted in one.  Running sums use the same blocks:
an exclusive sum inside the block plus the exclusive sum of earlier block
totals (a table ``B`` times smaller than the input).

Positions must be dense (0..n-1 per scope); ``tokenize`` and
``corpus_position`` produce such positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BLOCK = 4096

_BLK, _HOME = "_blk", "_home"


def _halo(df: DataFrame, pos: str, reach: int, block: int) -> DataFrame:
    if reach > block:
        raise ValueError(f"reach {reach} exceeds block size {block}")
    p = F.col(pos)
    b = F.floor(p / F.lit(block)).cast("long")
    r = p - b * F.lit(block)
    own = F.struct(b.alias(_BLK), F.lit(True).alias(_HOME))
    if reach == 0:
        return df.select("*", F.inline(F.array(own)))
    up = F.when(r >= block - reach, F.struct((b + 1).alias(_BLK), F.lit(False).alias(_HOME)))
    down = F.when((r < reach) & (b > 0), F.struct((b - 1).alias(_BLK), F.lit(False).alias(_HOME)))
    copies = F.filter(F.array(own, up, down), lambda x: x.isNotNull())
    return df.select("*", F.inline(copies))


def by_block(df: DataFrame, keys, block: int = BLOCK) -> tuple[DataFrame, list]:
    """``df`` dealt out by all keys but the last and the block of the last (a
    position), and the columns to join or group by.  Rows of a block stay side
    by side, which shuffles fewer bytes than dealing out single positions; keys
    whose last is no whole number are dealt out as they are."""
    keys = list(keys)
    if not isinstance(df.schema[keys[-1]].dataType, IntegralType):
        return df.repartition(*keys), keys
    out = df.withColumn(_BLK, F.floor(F.col(keys[-1]) / F.lit(block)).cast("long"))
    return out.repartition(*keys[:-1], _BLK), [*keys, _BLK]


def ordered_context(df: DataFrame, shifts: dict | None = None, running: dict | None = None,
                    scope=("doc_id",), pos: str = "tok_id", block: int = BLOCK, inside: dict | None = None,
                    beyond: DataFrame | None = None, packed: bool = False) -> DataFrame:
    """Add neighbour columns and exclusive running sums in one shuffle.

    shifts:  ``{name: (column, offset, default)}``; offset -k is the k-th
             previous row, +k the k-th next; default fills beyond the scope.
    running: ``{name: expr}`` or ``{name: ('sum'|'max', expr)}``; the sum
             (0 when empty) or max (null when empty) over all earlier rows
             of the scope, excluding the row itself.
    inside:  ``{name: aggregate}`` over the rows of the row's block.
    beyond:  further rows ``(scope, pos, _blk, columns of shifts)`` that are
             neighbours in a block but are not returned.
    packed:  shuffle runs of rows (``packing``): fewer bytes, more CPU time.
    """
    shifts = shifts or {}
    running = running or {}
    scope = list(scope)
    reach = max([abs(o) for _, o, _ in shifts.values()] + [0])
    src = df
    run_cols = {}
    for i, (name, spec) in enumerate(running.items()):
        how, expr = spec if isinstance(spec, tuple) else ("sum", spec)
        c = f"_run{i}"
        src = src.withColumn(c, expr.cast("long"))
        run_cols[name] = (c, how)
    h = _halo(src, pos, reach, block)
    if beyond is not None:
        h = h.unionByName(beyond.withColumn(_HOME, F.lit(False)), allowMissingColumns=True)
    if packed:
        from .packing import dealt_runs
        h = dealt_runs(h, [*scope, _BLK], [_HOME], pos).select(*h.columns)
    w = Window.partitionBy(*scope, _BLK).orderBy(pos)
    exprs = []
    for name, (col, off, default) in shifts.items():
        c = F.col(col) if isinstance(col, str) else col
        if off < 0:
            e = F.lag(c, -off).over(w)
        elif off > 0:
            e = F.lead(c, off).over(w)
        else:
            e = c
        if default is not None:
            # beyond the scope edge the window has no row: use the default
            e = F.coalesce(e, F.lit(default))
        exprs.append(e.alias(name))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exprs += [e.over(whole).alias(name) for name, e in (inside or {}).items()]
    wrun = w.rowsBetween(Window.unboundedPreceding, -1)
    agg = {"sum": F.sum, "max": F.max}
    for name, (c, how) in run_cols.items():
        # halo rows from the previous block sort first; they are masked out
        home_only = F.when(F.col(_HOME), F.col(c))
        exprs.append(agg[how](home_only).over(wrun).alias(f"_in_{name}"))
    out = h.select("*", *exprs).where(F.col(_HOME)).drop(_HOME)
    if run_cols:
        totals = (src.withColumn(_BLK, F.floor(F.col(pos) / F.lit(block)).cast("long"))
                     .groupBy(*scope, _BLK)
                     .agg(*[agg[how](c).alias(f"_t_{name}") for name, (c, how) in run_cols.items()]))
        wb = Window.partitionBy(*scope).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*scope, _BLK, *[
            agg[how](f"_t_{name}").over(wb).alias(f"_off_{name}") for name, (c, how) in run_cols.items()])
        out = out.join(offsets, on=[*scope, _BLK], how="left")
        for name, (c, how) in run_cols.items():
            inner, outer = F.col(f"_in_{name}"), F.col(f"_off_{name}")
            if how == "sum":
                val = F.coalesce(inner, F.lit(0)) + F.coalesce(outer, F.lit(0))
            else:  # running max: null when no earlier row has a value
                val = F.greatest(inner, outer)
            out = out.withColumn(name, val)
        out = out.drop(*[f"_in_{n}" for n in run_cols], *[f"_off_{n}" for n in run_cols])
    return out.drop(_BLK, *[c for c, _ in run_cols.values()])


# --------------------------------------------------------------------------
# Previous / next lemma, previous gold label
# --------------------------------------------------------------------------

def prev_next_lemma(df: DataFrame, lemma: str = "lemma", scope=("doc_id",), pos: str = "tok_id") -> DataFrame:
    """W1 + W2: ``prev`` / ``next`` lemma, '' at the scope edges."""
    return ordered_context(df, {"prev": (lemma, -1, ""), "next": (lemma, 1, "")}, scope=scope, pos=pos)


def prev_label(df: DataFrame, label: str = "label", name: str = "prev_tok_cue",
               scope=("doc_id",), pos: str = "tok_id") -> DataFrame:
    """The previous row's gold label, '0' for the first row."""
    return ordered_context(df, {name: (label, -1, "0")}, scope=scope, pos=pos)


# --------------------------------------------------------------------------
# Multi-word cue match
# --------------------------------------------------------------------------

def _neighbour_tokens(df, token, scope, pos, reach=3, packed=False):
    shifts = {}
    for k in range(1, reach + 1):
        shifts[f"_p{k}"] = (token, -k, "")
        shifts[f"_f{k}"] = (token, k, "")
    return ordered_context(df, shifts, scope=scope, pos=pos, packed=packed)


def _join(*parts):
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(" "))
        out.append(p if not isinstance(p, str) else F.col(p))
    return F.concat(*out)


def span_forms(t, p, f):
    """The nine text-order windows of 2-4 tokens that contain the token."""
    return [
        _join(t, f[1]), _join(p[1], t),
        _join(t, f[1], f[2]), _join(p[1], t, f[1]), _join(p[2], p[1], t),
        _join(t, f[1], f[2], f[3]), _join(p[1], t, f[1], f[2]),
        _join(p[2], p[1], t, f[1]), _join(p[3], p[2], p[1], t),
    ]


def literal_forms(t, p, f):
    """The nine forms as the original feature builds them: the list called
    'previous' holds following tokens and vice versa, so tri- and four-grams
    come out reversed and one form repeats an item and lacks a space."""
    return [
        _join(t, f[1]), _join(p[1], t),
        _join(f[1], t, p[1]), _join(f[2], f[1], t), _join(t, p[1], p[2]),
        _join(f[3], f[2], f[1], t),
        F.concat(f[2], F.lit(" "), f[2], F.lit(" "), t, p[1]),
        _join(f[1], t, p[1], p[2]), _join(t, p[1], p[2], p[3]),
    ]


def form_flag(forms, cues, t=None):
    """1 where one of ``forms`` is a cue.  ``t``: the token that stands in
    every form between spaces or at its ends (``span_forms``); forms are then
    built only for tokens that are a run of some cue's words."""
    cues = list(cues)
    hit = forms[0].isin(cues)
    for e in forms[1:]:
        hit = hit | e.isin(cues)
    if t is not None:
        words = [c.split(" ") for c in cues]
        hit = t.isin(sorted({" ".join(w[i:j]) for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)})) & hit
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def cue_flag(cues, mode: str = "span", token: str = "token"):
    """W5 / W4 as an expression over the neighbour columns ``_p1``..``_f3``
    of ``tokenize_with_context`` or ``corpus_context``."""
    p = {k: F.col(f"_p{k}") for k in (1, 2, 3)}
    f = {k: F.col(f"_f{k}") for k in (1, 2, 3)}
    t = F.col(token)
    return form_flag(span_forms(t, p, f), cues, t) if mode == "span" else form_flag(literal_forms(t, p, f), cues)


def match_multi(df: DataFrame, cues, mode: str = "span", token: str = "token", name: str = "match_multi",
                scope=("doc_id",), pos: str = "tok_id", packed: bool = False) -> DataFrame:
    """W5 (``mode='span'``) / W4 (``mode='literal'``): 1 when any 2-4 token
    window around the row equals a multi-word cue.  Missing neighbours are
    ''; each test is an ``InSet`` over literals.  ``cues`` may be a dict
    ``{output column: cue list}`` to test several lists in the same pass."""
    lists = cues if isinstance(cues, dict) else {name: cues}
    ctx = _neighbour_tokens(df, token, scope, pos, packed=packed)
    t = F.col(token)
    p = {k: F.col(f"_p{k}") for k in (1, 2, 3)}
    f = {k: F.col(f"_f{k}") for k in (1, 2, 3)}
    forms = span_forms(t, p, f) if mode == "span" else literal_forms(t, p, f)
    out = ctx
    for col_name, cue_list in lists.items():
        out = out.withColumn(col_name, form_flag(forms, cue_list, t if mode == "span" else None))
    return out.drop(*[f"_p{k}" for k in (1, 2, 3)], *[f"_f{k}" for k in (1, 2, 3)])


# --------------------------------------------------------------------------
# Sentence index
# --------------------------------------------------------------------------

def sentence_seq(df: DataFrame, token: str = "token", end_token: str = ".", name: str = "sent_seq",
                 scope=("doc_id",), pos: str = "tok_id", packed: bool = False) -> DataFrame:
    """Sentence number inside the scope; a sentence ends after each
    ``end_token`` (the number of end tokens strictly before the row)."""
    out = ordered_context(df, running={name: (F.col(token) == F.lit(end_token)).cast("int")},
                          scope=scope, pos=pos, packed=packed)
    return out.withColumn(name, F.col(name).cast("int"))


# --------------------------------------------------------------------------
# Lower-cased surface context with optional wrap-around
# --------------------------------------------------------------------------

def context_tokens(df: DataFrame, token: str = "token", wrap: bool = False, scope=("doc_id",),
                   pos: str = "tok_id", packed: bool = False) -> DataFrame:
    """``prev_token`` / ``next_token`` (lower-cased surface tokens).

    ``wrap=True`` reproduces list indexing: the first row's previous token is
    the scope's last token, and the last row's next token is the token at
    position 1 (not 0).  A scope of one block has its edges in that block; the
    edges of longer scopes, two rows for each, are put into their first and
    last block, so tokens are shuffled once and joined with nothing.
    """
    src = df.withColumn("_low", F.lower(F.col(token)))
    shifts = {"prev_token": ("_low", -1, None), "next_token": ("_low", 1, None)}
    if not wrap:
        out = ordered_context(src, shifts, scope=scope, pos=pos, packed=packed)
        return out.withColumn("prev_token", F.coalesce("prev_token", F.lit(""))) \
                  .withColumn("next_token", F.coalesce("next_token", F.lit(""))).drop("_low")
    p, low = F.col(pos), F.col("_low")
    # a one-row scope wraps onto itself; position 1 does not exist there and
    # list indexing would fail, so fall back to the first token
    second, first = F.max(F.when(p == 1, low)), F.max(F.when(p == 0, low))
    known = F.lit(True)
    for c in scope:
        known = known & F.col(c).isNotNull()
    ends = src.where(known & (p >= BLOCK)).groupBy(*scope).agg(F.max_by(low, p).alias("_last"), F.max(p).alias("_max")).where("_max IS NOT NULL")
    starts = src.where(known & (p <= 1)).groupBy(*scope).agg(F.coalesce(second, first).alias("_again"))
    both = ends.join(starts, list(scope), "left") if scope else ends.crossJoin(starts)
    kind, last_block = df.schema[pos].dataType, F.floor(F.col("_max") / F.lit(BLOCK)).cast("long")
    rows = F.array(F.struct(F.lit(-1).cast(kind).alias(pos), F.lit(0).cast("long").alias(_BLK), F.col("_last").alias("_low")),
                   F.struct((F.col("_max") + 1).cast(kind).alias(pos), last_block.alias(_BLK), F.col("_again").alias("_low")))
    out = ordered_context(src, shifts, scope=scope, pos=pos, inside={"_last": F.last("_low"), "_second": second, "_first": first},
                          beyond=both.select(*scope, F.inline(rows)), packed=packed)
    return (out.withColumn("prev_token", F.coalesce("prev_token", F.when(known, F.col("_last"))))
               .withColumn("next_token", F.coalesce("next_token", F.when(known, F.coalesce("_second", "_first"))))
               .drop("_low", "_last", "_second", "_first"))


# --------------------------------------------------------------------------
# Global corpus position
# --------------------------------------------------------------------------

def running_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows before each row in ``order``, as column
    ``name``, in two levels and without arithmetic on the order column.

    The range-partitioned sort is written once; its files are numbered in
    order, so the sum inside a file is a window over that file's rows and the
    sum before a file comes from one row per file.
    """
    from ..session import materialize
    s = materialize(df.orderBy(order), "sorted")
    file = F.struct(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("task"),
                    F.regexp_extract(F.col("_metadata.file_name"), r"-c(\d+)\.", 1).cast("int").alias("file"))
    s = s.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = s.groupBy("_file").agg(F.sum(value).alias("_t"))
    files = files.select("_file", F.coalesce(F.sum("_t").over(across), F.lit(0)).alias("_off"))
    s = s.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(files, "_file")
    return s.withColumn(name, F.col("_in") + F.col("_off")).drop("_file", "_row", "_in", "_off")


def document_offsets(doc_sizes: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``(doc, _doff)``: tokens of all documents before each in ``doc`` order."""
    d = doc_sizes.select(doc, F.col("n_tokens").cast("long").alias("_n"))
    return running_before(d, doc, "_n", "_doff").select(doc, "_doff")


def corpus_position(tokens: DataFrame, doc_sizes: DataFrame | None = None, doc: str = "doc_id",
                    pos: str = "tok_id", name: str = "corpus_pos") -> DataFrame:
    """Dense position over all documents in ``doc`` order (ids of any
    type that sorts).

    ``doc_sizes`` may be given (e.g. computed from text lengths without
    exploding); otherwise it is counted from ``tokens``.
    """
    if doc_sizes is None:
        doc_sizes = tokens.groupBy(doc).agg(F.count(F.lit(1)).alias("n_tokens"))
    return (tokens.join(document_offsets(doc_sizes, doc), doc, "left")
                  .withColumn(name, (F.col("_doff") + F.col(pos)).cast("long")).drop("_doff"))


# --------------------------------------------------------------------------
# Document-level context: no shuffle when tokens come from one text row
# --------------------------------------------------------------------------

def tokenize_with_context(df: DataFrame, text_col: str = "text", keep=("doc_id", "lang"), reach: int = 3,
                          end_token: str | None = ".", pattern: str | None = None, lowercase: bool = True,
                          extra: dict | None = None, using=(), starts: bool = True) -> DataFrame:
    """S7 + W1/W2/W5/W6 in one pass: token rows with the ``reach`` previous
    (``_p1``..) and next (``_f1``..) tokens ('' beyond the document) and,
    with ``end_token``, ``sent_seq`` and (``starts``) ``sent_start``.  ``extra``: further
    columns ``{name: f(token array) -> array}`` that may read the columns
    ``using`` of the document.

    Everything is computed on the token array of each document row with
    array functions (shifted slices for neighbours; per-sentence
    ``array_repeat`` from the end-token positions for sentence numbers, O(n))
    in the task that tokenises it, so no exchange, sort or window is needed.
    """
    from ..functions.cues import TOKEN_PATTERN
    pattern = pattern or TOKEN_PATTERN
    text = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    # the one-row inline is a Generate node: projections are not collapsed
    # through it, so the token array is computed once per document instead
    # of being inlined (and re-evaluated) into every array expression below
    toks = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("_t"))
    held = list(dict.fromkeys([*keep, *using]))
    x = df.select(*held, F.inline(F.array(toks)))
    t = F.col("_t")
    n = F.size(t)
    arrays = {"token": t, **{name: f(t) for name, f in (extra or {}).items()}}
    pad = F.array_repeat(F.lit(""), reach)
    held += ["_t", "_full"]
    x = x.select("*", F.inline(F.array(F.struct(F.concat(pad, t, pad).alias("_full")))))
    for k in range(1, reach + 1):  # neighbours are slices of the padded array
        arrays[f"_p{k}"] = F.slice("_full", reach - k + 1, n)
        arrays[f"_f{k}"] = F.slice("_full", reach + k + 1, n)
    if end_token is not None:
        idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        ends_expr = F.filter(idx, lambda i: F.get(t, i) == F.lit(end_token))
        # end positions are read inside a per-sentence lambda: compute them
        # once per document (behind another Generate) so the lambda does
        # not re-run the O(n) filter for every sentence
        x = x.select(*held, F.inline(F.array(F.struct(ends_expr.alias("_ends")))))
        ends = F.col("_ends")
        d = F.size(ends)

        def length(s):
            stop = F.when(s < d, F.get(ends, s)).otherwise(n - 1)
            return stop - F.coalesce(F.get(ends, s - 1), F.lit(-1))

        def start(s):
            return F.coalesce(F.get(ends, s - 1), F.lit(-1)) + 1

        sents = F.sequence(F.lit(0), d)
        arrays["sent_seq"] = F.flatten(F.transform(sents, lambda s: F.array_repeat(s, length(s))))
        if starts:
            arrays["sent_start"] = F.flatten(F.transform(sents, lambda s: F.array_repeat(start(s), length(s))))
    zipped = F.arrays_zip(*[v.alias(k) for k, v in arrays.items()])
    out = x.select(*keep, F.posexplode(zipped).alias("tok_id", "_z"))
    return out.select(*keep, F.col("tok_id").cast("int").alias("tok_id"),
                      *[F.col(f"_z.{k}").alias(k) for k in arrays])


def _token_arrays(df: DataFrame, text_col: str, keep, pattern: str | None, lowercase: bool) -> DataFrame:
    """``keep`` and the token array ``_t`` of each row, computed once (behind
    a Generate, which projections are not collapsed through)."""
    from ..functions.cues import TOKEN_PATTERN
    text = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    toks = F.regexp_extract_all(text, F.lit(pattern or TOKEN_PATTERN), F.lit(0))
    return df.select(*keep, F.inline(F.array(F.struct(toks.alias("_t")))))


# --------------------------------------------------------------------------
# W5 for cues of any length
# --------------------------------------------------------------------------

def match_cues(df: DataFrame, cues, text_col: str = "text", keep=("doc_id",), name: str = "match_cues",
               pattern: str | None = None, lowercase: bool = True) -> DataFrame:
    """W5 for cues of any number of tokens (tokens joined by one space), any
    number of them: token rows with ``name`` = 1 where the token lies inside
    an occurrence of a cue, and ``cue_length``, the tokens of the longest cue
    that starts there (0: none).

    On the document's token array, without a shuffle: a position whose token
    starts some cue is looked up once per cue length, longest first, in a
    hashed literal set; a token is inside if one of the ``longest cue`` last
    positions reaches over it.  Cues without a token are ignored; a null or
    empty text has no rows.
    """
    by_length: dict[int, set[str]] = {}
    for cue in cues:
        if words := cue.split():
            by_length.setdefault(len(words), set()).add(" ".join(words))
    x = _token_arrays(df, text_col, keep, pattern, lowercase)
    t, n, longest = F.col("_t"), F.size("_t"), max(by_length, default=1)
    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    firsts = sorted({c.split(" ", 1)[0] for c in set().union(*by_length.values())}) if by_length else []

    def starting(i):
        length = F.when(~F.get(t, i).isin(firsts), F.lit(0))
        for size in sorted(by_length, reverse=True):
            said = F.array_join(F.slice(t, i + 1, size), " ")
            length = length.when(said.isin(sorted(by_length[size])), F.lit(size))
        return length.otherwise(F.lit(0))

    x = x.select(*keep, "_t", F.inline(F.array(F.struct(F.transform(index, starting).alias("_m")))))
    m = F.col("_m")

    def inside(i):
        near = F.sequence(F.greatest(i - (longest - 1), F.lit(0)), i)
        return F.exists(near, lambda j: F.get(m, j) > i - j).cast("int")

    zipped = F.arrays_zip(t.alias("token"), F.transform(index, inside).alias("_in"), m.alias("_len"))
    return x.select(*keep, F.posexplode(zipped).alias("tok_id", "_z")).select(
        *keep, F.col("tok_id").cast("int").alias("tok_id"), F.col("_z.token").alias("token"),
        F.col("_z._in").alias(name), F.col("_z._len").alias("cue_length"))


# --------------------------------------------------------------------------
# Neighbours at corpus scope
# --------------------------------------------------------------------------

def corpus_edges(df: DataFrame, reach: int, wrap: bool = False, after: int | None = None, text_col: str = "text",
                 doc: str = "doc_id", pattern: str | None = None, lowercase: bool = True) -> DataFrame:
    """Per document with tokens: ``_doff`` (tokens before it in the corpus)
    and the ``reach`` tokens before and after it, ``_before`` and ``_after``.

    Only the first and last tokens of each document, placed by their corpus
    position, take part in the join, so documents shorter than ``reach`` look
    past their neighbours.  See ``corpus_context`` for the corpus ends.
    """
    from ..session import materialize
    width, n = reach + (after or 0), F.size("_t")
    sizes = _token_arrays(df, text_col, (doc,), pattern, lowercase).where(n > 0).select(
        doc, n.cast("long").alias("_n"), F.slice("_t", 1, width).alias("_head"),
        F.slice("_t", F.greatest(n - width, F.lit(0)) + 1, width).alias("_tail"))
    ends = materialize(running_before(sizes, doc, "_n", "_doff"), "corpus-edges")
    total = ends.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    tail = F.col("_doff") + F.col("_n") - F.size("_tail")
    edge = (ends.select(F.col("_doff").alias("_at"), F.posexplode("_head").alias("_i", "_tok"))
                .unionByName(ends.select(tail.alias("_at"), F.posexplode("_tail").alias("_i", "_tok")))
                .select((F.col("_at") + F.col("_i")).alias("_p"), "_tok").distinct())
    wanted = []
    for k in range(1, reach + 1):
        p = F.col("_doff") - k
        back = F.when(p >= 0, p)
        wanted.append((-k, back.when(p >= -total, p + total) if wrap else back))
        p = F.col("_doff") + F.col("_n") + (k - 1)
        on = F.when(p < total, p)
        if after is not None:
            again = p - total + min(after, max(total - 1, 0))
            on = on.when(again < total, again)
        wanted.append((k, on))
    slots = F.array(*[F.struct(F.lit(k).alias("_k"), p.cast("long").alias("_p")) for k, p in wanted])
    found = (ends.select(doc, F.inline(slots)).where(F.col("_p").isNotNull()).join(edge, "_p")
                 .groupBy(doc).agg(*[F.max(F.when(F.col("_k") == k, F.col("_tok"))).alias(f"_s{k}") for k, _ in wanted]))

    def side(ks):
        return F.array(*[F.coalesce(F.col(f"`_s{k}`"), F.lit("")) for k in ks])

    return ends.select(doc, "_doff").join(found, doc, "left").select(
        doc, "_doff", side(range(-reach, 0)).alias("_before"), side(range(1, reach + 1)).alias("_after"))


def corpus_context(df: DataFrame, reach: int = 3, wrap: bool = False, after: int | None = None, text_col: str = "text",
                   keep=("doc_id",), doc: str = "doc_id", pattern: str | None = None, lowercase: bool = True) -> DataFrame:
    """W1-W5, W7 at corpus scope: token rows with ``corpus_pos`` and the
    ``reach`` previous (``_p1``..) and next (``_f1``..) tokens, document
    borders ignored, documents in the order of ``doc`` (unique, not null).

    Past the corpus' ends the tokens are ``''``; ``wrap``: the tokens before
    the first are the last ones; ``after``: the token after the last is the
    one at that position (the first, if there is none).  No token is
    shuffled on its own: the documents meet the edge table of
    ``corpus_edges`` and their neighbours are slices of one array.
    """
    edges = corpus_edges(df, reach, wrap, after, text_col, doc, pattern, lowercase)
    read = list(dict.fromkeys([*keep, doc, text_col]))
    x = _token_arrays(df.select(*read).join(edges, doc), text_col, [*keep, "_doff", "_before", "_after"], pattern, lowercase)
    full = F.concat("_before", "_t", "_after")
    x = x.select(*keep, "_doff", F.size("_t").alias("_n"), F.inline(F.array(F.struct(full.alias("_full")))))
    arrays = {"token": F.slice("_full", reach + 1, F.col("_n"))}
    for k in range(1, reach + 1):
        arrays[f"_p{k}"] = F.slice("_full", reach - k + 1, F.col("_n"))
        arrays[f"_f{k}"] = F.slice("_full", reach + k + 1, F.col("_n"))
    zipped = F.arrays_zip(*[v.alias(k) for k, v in arrays.items()])
    out = x.select(*keep, "_doff", F.posexplode(zipped).alias("tok_id", "_z"))
    return out.select(*keep, F.col("tok_id").cast("int").alias("tok_id"), (F.col("_doff") + F.col("tok_id")).alias("corpus_pos"),
                      *[F.col(f"_z.{k}").alias(k) for k in arrays])
