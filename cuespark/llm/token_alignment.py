"""Cross-tokenizer alignment (12).

Every text is encoded by a byte-level BPE (A) and by a SentencePiece model
(B); the byte offsets at which tokens of both end cut the text into groups of
A tokens and B tokens that cover the same bytes.  All A-B pairs of a group
are linked, and a pair of ids counts the documents that hold it linked.

Groups are found by diagonal run skipping (``align``): while tokens match one
to one, the two arrays of token ends are equal at a fixed index shift, so they
are compared there in stretches of doubling length up to the first mismatch.
There the group is resolved by stepping on whichever side ends earlier, which
gives the new shift.  Many stretches of the texts are followed side by side.

Both tokenizers give the ids of a whole text when its pieces are encoded one
by one, if it is cut where neither can merge across (``cuts``), so a worker
encodes each distinct piece once; pieces are told apart by 128 bits of hash,
and where 64 of them clash the block is encoded without the memory.

Steps: one pass over the documents writes each one's digest and its distinct
id pairs with their number of links; pairs are counted by an aggregation; the
counts, with a mark on those that are the highest of their A id, are looked
up in blocks of at most ``PAIRS`` pairs, each broadcast on its own in one pass
over the written pairs, so that an executor never holds more than a block.
Nothing else is broadcast; no text is shuffled.

Defined results: a null or empty text, and one whose tokens do not spell
space + text (a text with U+2581), has no tokens: zeros and an empty digest.
Texts of special tokens are plain text.  Repeated rows are aligned and
counted once each.  An empty table gives no rows.  Only the id and text
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textblocks import span_hashes, text_blocks

PAIRS = 1 << 22    # id pairs whose counts are broadcast at a time
CACHE = 1 << 19    # pieces whose ids a worker keeps during a job
PROBE = 4          # token ends compared first at a shift
BLOCK = 1 << 20    # bytes of text aligned together
LANE = 64          # pieces that are followed one after the other
WIDE = 1 << 16     # links of a group beyond which equal ones are counted, not listed
SHIFT = 32         # an id pair is (A id << SHIFT) + B id

SPACE, NEWLINE = 0x20, 0x0A


# ---- the alignment --------------------------------------------------------------

def align(ends_a: np.ndarray, ends_b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of two ascending arrays of token ends: for each group the
    number of tokens up to its end, in A and in B.  Lanes (where each begins,
    and the last one's end) are stretches of both that end at a common end;
    they are followed side by side, each with a shift and a probe of its own."""
    i, j, stop_a, stop_b = lanes_a[:-1], lanes_b[:-1], lanes_a[1:], lanes_b[1:]
    step = np.full(len(i), PROBE)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        live = np.flatnonzero(i < stop_a)
        if not len(live):
            return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))
        i, j, stop_a, stop_b, step = i[live], j[live], stop_a[live], stop_b[live], step[live]
        # how far the ends are equal at this shift
        size = np.minimum(step, np.minimum(stop_a - i, stop_b - j))
        first = np.cumsum(size) - size
        at = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        p, q = np.repeat(i, size) + at, np.repeat(j, size) + at
        k = np.minimum.reduceat(np.where(ends_a[p] == ends_b[q], np.repeat(size, size), at), first)
        same = at < np.repeat(k, size)
        found_a.append(p[same] + 1)
        found_b.append(q[same] + 1)
        i, j, whole = i + k, j + k, k == size
        step = np.where(whole, step * 2, PROBE)
        # an irregular group begins where they differ: step on the side that ends earlier
        odd = np.flatnonzero(~whole)
        p, q, todo = i[odd], j[odd], np.arange(len(odd))
        while len(todo):
            x, y = ends_a[p[todo]], ends_b[q[todo]]
            p[todo] += x < y
            q[todo] += y < x
            todo = todo[x != y]
        i[odd], j[odd] = p + 1, q + 1  # the new shift
        found_a.append(p + 1)
        found_b.append(q + 1)


# ---- encoding --------------------------------------------------------------------

def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where rows of a block can be cut: before a space or newline that
    follows printable ASCII or another character that surely is no white
    space (two bytes from U+00C0 on, three from U+4000 on)."""
    cut = (data == SPACE) | (data == NEWLINE)
    before = np.zeros((3, len(data)), dtype=np.uint8)  # the three bytes before each
    for i in range(3):
        before[i, i + 1:] = data[: max(len(data) - i - 1, 0)]
    b1, b2, b3 = before
    cut &= ((b1 > 0x20) & (b1 < 0x7F)) | ((b1 >= 0x80) & (((b2 >= 0xC3) & (b2 <= 0xDF)) | ((b3 >= 0xE4) & (b3 <= 0xEF))))
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class Tokenizers:
    """Both tokenizers: ids of texts that begin with the added space, bytes of
    their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        model = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            model.ParseFromString(f.read())
        model.normalizer_spec.add_dummy_prefix = False  # the space is in the text already
        self.b = SentencePieceProcessor(model_proto=model.SerializeToString())
        pieces = [p.piece for p in model.pieces]
        spelt = {c: b for b, c in _byte_letters().items()}
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(map(spelt.__getitem__, t)) if set(t) <= spelt.keys() else t.encode() for t in map(self.a.id_to_token, range(size))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if model.pieces[i].type == 6 else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        assert {*pre_tokenizers.ByteLevel.alphabet()} == spelt.keys()
        # pieces are encoded alone only if B can merge across no cut
        inner = [p[i] for p in pieces for i in range(1, len(p)) if p[i] in "▁\n" and p[i - 1] not in "▁\n"]
        spec = model.normalizer_spec
        self.apart = not inner and spec.name == "identity" and not spec.remove_extra_whitespaces

    def encode(self, texts: list[str]):
        """Ids by A, ids by B, and whether both spell the text, of each."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        for t, x, y in zip(texts, a, b):
            raw = t.encode()
            yield x, y, b"".join([self.bytes_a[i] for i in x]) == raw and b"".join([self.bytes_b[i] for i in y]) == raw


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokens spell bytes with: printable bytes
    stand for themselves, the others for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Lists:
    """Lists of integers by number, in one flat array."""

    def __init__(self):
        self.flat, self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, lists: list) -> None:
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.at = np.append(self.at, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, np.fromiter((i for x in lists for i in x), np.int32, int(size.sum())))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[which]
        upto = np.cumsum(size)
        return self.flat[np.repeat(self.at[which] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)], size


class PieceEncoder:
    """Ids of the pieces of blocks; each distinct piece is encoded once."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenizers = Tokenizers(path_a, path_b)
        self._clear()

    def _clear(self):
        self.h1, self.h2, self.number = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.a, self.b, self.ok = _Lists(), _Lists(), np.zeros(0, bool)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Of the pieces of a block: ids by A and how many each piece has, the
        same by B, whether the piece is spelt by both, where it starts."""
        start = cuts(data, offsets) if self.tokenizers.apart else offsets[:-1][np.diff(offsets) > 0]
        if len(self.h1) > CACHE:
            self._clear()
        h1, h2 = span_hashes(data, start, 0), span_hashes(data, start, 1)
        one, first, which = np.unique(h1, return_index=True, return_inverse=True)
        at = np.searchsorted(self.h1, one)
        known = at < len(self.h1)
        known[known] = self.h1[at[known]] == one[known]
        if (h2[first][which] != h2).any() or (self.h2[at[known]] != h2[first][known]).any():
            self._clear()  # 64 bits are shared by two pieces: every piece of this block by itself
            self._learn(data, start, np.arange(len(start)))
            found = np.arange(len(start))
            out = self._take(found, start)
            self._clear()
            return out
        new = np.flatnonzero(~known)
        if len(new):
            base = len(self.ok)
            self._learn(data, start, first[new])
            self.h1, self.h2 = np.insert(self.h1, at[new], one[new]), np.insert(self.h2, at[new], h2[first[new]])
            self.number = np.insert(self.number, at[new], base + np.arange(len(new)))
            at = np.searchsorted(self.h1, one)
        return self._take(self.number[at][which], start)

    def _learn(self, data, start, which):
        end = np.append(start[1:], len(data))
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(start[which].tolist(), end[which].tolist())]
        made = list(self.tokenizers.encode(texts))
        self.a.add([m[0] for m in made])
        self.b.add([m[1] for m in made])
        self.ok = np.append(self.ok, np.array([m[2] for m in made], bool))

    def _take(self, found, start):
        return (*self.a.take(found), *self.b.take(found), self.ok[found], start)


# ---- a block of documents -----------------------------------------------------------

class Alignment:
    """Tokens and groups of the documents of a block: ids ``a`` and ``b``;
    tokens up to the end of each group, ``upto_a`` and ``upto_b``; and of each
    document the range of its tokens and groups (``doc_a``, ``doc_b``,
    ``doc_g``, each one longer than the documents)."""

    def __init__(self, encoder: PieceEncoder, data: np.ndarray, offsets: np.ndarray):
        n_docs = len(offsets) - 1
        if not len(data):
            self.a = self.b = np.zeros(0, np.int32)
            self.upto_a = self.upto_b = np.zeros(0, np.int64)
            self.doc_a = self.doc_b = self.doc_g = np.zeros(n_docs + 1, np.int64)
            return
        a, size_a, b, size_b, ok, start = encoder.encode(data, offsets)
        pieces = np.searchsorted(start, offsets)  # of each document
        bad = np.concatenate([[0], np.cumsum(~ok)])
        good = bad[pieces[1:]] == bad[pieces[:-1]]
        use = np.repeat(good, np.diff(pieces))  # pieces of documents that are spelt
        if not good.all():
            a, b = a[np.repeat(use, size_a)], b[np.repeat(use, size_b)]
            size_a, size_b = size_a * use, size_b * use
        self.a, self.b = a, b
        end_a, end_b = np.cumsum(encoder.tokenizers.len_a[a]), np.cumsum(encoder.tokenizers.len_b[b])
        at_a, at_b = np.concatenate([[0], np.cumsum(size_a)]), np.concatenate([[0], np.cumsum(size_b)])
        lanes = np.append(np.arange(0, len(start), LANE), len(start))  # a piece ends a token of both
        self.upto_a, self.upto_b = align(end_a, end_b, at_a[lanes], at_b[lanes])
        self.doc_a, self.doc_b = at_a[pieces], at_b[pieces]
        self.doc_g = np.searchsorted(self.upto_a, self.doc_a, side="right")

    def groups(self):
        """First token and tokens of each group, in A and in B."""
        a0, b0 = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (self.upto_a, self.upto_b))
        return a0, self.upto_a - a0, b0, self.upto_b - b0

    def links(self):
        """Documents, id pairs and numbers of links, distinct by document and
        pair and sorted; and the links of each document."""
        n_docs = len(self.doc_g) - 1
        a0, na, b0, nb = self.groups()
        doc = np.repeat(np.arange(n_docs), np.diff(self.doc_g))
        upto = np.concatenate([[0], np.cumsum(na * nb)])
        total = upto[self.doc_g[1:]] - upto[self.doc_g[:-1]]
        # one number for document, A id and B id, in this order
        size_a, size_b = (int(x.max(initial=0)) + 1 for x in (self.a, self.b))
        key = lambda d, x, y: (d * size_a + x) * size_b + y
        g = np.flatnonzero(na * nb <= WIDE)
        n = na[g] * nb[g]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        of = np.repeat(g, n)
        q, r = np.divmod(inside, nb[of])
        found, counts = np.unique(key(doc[of], self.a[a0[of] + q], self.b[b0[of] + r]), return_counts=True)
        for g in np.flatnonzero(na * nb > WIDE):  # the links of a long group are the product of its id counts
            x, cx = np.unique(self.a[a0[g]: a0[g] + na[g]], return_counts=True)
            y, cy = np.unique(self.b[b0[g]: b0[g] + nb[g]], return_counts=True)
            more = key(doc[g], x.astype(np.int64)[:, None], y).ravel()
            found, which = np.unique(np.concatenate([found, more]), return_inverse=True)
            counts = np.concatenate([counts, np.multiply.outer(cx, cy).ravel()])
            counts = np.add.reduceat(counts[np.argsort(which, kind="stable")], np.searchsorted(np.sort(which), np.arange(len(found))))
        docs, pair = np.divmod(found, size_a * size_b)
        x, y = np.divmod(pair, size_b)
        return docs, (x << SHIFT) + y, counts, total

    def texts(self, said_a: np.ndarray, said_b: np.ndarray):
        """``a1,a2|b1;a3|b2`` of each document; ``said_*``: ids as text, once
        with a comma and once as the last of a group."""
        a0, na, b0, nb = self.groups()
        out = np.empty(len(self.a) + len(self.b), object)
        for ids, upto, n, before, said in ((self.a, self.upto_a, na, b0, said_a), (self.b, self.upto_b, nb, self.upto_a, said_b)):
            last = np.zeros(len(ids), np.int64)
            last[upto - 1] = 1
            out[np.arange(len(ids)) + np.repeat(before, n)] = said[last, ids]
        ends = (self.doc_a + self.doc_b).tolist()
        for x, y in zip(ends, ends[1:]):
            yield "".join(out[x:y].tolist())[:-1]


def _worker_encoder(path_a: str, path_b: str, job: str) -> PieceEncoder:
    """The encoder of this job in this worker process, which runs several of
    its tasks one after the other."""
    state = sys.modules.setdefault("_cuespark_alignment", types.ModuleType("_cuespark_alignment")).__dict__
    if state.get("job") != (job, path_a, path_b):
        state["encoder"], state["job"] = PieceEncoder(path_a, path_b), (job, path_a, path_b)
    return state["encoder"]


def _aligned(batches, path_a, path_b, job):
    """Id column and ``Alignment`` of blocks of rows."""
    for batch in batches:
        encoder = _worker_encoder(path_a, path_b, job)
        text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        led = pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string())))
        for first, n, data, offsets in text_blocks(led, BLOCK):
            yield batch.column("id").slice(first, n), encoder, Alignment(encoder, data, offsets)


def _lists(values, ends):
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _grouper(path_a, path_b, job):
    def run(batches):
        for ids, _, x in _aligned(batches, path_a, path_b, job):
            per = np.diff(x.doc_g)
            upto = [_lists((u - np.repeat(d[:-1], per)).astype(np.int32), x.doc_g) for u, d in ((x.upto_a, x.doc_a), (x.upto_b, x.doc_b))]
            yield pa.RecordBatch.from_arrays([ids, _lists(x.a, x.doc_a), _lists(x.b, x.doc_b), *upto], names=["id", "a", "b", "upto_a", "upto_b"])

    return run


def _digester(path_a, path_b, job):
    def run(batches):
        said = None
        for ids, encoder, x in _aligned(batches, path_a, path_b, job):
            if said is None:
                word = lambda size, *marks: np.array([[f"{i}{m}" for i in range(size)] for m in marks], object)
                said = word(len(encoder.tokenizers.len_a), ",", "|"), word(len(encoder.tokenizers.len_b), ",", ";")
            doc, pair, count, links = x.links()
            cut = np.searchsorted(doc, np.arange(len(ids) + 1))
            digest = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.texts(*said)]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(np.diff(v).astype(np.int64)) for v in (x.doc_a, x.doc_b, x.doc_g)), pa.array(links), pa.array(digest, pa.string()),
                 _lists(pair, cut), _lists(count, cut)], names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return run


def _scorer(known):
    def run(batches):
        pairs, counts, best = known.value
        for batch in batches:
            flat, links = (np.asarray(batch.column(c).flatten()) for c in ("pairs", "links"))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("pairs")).to_numpy())])
            at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
            on = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            upto = [np.concatenate([[0], np.cumsum(np.where(on, v[at] * links, 0))]) for v in (best, counts)] if len(pairs) else [np.zeros(len(flat) + 1, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([batch.column("rid"), *(pa.array(u[ends[1:]] - u[ends[:-1]]) for u in upto)], names=["rid", "n_best", "count_sum"])

    return run


# ---- plans --------------------------------------------------------------------------

def _rows(docs: DataFrame, doc_id: str, text: str):
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def alignments(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignment itself: of every row its ids ``a`` and ``b``, and the
    number of tokens up to the end of each group, ``upto_a`` and ``upto_b``."""
    rows, kind = _rows(docs, doc_id, text)
    run = _grouper(tokenizer_a, tokenizer_b, uuid.uuid4().hex)
    out = rows.mapInArrow(run, f"id {kind}, a array<int>, b array<int>, upto_a array<int>, upto_b array<int>")
    return out.withColumnRenamed("id", doc_id)


def linked_pairs(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every row's alignment, with its distinct linked id pairs and
    their links; written, with a number ``rid`` of the row."""
    rows, kind = _rows(docs, doc_id, text)
    run = _digester(tokenizer_a, tokenizer_b, uuid.uuid4().hex)
    made = rows.mapInArrow(run, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<bigint>")
    return materialize(made.withColumn("rid", F.monotonically_increasing_id()), "aligned")


def pair_counts(table: DataFrame) -> DataFrame:
    """``pair``, the documents ``n`` that hold it linked, and ``best``: 1 if no
    pair of its A id has more; written."""
    counts = materialize(table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a = F.shiftright("pair", SHIFT)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # at most one row per A id
    return materialize(counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "pair-scores")


def pair_scores(table: DataFrame, counts: DataFrame, block: int = PAIRS) -> DataFrame:
    """``rid``, ``n_best`` and ``count_sum`` of every row, the counts looked up
    a block of pairs at a time."""
    spark = table.sparkSession
    blocks = max(1, math.ceil(counts.count() / block))
    parts = []
    for k in range(blocks):
        mine = counts if blocks == 1 else counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k)
        got = mine.toArrow().sort_by("pair")
        known = spark.sparkContext.broadcast(tuple(got[c].to_numpy() for c in ("pair", "n", "best")))
        part = table.select("rid", "pairs", "links").mapInArrow(_scorer(known), "rid bigint, n_best bigint, count_sum bigint")
        if blocks > 1:
            part = materialize(part, "pair-sums")
            known.unpersist()
        parts.append(part)
    if blocks == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return every.groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def report(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id", text: str = "text", block: int = PAIRS) -> DataFrame:
    """One row per document row: tokens, groups, links, how well its links
    agree with the corpus, and a digest of the groups."""
    table = linked_pairs(docs, tokenizer_a, tokenizer_b, doc_id, text)
    facts = table.select(F.col("id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "rid")
    return facts.join(pair_scores(table, pair_counts(table), block), "rid").drop("rid")
