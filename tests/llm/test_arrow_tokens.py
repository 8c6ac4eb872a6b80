import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cuespark.llm import arrow_tokens as A
from cuespark.llm.queries import tokenizer_file

TOK = Tokenizer.from_file(tokenizer_file())
ENC = A.PieceEncoder(tokenizer_file())


def encode(rows):
    raw = [t.encode() for t in rows]
    ids, size = ENC.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\r\xa0\u2003\u3000\u1680\u2014\x1c\x85ab's\u00e9\u00d7\u65e51\u00b2._-<|>", "<|endoftext|>"]), max_size=40).map("".join), min_size=1, max_size=5))
def test_pieces_give_the_ids_of_the_whole_text(rows):
    assert encode(rows) == [TOK.encode(t, add_special_tokens=False).ids for t in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(rows):
    assert encode(rows) == [TOK.encode(t, add_special_tokens=False).ids for t in rows]


def test_shared_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(A, "span_hashes", lambda data, start, base=0: np.zeros(len(start), np.uint64) if base == 0 else np.arange(len(start), dtype=np.uint64))
    fresh = A.PieceEncoder(tokenizer_file())
    monkeypatch.setitem(globals(), "ENC", fresh)
    assert encode(["a bc def", "ghi jk"]) == [TOK.encode(t, add_special_tokens=False).ids for t in ("a bc def", "ghi jk")]


def texts():
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcdeé ", k=rnd.randint(1, 9)))
    docs = [(rnd.randint(-50, 10**6), " ".join(word() for _ in range(rnd.randint(0, 80)))) for _ in range(300)]
    return docs + [(5, None), (6, ""), (7, "x " * 9000), (7, "x " * 9000), (None, "null id")]


def test_round_trip(spark, make_docs):
    docs = texts()
    folder = A.shared_folder(spark, "round-trip")
    got = [tuple(r) for r in A.token_index(make_docs(docs), tokenizer_file(), folder, length=64).collect()]
    want, at = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(x[2:] for x in got) == sorted(x[2:] for x in want)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_sequences_are_equal_length_views(spark, make_docs):
    folder = A.shared_folder(spark, "views")
    manifest = A.write_tokens(make_docs(texts()), tokenizer_file(), folder, length=32)
    held = 0
    for r in manifest.collect():
        shard = A.Shard(f"{folder}/shards", r.shard)
        before, n = pa.total_allocated_bytes(), 0
        for i in range(shard.batches.num_record_batches):
            ids, mask = shard.sequences(i)
            assert ids.shape == mask.shape and ids.shape[1] == 32 and not ids.flags.owndata
            n += int(mask.sum())
        assert pa.total_allocated_bytes() - before < 1024  # read in place
        assert n == r.n_tokens
        held += n
    assert held == sum(len(TOK.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts())


def test_empty_table(spark, make_docs):
    assert A.token_index(make_docs([]), tokenizer_file()).count() == 0
