import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from cuespark.llm.queries import tokenizer_file

from . import test_bag_minhash, test_decontaminate, test_fair_mix, test_line_frequency

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(rnd):
    vocab = [f"word{i}" for i in range(5000)]
    item = " ".join(rnd.choices(vocab, k=30))
    docs = []
    for d in range(160):
        text = "\n".join(" ".join(rnd.choices(vocab, k=rnd.randint(5, 25))) for _ in range(rnd.randint(2, 8)))
        if d % 9 == 0:
            text += "\n" + item
        if d % 3 == 0:
            text += "\nThe common footer of this host"
        docs.append((d, text, "en", rnd.choice(["a", "b", None]), len(text)))
    for d in range(160, 200):
        w = docs[d - 160][1].split(" ")
        w[len(w) // 2] = "changed"
        docs.append((d, " ".join(w), "en", docs[d - 160][3], None))
    docs += [(300, None, None, "a", None), (301, "", "en", None, 0), (302, "too short", "en", "a", 9), (5, docs[5][1], "en", docs[5][3], docs[5][4]), (None, docs[7][1], "en", "b", 1)]
    return docs, [(1, item), (2, "other " * 12)]


def test_stages_match_brute_force(spark, tmp_path):
    docs, items = table(random.Random(8))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = []
    for name, stage in P.STAGES:
        df = stage(spark, df, str(tmp_path))
        df.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        steps.append([tuple(r) for r in df.collect()])
        if name != "token_files":
            assert df.columns == COLUMNS
    quality, near, clean, mixed, index = steps

    judged = test_line_frequency.brute([(d[0], d[1], d[3]) for d in docs], 10, 0.005)
    assert Counter((r[0], r[1]) for r in quality) == Counter((j[0], j[-1]) for j in judged if j[-2])
    assert 0 < len(quality) < len(docs)

    classes = test_bag_minhash.brute_classes([r[:2] for r in quality])
    assert len(near) == len({c for _, c in classes}) and {r[0] for r in near} == {c for _, c in classes}
    assert Counter(near) - Counter(quality) == Counter()

    leaks = test_decontaminate.brute([r[:2] for r in near], items)
    assert {r[0] for r in clean} == {x[0] for x in leaks if not x[5]} and len(clean) < len(near)

    taken = test_fair_mix.brute([(r[0], r[1], r[3]) for r in clean])
    want = Counter({r: t[4] // t[1] for r, t in zip(clean, taken) if t[4]})
    assert Counter(mixed) == want

    tok, at, want = Tokenizer.from_file(tokenizer_file()), 0, []
    for r in sorted(mixed, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(r[1], add_special_tokens=False).ids + [2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert Counter(index) == Counter(want)

    assert Counter(tuple(r) for r in P.run(spark, str(tmp_path)).collect()) == Counter(index)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
