"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected) and is timed once after a warm-up query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cuespark.plans.catalog import QUERIES  # noqa: E402
from cuespark.session import build_session  # noqa: E402

HEADLINE = [
    "tokenize_documents",   # S7 scan + regex tokenizer
    "feature_table",        # the 17-column feature pipeline (W*, F*, A3)
    "lexicon",              # A1 n-gram lexicon
    "sbs_count",            # A3 substring counts joined back
    "match_multi",          # W5 block-window multi-word cues
    "sentences",            # A6 sentence pieces
    "corpus_position",      # W8 two-level prefix sums
    "embedding_context",    # J4 vector lookups
    "evaluate_systems",     # M14 scoring two systems
    "classification_report",
    "error_rows",           # J5
    "train_nb",             # M1 + M4 + M8 on the whole table
    "train_svm",            # M2 to the solver's tolerance
    "predict_tagger",       # M9 + M10 CRF train + Viterbi
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "24g")})
    # warm-up on the smallest tables: JVM, JIT and codegen caches
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for n in names:
        QUERIES[n](spark, warm if os.path.isdir(warm) else sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
