"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times on the clock; the median counts. Rows are
written to a sink that discards them, so the whole result is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wordloom.plans.queries import QUERIES
from wordloom.session import local_session

HEADLINE = (
    "tokenize_default",
    "tokenize_conversational",
    "word_counts",
    "vocab_ids",
    "encode_docs",
    "decode_docs",
    "doc_unk_rate",
    "sliding_windows",
    "shifted_samples",
    "batches",
    "normalize_messages",
    "train_val_split",
    "smoothed_cross_entropy",
    "knn_cosine",
    "ema_loss",
    "rolling_diagnostics",
    "health_status",
    "tuner_replay",
    "stream_encode",
    "stream_health",
)


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        run(spark, name, sf)
        seconds[name] = round(statistics.median(run(spark, name, sf) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
