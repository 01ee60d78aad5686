"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is timed end to end (plan, run, write to the noop sink) after
untimed warm-up queries on the smallest data set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termcluster.plans.catalog import QUERIES  # noqa: E402
from termcluster.session import local_session  # noqa: E402

HEADLINE = [
    "rank_terms_all",          # ranking by separate counts (zero rows kept)
    "rank_terms_from_index",   # ranking via the inverted index (index built inside)
    "rank_terms_grouped",      # ranking in one shuffle
    "term_index",              # the inverted index itself
    "question_max_score",      # answers aggregated, joined to questions
    "score_vectors",           # 2-D points per answered, tagged question
    "kmeans",                  # sample + checkpoint + integer k-means loop
    "cluster_report",          # the whole clustering and its report
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=max(2, cpus), app="termcluster-bench")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):  # JVM warm-up of both code paths, untimed
        for name in ("rank_terms_grouped", "question_max_score", "kmeans", "cluster_report"):
            run(QUERIES[name](spark, warm))
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
