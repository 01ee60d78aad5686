"""Run every registered query and write its final (post-AQE) physical
plan to PLANS.md, for plan review: pushed filters, read schemas, partial
aggregates, join strategies, exchanges.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termcluster.operators import kmeans as km  # noqa: E402
from termcluster.operators.clustering import prepare  # noqa: E402
from termcluster.plans.catalog import POSTING_PARAMS, QUERIES  # noqa: E402
from termcluster.session import local_session  # noqa: E402
from termcluster.sources import tables  # noqa: E402


def final_plan(df) -> str:
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print(f"# Physical plans\n\nFinal adaptive plans of every registered query at `{sf_dir}` "
          "on `local[8]`. Generated by `tools/show_plans.py`.\n")
    for name, fn in QUERIES.items():
        if name == "kmeans":
            run = prepare(tables.postings(spark, sf_dir), POSTING_PARAMS)
            df = km.step_means(run.points, run.initial, run.lines)
            title = "kmeans (all points, as in the first step; later ones take moved intervals and their bands)"
        else:
            df, title = fn(spark, sf_dir), name
        print(f"## {title}\n\n```\n{final_plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
