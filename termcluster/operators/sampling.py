"""Reproducible exact-size samples of the vectors (initial centres).

The reference samples with a reservoir per stratum whose outcome depends
on the shuffle order. Here each row gets a pseudo-random key
``md5(seed ':' id)`` and a sample is the rows with the smallest keys:
the same on any cluster layout, and exact in size.

Per stratum, ``row_number() <= k`` over ``partition by stratum`` plans
as a partial ``WindowGroupLimit`` **before** the shuffle, so every map
task forwards at most k rows per stratum: a stratum holding a third of
all rows costs k rows per task, never a whole group in one task.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_key(seed: int, id_col: str = "id") -> Column:
    """The pseudo-random sort key of a row: ``md5('<seed>:<id>')``."""
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(id_col).cast("string")))


def sample_per_stratum(vectors: DataFrame, per_stratum: int, seed: int,
                       stratum: str = "x", id_col: str = "id") -> DataFrame:
    """Exactly ``min(k, stratum size)`` rows of every stratum, with their
    rank ``rn`` (1..k) in the stratum."""
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    w = Window.partitionBy(stratum).orderBy(sample_key(seed, id_col), F.col(id_col))
    return (vectors.withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= per_stratum))


# Sizes up to here are a top-n: every task keeps n rows and one merges them.
ONE_TASK = 100_000
# Hex digits by which the histogram of keys is refined: at most 65 536 buckets.
DIGITS = 4


def sample_global(vectors: DataFrame, n: int, seed: int, id_col: str = "id", one_task: int = ONE_TASK) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: those with the
    smallest keys.

    Up to ``one_task`` rows are a top-n. More are never sorted or held in one
    task: a histogram of key prefixes (at most 65 536 counts on the driver)
    says in which bucket the n-th key lies; that bucket is refined until at
    most ``one_task`` of its rows are left to decide on, and one filter takes all
    keys below it. Rows that share one id and lie on the border (more than
    ``one_task`` of them) are cut by a plain limit."""
    if n <= 0:
        raise ValueError("n must be positive")
    order = (sample_key(seed, id_col), F.col(id_col))
    if n <= one_task:
        return vectors.orderBy(*order).limit(n)
    key, border, left = order[0], "", n
    while True:
        inside = vectors.filter(key.startswith(border)) if border else vectors
        counts = sorted(tuple(r) for r in inside.groupBy(F.substring(key, 1, len(border) + DIGITS).alias("p")).count().collect())
        for prefix, count in counts:
            if count > left:
                break
            left -= count
        else:  # everything in the bucket belongs to the sample (only the whole table can end here)
            return vectors
        border = prefix
        if min(count, left) <= one_task or len(border) >= 32:
            break
    below = vectors.filter(key < border)
    if not left:
        return below
    edge = vectors.filter(key.startswith(border))
    return below.unionByName(edge.limit(left) if len(border) >= 32 else edge.orderBy(*order).limit(left))


def initial_centres(vectors: DataFrame, kernels: int, per_stratum: int | None,
                    seed: int) -> list[tuple[int, int]]:
    """The ``kernels`` initial centres, on the driver (at most ``kernels``
    rows are collected).

    ``per_stratum`` set: stratified sample, ordered by (x, rank); every
    stratum present must supply ``per_stratum`` rows and the total must
    be ``kernels``. ``per_stratum`` None: global sample of ``kernels``."""
    if per_stratum is None:
        rows = sample_global(vectors, kernels, seed).select("x", "y").collect()
    else:
        rows = (sample_per_stratum(vectors, per_stratum, seed)
                .select("x", "y", "rn").collect())
        short = {x: n for x, n in Counter(r["x"] for r in rows).items() if n < per_stratum}
        if short:
            raise ValueError(f"strata with fewer than {per_stratum} rows: {sorted(short)}")
        rows = sorted(rows, key=lambda r: (r["x"], r["rn"]))
    if len(rows) != kernels:
        raise ValueError(f"sampled {len(rows)} centres, expected {kernels}")
    return [(int(r["x"]), int(r["y"])) for r in rows]
