"""Row numbers over a total order, computed by many tasks.

A window without partition, or with a hot key, sorts all its rows in one task. Here
the rows are dealt by ranges of (keys, order) and sorted in place; the rows before a
range are then a running total over one count per range. Rows that are equal in keys
and order are told apart by their place in the input, so one value that fills a third
of all rows is still dealt over many ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termcluster.session import reliable_checkpoint


def numbered(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` plus ``rn``, a row's number from 0 in ``order`` among the rows of its
    keys (not null). The sorted rows are written to the checkpoint folder, so that
    places and counts come from the same rows; the running totals see one row per
    range and key in it, at most ranges + keys rows."""
    keys, order = list(keys), [F.col(c) if isinstance(c, str) else c for c in order]
    by = [*(F.col(k) for k in keys), *order, F.col("_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    # the number of a row in its range, from the smallest number there
    placed = reliable_checkpoint(dealt.drop("_tie").select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")))
    counts = placed.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy("_range")
    before = (F.sum("_n").over(w) - F.col("_n") - F.col("_first")).alias("_shift")
    shifts = counts.select(*keys, "_range", before)
    return placed.join(shifts, [*keys, "_range"]).withColumn("rn", F.col("_at") + F.col("_shift")).select(*df.columns, "rn")
