"""Small literal DataFrames built on the JVM side.

``spark.createDataFrame`` over a Python list plans as a scan of a Python
RDD and starts Python workers; the term list and the centres are tiny
driver-held parameters, so they are built from a literal array of
structs with ``inline`` instead (a plain JVM plan, no Python worker).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_frame(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str],
                  types: Sequence[str]) -> DataFrame:
    """A DataFrame with the given rows; column ``names[i]`` has SQL type ``types[i]``."""
    if not rows:
        schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)])
               for r in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
