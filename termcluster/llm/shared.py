"""Small Spark helpers of the operators: scratch tables, columns, batches."""

from __future__ import annotations

import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def scratch(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: its lineage is
    cut, and a lost executor costs no more than the reads of its own tasks."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}-{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def import_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (on a cluster it is installed, or sent with --py-files)."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([PACKAGE_ROOT, *filter(None, paths)])


def id_and_text(docs: DataFrame, id_col: str, text_col: str, keep_row: bool = False) -> DataFrame:
    """id long, txt string and, with keep_row, row: all columns as one struct.
    Names of other columns can't clash with those of the operators."""
    row = [F.struct("*").alias("row")] if keep_row else []
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("txt"), *row)


def batch(**columns) -> pa.RecordBatch:
    """A record batch of numpy or Arrow columns; uint64 goes as the long of the same bits."""
    arrays = [pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c) if not isinstance(c, pa.Array) else c for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
