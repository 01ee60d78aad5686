"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termcluster.llm.shared import id_and_text

FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, sample_bytes: int) -> tuple[dict, float]:
    """Texts of each class, {0: [(id, text), ...], 1: ...}, from the labelled
    documents outside the held-out fold with the smallest hashes of their ids:
    at most per_class documents and sample_bytes of text in each (whole texts;
    one that no longer fits is left out). Second: the share of label 1 among
    all labels of the fold (0.5 without any). A document with several labels has the
    smallest one."""
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.filter(~held_out("id")).groupBy("id").agg(F.min("y").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    drawn = []
    for y in (0, 1):
        drawn += known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()
    order = {r.id: k for k, r in enumerate(drawn)}
    chosen = F.broadcast(spark.createDataFrame([(r.id, r.y) for r in drawn], "id long, y int"))  # at most 2 * per_class rows
    rows = id_and_text(docs, id_col, text_col).filter("txt is not null").join(chosen, "id").withColumn("size", F.octet_length("txt")).withColumn("key", F.xxhash64("txt"))
    fits, total = set(), {0: 0, 1: 0}
    for r in sorted(rows.select("id", "y", "size", "key").distinct().collect(), key=lambda r: (order[r.id], r.size, r.key)):
        if total[r.y] + r.size <= sample_bytes:
            total[r.y] += r.size
            fits.add((r.id, r.key))
    small = F.broadcast(spark.createDataFrame(sorted(fits), "id long, key long"))
    texts: dict[int, list] = {0: [], 1: []}
    for r in sorted(rows.join(small, ["id", "key"]).dropDuplicates(["id", "key"]).collect(), key=lambda r: (order[r.id], r.txt)):
        texts[r.y].append((r.id, r.txt))
    n = sum(counts.values())
    return texts, counts.get(1, 0) / n if n else 0.5
