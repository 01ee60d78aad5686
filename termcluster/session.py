"""Session helpers: checkpoint directory, reliable checkpoints, and a
local session factory for tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Taken from the context (``setCheckpointDir``) or the
    ``spark.checkpoint.dir`` setting, in local mode as well; there is no
    fallback, as a machine-local folder would not survive the loss of an
    executor."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the server reads the setting
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    raise RuntimeError(
        "no checkpoint directory: set spark.checkpoint.dir to a shared "
        "folder (HDFS, S3, ...) visible to every executor")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its
    lineage, so later jobs (k-means steps) never recompute the scan and
    join when an executor is lost. The eager write is the one job that
    computes ``df``, so no cached copy is needed."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "termcluster") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
