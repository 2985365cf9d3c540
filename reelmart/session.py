"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side of a join may have before it is no longer broadcast. The sides in
# question hold a few short columns, so this stays in the tens of megabytes.
BROADCAST_ROW_LIMIT = 200_000


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on: all landed dates are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# How landed files are scanned, many and small as they are, unless the session has its own values. Spark's
# own count an opened file as 4 MB, so that 32 files make a task, and list files in 10,000 tasks at a time.
SMALL_FILES = {
    "spark.sql.files.openCostInBytes": "128k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def for_small_files(spark: SparkSession) -> SparkSession:
    """Set the session to put many landed files into a task; no result depends on it."""
    given = spark.sparkContext.getConf()
    for key, value in SMALL_FILES.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A small session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelmart")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster other
    executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelmart-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Freezes values that a recomputation could change (sampled range bounds) and
    survives the loss of executors, which a cached copy would not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``limit`` rows.

    Beyond the limit the join stays an ordinary shuffle join, where adaptive
    execution splits skewed keys.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
