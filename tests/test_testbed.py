"""Landed rows made of the given tables, in tasks of bounded size."""

from pyspark.sql import functions as F

from tests.conftest import rows
from workload import queries, testbed


def test_media_versions_are_made_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    n = F.col("id")
    line = spark.range(2000).select(
        n.alias("l_orderkey"), (n % 400).alias("l_partkey"), (n % 7).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"), F.lit(0.05).alias("l_discount"), (n % 3 / 100).alias("l_tax"),
        F.when(n % 2 == 0, "A").otherwise("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.timestamp_seconds(1_700_000_000 + n).cast("timestamp_ntz").alias("l_shipdate"),
    )
    part = spark.range(400).select(
        n.alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"), F.lit("b").alias("p_brand"),
        F.lit("t").alias("p_type"), (n % 9).cast("int").alias("p_size"),
    )
    # all lines in one file, which is one task of any scan
    line.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(testbed, "LINES_PER_TASK", 100)
    landed = queries.LANDED["media"](spark, str(tmp_path))
    sizes = landed.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_distinct("id").alias("media")).collect()
    assert max(r["n"] for r in sizes) < 500, "a task sorts a bounded number of versions"
    assert sum(r["media"] for r in sizes) == 400, "versions of a media meet in the task that drops the older ones"
    assert rows(landed.select(F.to_json(F.struct("*")))) == rows(testbed.landed_media(spark, str(tmp_path)).select(F.to_json(F.struct("*"))))
