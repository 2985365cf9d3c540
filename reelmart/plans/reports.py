"""Validation and report queries over the gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.functions.scalars import steady_mean, steady_sum, ratio_or_zero


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, stacked."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).orderBy("table_name")


def media_listing(dim_media: DataFrame) -> DataFrame:
    """G1: the media dimension at a glance."""
    return dim_media.select(
        "media_id", "title", "duration_seconds", "media_type", "status", "created_at", "updated_at"
    ).orderBy(F.asc_nulls_last("media_id"))


def daily_engagement(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """The media/date fact with titles and rounded rates."""
    titled = fact.join(dim_media.select("media_id", "title"), "media_id", "left")
    return titled.select(
        "stat_date",
        "media_id",
        "title",
        "load_count",
        "play_count",
        F.round(F.col("play_rate") * 100, 2).alias("play_rate_pct"),
        F.round("total_watch_time_hours", 3).alias("total_watch_time_hours"),
        "event_count",
        "unique_visitors",
        F.round("watched_percent", 2).alias("avg_watched_percent"),
    ).orderBy(F.asc_nulls_last("stat_date"), F.asc_nulls_last("title"), F.asc_nulls_last("media_id"))


def engagement_by_country(fact_event: DataFrame) -> DataFrame:
    """Events, visitors and mean share viewed per country."""
    return (
        fact_event.groupBy(F.coalesce("country", F.lit("UNKNOWN")).alias("country"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("visitor_key").alias("unique_visitors"),
            F.round(steady_mean(F.col("percent_viewed")), 2).alias("avg_percent_viewed"),
        )
        .orderBy(F.desc("event_count"), "country")
    )


def orphan_rows(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Rows whose key is missing from the dimension, NULL keys included.

    The fact is counted per key first, so only distinct keys are shuffled to the
    join, however often a key occurs.
    """
    per_key = fact.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    known = dim.select(F.col(dim_key).alias("_key"))
    return per_key.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias(name))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys counted as one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1")


def date_check(fact: DataFrame, dim_date: DataFrame, rows: int = 50) -> DataFrame:
    """The first rows of the fact next to their calendar entry.

    Names differ from the fact's only in the dimension, so its own date stays visible.
    """
    calendar = dim_date.select("date_key", "full_date", "day_name", "week_of_year")
    return (
        fact.select("stat_date", "date_key", "media_id")
        .join(calendar, "date_key", "left")
        .orderBy(F.asc_nulls_last("stat_date"), F.asc_nulls_last("media_id"))
        .limit(rows)
        .select("stat_date", "date_key", "full_date", "day_name", "week_of_year")
    )


def _totals() -> list:
    return [
        F.sum("play_count").alias("total_plays"),
        F.sum("load_count").alias("total_loads"),
        steady_sum(F.col("total_watch_time_hours")).alias("watch_time_hours"),
    ]


def media_kpis(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """M5: totals per media; the overall play rate is all plays over all loads."""
    totals = fact.groupBy("media_id").agg(
        *_totals(), F.sum("event_count").alias("total_events")
    )
    rated = totals.withColumn("play_rate", ratio_or_zero(F.col("total_plays"), F.col("total_loads")))
    return rated.join(dim_media.select("media_id", "title"), "media_id", "left")


def plays_over_time(fact: DataFrame) -> DataFrame:
    """M5: totals per date."""
    return fact.groupBy("stat_date").agg(*_totals()).orderBy(F.asc_nulls_last("stat_date"))


def overall_kpis(fact: DataFrame) -> DataFrame:
    """M5: the four headline numbers."""
    return fact.agg(*_totals()).withColumn(
        "play_rate", ratio_or_zero(F.col("total_plays"), F.col("total_loads"))
    )
