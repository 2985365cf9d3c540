"""One row per key (F1, F2, E3), with a total order so that replays agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per(rows: DataFrame, keys: list[str], order: list[Column], tie_break: list[str] | None = None) -> DataFrame:
    """of the rows that share ``keys`` the one that ``order`` puts first.

    ``tie_break`` columns, all others unless given, go on with the order (highest first, NULL
    last) until two rows that still tie are equal, so checks, writes and replays see the same
    survivor. Map tasks already leave one row per key, so a key with a third of all rows
    reaches its reducer as one row per map task.
    """
    rest = tie_break if tie_break is not None else rows.drop(*keys).columns
    total = [*order, *map(F.desc_nulls_last, rest)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*total))
    return rows.select("*", place.alias("_place")).where(F.col("_place") == 1).drop("_place")


def snapshot_per(rows: DataFrame, keys: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """One row per key where any would do, chosen the same way every time."""
    return newest_per(rows, keys, [], tie_break)


def last_event_of_visitors(events: DataFrame) -> DataFrame:
    """what every known visitor did last, as whole events; undated ones only where a visitor has no other."""
    known = events.dropna(subset=["visitor_key"])
    return newest_per(known, ["visitor_key"], [F.desc_nulls_last("received_at")])
