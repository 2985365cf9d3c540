"""Landed payloads to the six silver tables (C2-C7, F1a-F1d, E3, M1).

Each function takes the landed rows of its dataset (payload fields plus the
source file) and the successful runs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.functions.scalars import asset_count, iso_date, iso_timestamp
from reelmart.operators.dedup import newest_per
from reelmart.operators.layers import of_keys
from reelmart.schemas import SILVER, SILVER_SOURCES
from reelmart.session import small_side
from reelmart.sources.landing import CORRUPT, SOURCE, quarantined, read_landed, readable, rows_of_runs


def projected(rows: DataFrame, name: str, **computed: Column) -> DataFrame:
    """The columns of a silver table in the contract's order, from their declared sources or as computed."""
    sources = SILVER_SOURCES[name]
    return rows.select(*[computed.get(c, F.col(sources.get(c, c))).alias(c) for c in SILVER[name].names])


def _newest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Survivors among the landed rows, before any wide projection: flattening, text
    parsing and JSON building then run for survivors only. Ties fall to run and file,
    which settle all other lineage, then to the payload."""
    lineage = ("run_id", SOURCE, "ingested_at", "ingestion_date", "media_id_from_path")
    payload = [c for c in rows.columns if c not in (*keys, *lineage)]
    return newest_per(rows, keys, order, ["run_id", SOURCE, *payload])


def silver_media(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """The most recently updated version of every media."""
    versions = rows_of_runs(readable(landed).drop("protected", "section"), runs).withColumn(
        "updated_at", iso_timestamp(F.col("updated"))
    )
    order = [F.desc_nulls_last("updated_at"), F.desc_nulls_last("ingested_at")]
    return projected(
        _newest(versions, ["media_id_from_path"], order),
        "media",
        created_at=iso_timestamp(F.col("created")),
        asset_count=asset_count(F.col("assets")),
        assets_json=F.to_json("assets"),
    )


def _per_run(name: str, landed: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per media and run."""
    return projected(_newest(rows_of_runs(readable(landed), runs), ["media_id_from_path", "run_id"], []), name)


def silver_media_stats(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """One cumulative snapshot per media and run."""
    return _per_run("media_stats", landed, runs)


def silver_media_daily_stats(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """The value of every media and date seen last; overlaps collapse."""
    rows = rows_of_runs(readable(landed), runs).withColumn("stat_date", iso_date(F.col("date")))
    latest = _newest(rows, ["media_id_from_path", "stat_date"], [F.desc_nulls_last("ingested_at")])
    day = F.col("stat_date")
    return projected(latest, "media_daily_stats", stat_year=F.year(day), stat_month=F.month(day))


def silver_engagement(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """One engagement curve per media and run, the arrays kept whole."""
    return _per_run("engagement", landed, runs)


def run_events(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """D1 for events: landed rows of successful runs, without the fields silver leaves out."""
    return rows_of_runs(readable(landed).drop("iframe_heatmap_url"), runs)


def current_events(rows: DataFrame) -> DataFrame:
    """The latest landed row of every event."""
    return _newest(rows, ["event_key"], [F.desc_nulls_last("ingested_at")])


def flat_events(rows: DataFrame) -> DataFrame:
    """Landed events flattened; the path names the media where the payload does not."""
    received_at = iso_timestamp(F.col("received_at"))
    media_id = F.coalesce("media_id", "media_id_from_path")
    return projected(rows, "events", media_id=media_id, received_at=received_at, event_date=F.to_date(received_at))


def silver_events(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """C6, F1c."""
    return flat_events(current_events(run_events(landed, runs)))


def silver_visitors(landed: DataFrame, runs: DataFrame) -> DataFrame:
    """C7, F1d: the most recently active version of every visitor."""
    profiles = rows_of_runs(readable(landed), runs, media_in_path=False).withColumn(
        "last_active_at", iso_timestamp(F.col("last_active_at"))
    )
    order = [F.desc_nulls_last("last_active_at"), F.desc_nulls_last("ingested_at")]
    newest = _newest(profiles, ["visitor_key"], order)
    return projected(newest, "visitors", created_at=iso_timestamp(F.col("created_at")))


def quarantine(read: Callable[[str], DataFrame], runs: DataFrame) -> DataFrame:
    """Files of successful runs that do not parse: dataset, run, file and text.

    They take no part in silver, so a broken file never beats a good one.
    """
    found = []
    for name in SILVER_PLANS:
        rows = rows_of_runs(quarantined(read(name)), runs, media_in_path=False)
        found.append(rows.select(F.lit(name).alias("dataset"), "run_id", "ingestion_date", SOURCE, CORRUPT))
    return reduce(DataFrame.unionByName, found)


SILVER_PLANS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "media": silver_media,
    "media_stats": silver_media_stats,
    "media_daily_stats": silver_media_daily_stats,
    "engagement": silver_engagement,
    "events": silver_events,
    "visitors": silver_visitors,
}


def build_silver(read: Callable[[str], DataFrame], runs: DataFrame) -> dict[str, DataFrame]:
    """M1: all six silver tables; ``read`` gives the landed rows of a dataset."""
    return {name: plan(read(name), runs) for name, plan in SILVER_PLANS.items()}


# What makes a row of a silver table newer than another of its key, before the run id.
NEWER = {
    "media": ("updated_at", "ingested_at"),
    "media_stats": (),
    "media_daily_stats": ("ingested_at",),
    "engagement": (),
    "events": ("ingested_at",),
    "visitors": ("last_active_at", "ingested_at"),
}


def with_new_runs(name: str, published: DataFrame, added: DataFrame) -> DataFrame:
    """K5, M1: a published silver table with the rows of new runs, as a full rebuild would give it.

    Both sides hold one row per key already, so at most two rows meet per key.
    """
    contract = SILVER[name]
    both = published.select(*contract.names).unionByName(added)
    return newest_per(both, list(contract.key), [F.desc_nulls_last(c) for c in NEWER[name]], ["run_id"])


# Tables without partitions take new rows as a layer beside their base instead of being written again.
LAYERED = {name: NEWER[name] for name, contract in SILVER.items() if not contract.partitions}


def touched_partitions(name: str, published: DataFrame, added: DataFrame) -> list[tuple]:
    """K5, M1: the partitions that new rows change: those they lie in, and those that hold an older row of their keys.

    Of the published table only the key is read. As many tuples as there are partitions, at most.
    """
    contract = SILVER[name]
    keys = small_side(added.select(*contract.key).distinct())
    older = of_keys(published.select(*{*contract.key, *contract.partitions}), keys, list(contract.key))
    both = added.select(*contract.partitions).union(older.select(*contract.partitions)).distinct()
    return [tuple(r) for r in both.collect()]


def in_partitions(columns: tuple[str, ...], values: list[tuple]) -> Column:
    """A filter on some partitions, NULL ones included, which scans are pruned by."""
    if len(columns) == 1:
        known = F.col(columns[0]).isin([v for v, in values if v is not None])
        return known if all(v is not None for v, in values) else known | F.col(columns[0]).isNull()
    first = {v[0] for v in values}
    parts = [F.col(columns[0]).eqNullSafe(F.lit(x)) & in_partitions(columns[1:], [v[1:] for v in values if v[0] == x]) for x in first]
    return reduce(Column.__or__, parts)


def landing_reader(spark: SparkSession, base: str, ingestion_dates: list[str] | None = None) -> Callable[[str], DataFrame]:
    """Landed rows straight from the JSON files, of some ingestion dates or of all.

    Visitors may be missing (A9); they then give an empty table instead of leaving an older
    one in place (T11).
    """
    return lambda name: read_landed(spark, base, name, ingestion_dates, optional=name == "visitors")
