"""The registered queries: each runs one operator or plan over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.functions import json_profile, scalars
from reelmart.operators import incremental, paging, quality
from reelmart.operators.dedup import newest_per, last_event_of_visitors, snapshot_per
from reelmart.plans import gold, pipeline, reports, silver
from reelmart.schemas import GOLD, SILVER
from reelmart.session import configure, cut_lineage, scratch_path
from reelmart.sinks import landing as landing_sink
from reelmart.sinks import builds, tables
from reelmart.sinks.records import utc_now
from reelmart.sources import control
from reelmart.sources.control import read_watermark_log
from reelmart.sources.landing import (
    CORRUPT, landed_objects, lineage, quarantined, read_audits, read_landed, require_runs, rows_of_runs, successful_runs,
)
from reelmart.streaming import ingest
from workload import testbed

Query = Callable[[SparkSession, str], DataFrame]

PAGE = 20
RUN_DATE, RUN_ID = "2024-01-31", "run-20240131"

LANDED = {
    "media": lambda s, d: testbed.landed_media(s, d, testbed.lines_by_part(s, d)),
    "media_stats": testbed.landed_stats,
    "media_daily_stats": testbed.landed_daily,
    "engagement": testbed.landed_curves,
    "events": testbed.landed_events,
    "visitors": testbed.landed_visitors,
}


def today():
    return F.lit("2024-01-31").cast("date")


def silver_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.SILVER_PLANS[name](LANDED[name](spark, sf_dir), testbed.runs(spark, sf_dir))


def silver_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curves as text, so that any client can compare them."""
    curves = silver_table("engagement", spark, sf_dir)
    text = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("engagement_data", "rewatch_data")}
    return curves.withColumns(text)


def gold_table(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    need = {
        "dim_media": ["media"],
        "dim_visitor": ["visitors", "events"],
        "dim_date": ["media_daily_stats", "events"],
        "fact_engagement_event": ["events"],
        "fact_media_engagement": ["media_daily_stats", "events"],
    }
    return getattr(gold, name)(*[silver_table(s, spark, sf_dir) for s in need[name]])


fact = partial(gold_table, "fact_media_engagement")
fact_event = partial(gold_table, "fact_engagement_event")
dim_media = partial(gold_table, "dim_media")
events = partial(silver_table, "events")


# scans and sinks


def media_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comma-separated list per event, with blanks to drop, and how often each id is named."""
    lists = testbed.events(spark, sf_dir).select(
        F.concat(F.lit(" "), "media_id", F.lit(" ,, m"), F.col("user_id"), F.lit(" , ")).alias("raw")
    )
    return control.media_list(lists, "raw").groupBy("media_id").agg(F.count(F.lit(1)).alias("mentions"))


def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control records, one per media and kind of event, those of errors blank."""
    last = testbed.events(spark, sf_dir).groupBy("media_id", "event_type").agg(F.max("day").alias("day"))
    record = F.format_string('{"events": {"%s": {"last_successful_end_date": "%s"}}}', "media_id", F.col("day").cast("string"))
    records = last.select(F.when(F.col("event_type") == "error", " \n ").otherwise(record).alias("body"))
    return control.watermark_rows(records, "body")


PAYLOAD = [
    "city", "conversion_type", "country", "email", "embed_url", "event_key", "ip", "lat", "lon", "media_id",
    "media_name", "media_url", "org", "percent_viewed", "received_at", "region", "user_agent_details", "visitor_key",
]


def land_engagement(
    spark: SparkSession,
    sf_dir: str,
    base: str | None = None,
    date: str = RUN_DATE,
    run_id: str = RUN_ID,
    percent: float | None = None,
    days: tuple[int, int] | None = None,
) -> str:
    """Land engagement events as JSON pages of one run; returns the landing folder.

    All of them, or, as a run with a date window does, those of the dates between the given
    numbers of days after the first one.
    """
    base = base or scratch_path(spark, "landing")
    seen = F.least("value", F.lit(100.0)) if percent is None else F.lit(percent)
    rows = testbed.event_payload(spark, sf_dir).withColumn("percent_viewed", seen)
    if days:
        first = testbed.events(spark, sf_dir).agg(F.min("day")).first()[0]
        rows = rows.filter(F.col("day").between(*[F.date_add(F.lit(first), n) for n in days]))
    rows = rows.select("path_media", "ts", "event_id", *PAYLOAD)
    pages = paging.page_payloads(
        rows.select("path_media").distinct(), rows, "path_media", PAYLOAD, ["ts", "event_id"]
    ).withColumnRenamed("path_media", "media_id")
    landing_sink.land_pages(pages, base, date, run_id)
    return base


def fresh_layout(spark: SparkSession) -> pipeline.Layout:
    base = scratch_path(spark, "deployment")
    name = base.rsplit("-", 1)[-1]
    parts = {p: f"{base}/{p}" for p in ("landing", "audit", "silver", "gold", "control", "logs")}
    return pipeline.Layout(**parts, silver_db=f"silver_{name}", gold_db=f"gold_{name}")


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion run over all events: landed as files, checked, silver, gold, committed, reported."""
    layout, started = fresh_layout(spark), utc_now()
    for name, documents in testbed.documents(spark, sf_dir).items():
        landing_sink.land_documents(documents, layout.landing, name, RUN_DATE, RUN_ID)
    land_engagement(spark, sf_dir, layout.landing)
    pipeline.check_pages(spark, layout, paging.PER_PAGE)
    keys = paging.visitor_discovery(read_landed(spark, layout.landing, "events"))
    visitors = testbed.visitor_documents(keys, spark, sf_dir)
    landing_sink.land_visitors(visitors, layout.landing, RUN_DATE, RUN_ID)
    windows = incremental.date_windows(media(spark, sf_dir), read_watermark_log(spark, layout.control), today())
    pipeline.record_landing(spark, layout, RUN_ID, RUN_DATE, started, windows)
    pipeline.run(spark, layout)
    gold_views = {name: spark.table(f"{layout.gold_db}.{name}") for name in GOLD}
    committed = read_watermark_log(spark, layout.control)
    report = reports.daily_engagement(gold_views["fact_media_engagement"], gold_views["dim_media"])
    return report.join(committed, "media_id", "left")


def land_run(spark: SparkSession, sf_dir: str, layout: pipeline.Layout, date: str, run_id: str, **events) -> None:
    """One ingestion run: documents and event pages of all media, visitors of its events, the audit record."""
    endpoints = [*testbed.documents(spark, sf_dir), "events", "visitors"]
    for name, documents in testbed.documents(spark, sf_dir).items():
        landing_sink.land_documents(documents, layout.landing, name, date, run_id)
    land_engagement(spark, sf_dir, layout.landing, date, run_id, **events)
    keys = paging.visitor_discovery(read_landed(spark, layout.landing, "events", [date]))
    landing_sink.land_visitors(testbed.visitor_documents(keys, spark, sf_dir), layout.landing, date, run_id)
    windows = incremental.date_windows(media(spark, sf_dir), read_watermark_log(spark, layout.control), F.lit(date).cast("date"))
    manifest = landing_sink.read_manifest(spark, layout.landing, date, run_id, endpoints)
    pipeline.record_landing(spark, layout, run_id, date, f"{date}T02:00:00+00:00", windows, manifest)


def second_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three silver builds; per event what it says, and which build wrote the partition it lies in.

    The first run lands all events, the second those of the sixth date and later, with new
    values. A run before both, of the first two dates, is approved last: its partitions are
    written again, its values are older and must not win.
    """
    layout, written = fresh_layout(spark), {}
    landings = [
        ("2024-01-30", "run-20240130", {"percent": 0.0}),
        ("2024-01-31", "run-20240131", {"days": (5, 100_000)}),
        ("2024-01-29", "run-20240129", {"percent": 1.0, "days": (0, 1)}),
    ]
    for number, (date, run_id, events) in enumerate(landings, 1):
        land_run(spark, sf_dir, layout, date, run_id, **events)
        written[pipeline.run_silver(spark, layout)["run_id"]] = number
    build = builds.current(spark, layout.silver_db, layout.silver)
    folder = [(dict(p.spec)["event_date"], next(n for run, n in written.items() if run in p.path)) for p in build.of("events")]
    by_build = spark.createDataFrame(folder, "day string, build int")
    rows = spark.table(f"{layout.silver_db}.events").select(*STREAMED, "run_id")
    return rows.join(by_build, F.col("event_date").cast("string").eqNullSafe(F.col("day"))).drop("day")


def landing_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit record of a landed run, a row per media and endpoint beside its totals."""
    layout = fresh_layout(spark)
    land_run(spark, sf_dir, layout, RUN_DATE, RUN_ID)
    record = read_audits(spark, layout.audit)
    totals = ["run_id", "status", "media_count", "bronze_object_count", "visitor_objects_written"]
    ends = F.col("candidate_watermark.events")
    per_endpoint = record.select(*[F.col(c) for c in totals], ends.alias("ends"), F.inline("endpoint_audit").alias(
        "media_id", "endpoint", "start_date", "end_date", "pages_fetched", "records_fetched", "objects", "endpoint_status"))
    return per_endpoint.withColumn("candidate_end", F.col("ends")[F.col("media_id")]["last_successful_end_date"]).drop("ends")


def commit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all stages of one run up to the commit: what each names and counts."""
    layout = fresh_layout(spark)
    land_run(spark, sf_dir, layout, RUN_DATE, RUN_ID)
    pipeline.run(spark, layout)
    stages = read_audits(spark, layout.audit)
    gold_id = stages.filter("pipeline_stage = 'GOLD_TRANSFORMATION'").select(F.col("run_id").alias("_gold")).first()[0]
    return stages.select(
        "pipeline_stage", "status", "media_count", "committed_media",
        F.array_join("bronze_run_ids", ",").alias("bronze_run_ids"),
        (F.col("gold_run_id") == gold_id).alias("names_gold"),
        F.when(F.col("audit_keys").isNotNull(), F.size("audit_keys")).alias("decided_on"),
        F.col("row_counts")["events"].alias("events"),
        F.col("row_counts")["fact_engagement_event"].alias("fact_events"),
    )


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a published gold database that its readers use."""
    layout = fresh_layout(spark)
    need = ("media", "media_daily_stats", "events", "visitors")
    frames = gold.build_gold({name: silver_table(name, spark, sf_dir) for name in need})
    staged = tables.stage_all({name: df for name, df in frames.items() if name.startswith("dim_")}, f"{layout.gold}/run_id=1", GOLD)
    contracts = {name: GOLD[name] for name in staged}
    parts = [p for name, (df, _) in staged.items() for p in builds.written_parts(name, df, contracts[name])]
    builds.switch(spark, layout.gold_db, layout.gold, "1", parts, contracts)
    counted = [spark.table(f"{layout.gold_db}.{name}").agg(F.lit(name).alias("tableName"), F.count(F.lit(1)).alias("rows")) for name in contracts]
    listed = tables.list_tables(spark, layout.gold_db)
    return listed.join(reduce(DataFrame.unionByName, counted), "tableName")


def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint audit from the landed files themselves."""
    layout = fresh_layout(spark)
    for name, documents in testbed.documents(spark, sf_dir).items():
        landing_sink.land_documents(documents, layout.landing, name, RUN_DATE, RUN_ID)
    land_engagement(spark, sf_dir, layout.landing)
    return pipeline.landing_audit(spark, layout)


def bronze_events_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = land_engagement(spark, sf_dir)
    rows = silver.run_events(read_landed(spark, base, "events"), testbed.runs(spark, sf_dir))
    return silver.flat_events(rows).select(
        "event_key", "media_id", "visitor_key", "received_at", "percent_viewed", "browser", "is_mobile", "run_id"
    )


def landed_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed page files, those without rows included."""
    files = landed_objects(spark, land_engagement(spark, sf_dir), "events")
    return files.select("media_id", "run_id", "ingestion_date", "page", "records")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    contract = GOLD["fact_media_engagement"]
    tables.write_parquet(fact(spark, sf_dir), path, contract.partitions)
    return spark.read.schema(contract.schema).parquet(path).select(*contract.names)


def written_fact_event(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "fact_engagement_event")
    tables.write_parquet(fact_event(spark, sf_dir), path, GOLD["fact_engagement_event"].partitions)
    return path


def partition_prune_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per date; the folder of events without a date is not read at all."""
    written = spark.read.parquet(written_fact_event(spark, sf_dir))
    dated = written.filter(F.col("event_date").isNotNull())
    return dated.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_fact_event(spark, sf_dir)
    database = "reelmart_gold"
    tables.register(spark, database, "fact_engagement_event", path, GOLD["fact_engagement_event"])
    return tables.list_partitions(spark, database, "fact_engagement_event")


def run_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage all silver tables with their checks; the counts come from the writes."""
    frames = {name: silver_table(name, spark, sf_dir) for name in SILVER}
    staged = tables.stage_all(frames, scratch_path(spark, "silver"), SILVER)
    counts = [(name, metrics["rows"]) for name, (_, metrics) in staged.items()]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


# lineage and deduplication


def lineage_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage(testbed.landed_events(spark, sf_dir)).select(
        "event_key", "ingestion_date", "run_id", "media_id_from_path"
    )


def successful_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of_runs(testbed.landed_events(spark, sf_dir), testbed.runs(spark, sf_dir))
    return rows.groupBy("run_id", "ingested_at").agg(F.count(F.lit(1)).alias("landed_rows"))


def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testbed.table(spark, sf_dir, "orders")
    return newest_per(orders, ["o_custkey"], [F.desc_nulls_last("o_orderdate")], ["o_orderkey"])


def snapshot_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testbed.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return snapshot_per(orders, ["o_custkey", "o_orderdate"])


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole row of the newest event, so that ties show."""
    columns = ["visitor_key", "received_at", "ip_address", "country", "region", "city"]
    return last_event_of_visitors(events(spark, sf_dir).select(*columns))


def required_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_runs(testbed.runs(spark, sf_dir)).select("run_id")


def missing_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per dataset of a landing without a visitors folder, which counts as an empty one."""
    base = land_engagement(spark, sf_dir)
    counts = [read_landed(spark, base, name, optional=True).agg(
        F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("landed_rows")) for name in ("events", "visitors")]
    return counts[0].unionByName(counts[1])


def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all media, landed broken off where the number of views is odd."""
    days = testbed.media_days(spark, sf_dir)
    totals = days.groupBy("media_id").agg(F.sum("views").alias("views"), F.sum("clicks").alias("clicks"))
    text = F.concat(F.lit('{"load_count":'), "views", F.lit(',"play_count":'), "clicks")
    body = F.when(F.col("views") % 2 == 0, F.concat(text, F.lit("}"))).otherwise(text)
    base = scratch_path(spark, "landing")
    landing_sink.land_documents(totals.select("media_id", body.alias("body")), base, "media_stats", RUN_DATE, RUN_ID)
    broken = rows_of_runs(quarantined(read_landed(spark, base, "media_stats")), testbed.runs(spark, sf_dir))
    return broken.select(F.col("media_id_from_path").alias("media_id"), "run_id", F.rtrim(F.translate(CORRUPT, "\n", " ")).alias("body"))


def overlap_idempotence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing everything a second time changes nothing."""
    rows = silver.run_events(testbed.landed_events(spark, sf_dir), testbed.runs(spark, sf_dir))
    return silver.flat_events(silver.current_events(rows.unionByName(rows)))


STREAMED = ["event_key", "media_id", "visitor_key", "received_at", "percent_viewed", "event_date"]


def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = land_engagement(spark, sf_dir)
    log = scratch_path(spark, "event-log")
    ingest.append_landed(ingest.landed_stream(spark, base, "events"), log, f"{log}-checkpoint").awaitTermination()
    return silver.silver_events(spark.read.parquet(log), testbed.runs(spark, sf_dir)).select(*STREAMED)


def stream_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping runs, the later one approved first; the earlier one must not win afterwards."""
    base, work = land_engagement(spark, sf_dir), scratch_path(spark, "event-merge")
    land_engagement(spark, sf_dir, base, "2024-01-30", "run-20240130", percent=0.0)
    log = f"{work}/log"
    ingest.append_landed(ingest.landed_stream(spark, base, "events"), log, f"{log}-checkpoint").awaitTermination()
    runs = testbed.runs(spark, sf_dir)
    key, newest = ["event_key"], [F.desc_nulls_last("ingested_at")]
    for approved in (runs.filter(F.col("run_id") == RUN_ID), runs):
        # both runs hold all events, so a share above 1 leaves the second one a layer
        ingest.merge_runs(spark.read.parquet(log), approved, f"{work}/table", f"{work}/merges", key, newest, fold_share=2.0)
    return silver.flat_events(ingest.merged_rows(spark, f"{work}/table", key, newest)).select(*STREAMED)


# reports and checks


def gold_table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all gold tables, built from silver tables that are written once."""
    need = ("media", "media_daily_stats", "events", "visitors")
    written = {name: cut_lineage(silver_table(name, spark, sf_dir), f"silver-{name}") for name in need}
    return reports.table_row_counts(gold.build_gold(written))


def orphan_media_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.event_daily(testbed.unchecked_events(spark, sf_dir))
    return reports.orphan_rows(daily, "media_id", dim_media(spark, sf_dir), "media_id", "orphan_media_rows")


def orphan_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testbed.unchecked_events(spark, sf_dir)
    return reports.orphan_rows(rows, "media_id", dim_media(spark, sf_dir), "media_id", "orphan_event_media_rows")


def duplicate_daily_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of_runs(testbed.landed_daily(spark, sf_dir), testbed.runs(spark, sf_dir)).select(
        F.col("media_id_from_path").alias("media_id"), scalars.iso_date(F.col("date")).alias("stat_date")
    )
    return reports.duplicate_keys(rows, ["media_id", "stat_date"])


def blank_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.unchecked_events(spark, sf_dir).filter(scalars.is_blank(F.col("event_key")))


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testbed.unchecked_events(spark, sf_dir)
    return quality.fk_violations(rows, "media_id", dim_media(spark, sf_dir), "media_id")


# pages


def engagement_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = testbed.events(spark, sf_dir)
    return made.select(F.concat(F.lit("e"), "event_id").alias("event_key"), "event_id", "media_id", "day", "ts")


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.events(spark, sf_dir).select("media_id").distinct()


def page_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paged = paging.assign_pages(engagement_events(spark, sf_dir), "media_id", ["ts", "event_id"], PAGE)
    return paged.select("media_id", "event_key", scalars.page_name(F.col("page")).alias("page"))


def page_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = engagement_events(spark, sf_dir)
    return paging.page_spine(media(spark, sf_dir), rows, "media_id", ["ts", "event_id"], PAGE)


def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as landed, which are whole, and days taken for pages, which are not."""
    landed = page_spine(spark, sf_dir).select(F.lit("landed").alias("source"), "media_id", "page", "records")
    by_day = (
        testbed.events(spark, sf_dir)
        .groupBy(F.lit("by day").alias("source"), "media_id", F.dayofmonth("day").cast("long").alias("page"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return paging.page_completeness(landed.unionByName(by_day), ["source", "media_id"], PAGE)


def endpoint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = media(spark, sf_dir)
    singles = listed.select(
        "media_id",
        F.explode(F.array(*[F.lit(e) for e in ("media", "media_stats", "engagement")])).alias("endpoint"),
        F.lit(1).cast("long").alias("records"),
    )
    daily = testbed.events(spark, sf_dir).groupBy("media_id").agg(F.count_distinct("day").alias("records"))
    pages = page_spine(spark, sf_dir)
    objects = (
        pages.select("media_id", F.lit("events").alias("endpoint"), "records")
        .unionByName(singles)
        .unionByName(daily.withColumn("endpoint", F.lit("media_daily_stats")))
    )
    return paging.endpoint_audit(objects, ["media_id"], date_windows(spark, sf_dir))


# incremental state


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per media the last day with a value above 250, over all events; a media without one has no state yet."""
    last = F.max(F.when(F.col("value") > 250, F.col("day"))).alias("last_successful_end_date")
    return testbed.events(spark, sf_dir).groupBy("media_id").agg(last).filter("last_successful_end_date IS NOT NULL")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.when(F.col("value") > 200, F.col("day"))).alias("last_successful_end_date")
    return testbed.events(spark, sf_dir).groupBy("media_id").agg(first).filter("last_successful_end_date IS NOT NULL")


def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.date_windows(
        media(spark, sf_dir), watermarks(spark, sf_dir), today(), initial_lookback_days=7, overlap_days=2
    )


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = engagement_events(spark, sf_dir).select("event_key", "media_id", "day")
    return incremental.rows_in_windows(rows, date_windows(spark, sf_dir), "day")


def watermark_merge(spark: SparkSession, sf_dir: str, monotonic: bool = False) -> DataFrame:
    return incremental.merge_watermarks(watermarks(spark, sf_dir), candidates(spark, sf_dir), monotonic)


def latest_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit records, one per day and kind of event, which stands for the stage."""
    kind = F.col("event_type")
    audits = testbed.events(spark, sf_dir).groupBy("event_type", "day").agg(
        F.max("ts").alias("end"), F.count_distinct("media_id").alias("candidates")
    ).select(
        F.when(kind == "click", "BRONZE_INGESTION").when(kind == "purchase", "GOLD_TRANSFORMATION")
        .otherwise(F.upper(kind)).alias("pipeline_stage"),
        testbed.run_id_of(F.col("day")).alias("run_id"),
        testbed.run_status(F.col("day")).alias("status"),
        testbed.iso(F.col("end")).alias("end_ts"),
        "candidates",
    )
    return incremental.latest_success(
        audits, ["run_id", "end_ts", "candidates"], scalars.iso_timestamp(F.col("end_ts"))
    )


def latest_success_per_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_stages(spark, sf_dir).select(
        "pipeline_stage", "run_id", scalars.iso_timestamp(F.col("end_ts")).alias("end_ts")
    )


def commit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.commit_gate(latest_stages(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"))


# scalar functions


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testbed.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("event_date"))
    none = days.select(F.lit(None).cast("date").alias("stat_date"))
    return gold.dim_date(none, days).select(
        F.col("full_date").alias("day"), "date_key", "year", "quarter", "month", "day_name", "week_of_year"
    )


def pseudonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = testbed.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", scalars.pseudonym(F.col("c_name")).alias("pseudonym"))


def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.landed_media(spark, sf_dir).select(
        F.col("id").alias("numeric_id"),
        F.col("folder.id").alias("folder_id"),
        F.col("folder.name").alias("folder_name"),
        F.col("thumbnail.url").alias("thumbnail_url"),
        scalars.asset_count(F.col("assets")).alias("asset_count"),
        F.to_json("assets").alias("assets_json"),
    )


def scalar_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testbed.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    said = F.when(kind == "click", " YES ").when(kind == "view", "y").when(kind == "error", "").otherwise("off")
    number = F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string"))
    label = F.when(F.col("value") < 50, F.concat(F.lit("m"), F.get_json_object("props", "$.k")))
    return rows.select(
        "event_id",
        scalars.flag(said).alias("yes"),
        number.try_cast("double").alias("number"),
        F.coalesce(label, F.lit("UNKNOWN")).alias("label"),
        scalars.age_hours(F.lit("2024-02-01").cast("timestamp"), F.col("ts").cast("timestamp")).alias("age"),
        scalars.short_text(F.col("props"), 4).alias("short_text"),
    )


# JSON profiling


def json_find_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Names under which a visitor key may appear.
    names = ["visitor_key", "visitorkey", "visitorid", "visitor_id"]
    payloads = testbed.json_payloads(spark, sf_dir)
    return payloads.select("event_id", json_profile.find_first(F.col("body"), names).alias("first_value"))


def json_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = testbed.json_payloads(spark, sf_dir)
    return payloads.select("event_id", json_profile.record_count(F.col("body")).alias("records"))


QUERIES: dict[str, Query] = {
    "audit_success_runs": lambda s, d: successful_runs(testbed.audits(s, d)),
    "media_id_list": media_id_list,
    "watermark_state": watermark_state,
    "bronze_events_scan": bronze_events_scan,
    "landed_page_files": landed_page_files,
    "parquet_roundtrip": parquet_roundtrip,
    "partition_prune_read": partition_prune_read,
    "catalog_partitions": catalog_partitions,
    "run_audit_counts": run_audit_counts,
    "landing_audit": landing_audit,
    "landing_record": landing_record,
    "commit_record": commit_record,
    "second_build": second_build,
    "catalog_tables": catalog_tables,
    "end_to_end": end_to_end,
    "lineage_from_path": lineage_from_path,
    "successful_run_rows": successful_run_rows,
    "silver_media": partial(silver_table, "media"),
    "silver_media_stats": partial(silver_table, "media_stats"),
    "silver_media_daily": partial(silver_table, "media_daily_stats"),
    "silver_engagement": silver_engagement,
    "silver_events": events,
    "silver_visitors": partial(silver_table, "visitors"),
    "latest_by": latest_order,
    "snapshot_per_run": snapshot_per_run,
    "latest_event_per_visitor": latest_event,
    "overlap_idempotence": overlap_idempotence,
    "stream_append_events": stream_append_events,
    "stream_merge_events": stream_merge_events,
    "dim_media": dim_media,
    "dim_visitor": partial(gold_table, "dim_visitor"),
    "dim_visitor_from_events": lambda s, d: gold.dim_visitor_from_events(events(s, d)),
    "required_runs": required_runs,
    "missing_visitors": missing_visitors,
    "quarantined_files": quarantined_files,
    "dim_date": partial(gold_table, "dim_date"),
    "event_daily": lambda s, d: gold.event_daily(events(s, d)),
    "fact_engagement_event": fact_event,
    "fact_media_engagement": fact,
    "gold_table_row_counts": gold_table_row_counts,
    "media_listing": lambda s, d: reports.media_listing(dim_media(s, d)),
    "daily_engagement_report": lambda s, d: reports.daily_engagement(fact(s, d), dim_media(s, d)),
    "engagement_by_country": lambda s, d: reports.engagement_by_country(fact_event(s, d)),
    "orphan_media_rows": orphan_media_rows,
    "orphan_event_rows": orphan_event_rows,
    "duplicate_daily_keys": duplicate_daily_keys,
    "duplicate_event_keys": lambda s, d: reports.duplicate_keys(testbed.unchecked_events(s, d), ["event_key"]),
    "date_dim_check": lambda s, d: reports.date_check(fact(s, d), gold_table("dim_date", s, d)),
    "media_kpis": lambda s, d: reports.media_kpis(fact(s, d), dim_media(s, d)),
    "plays_over_time": lambda s, d: reports.plays_over_time(fact(s, d)),
    "overall_kpis": lambda s, d: reports.overall_kpis(fact(s, d)),
    "blank_key_rows": blank_key_rows,
    "dq_null_keys": lambda s, d: quality.null_key_report(testbed.unchecked_events(s, d), SILVER["events"]),
    "dq_duplicates": lambda s, d: quality.duplicate_report(testbed.unchecked_events(s, d), ["event_key"]),
    "fk_violations": fk_violations,
    "contract_check": lambda s, d: quality.contract_check(testbed.unchecked_events(s, d), SILVER["events"]),
    "pii_safe_events": lambda s, d: quality.pii_safe(events(s, d), SILVER["events"]),
    "page_assignment": page_assignment,
    "page_spine": page_spine,
    "page_completeness": page_completeness,
    "endpoint_audit": endpoint_audit,
    "visitor_discovery": lambda s, d: paging.visitor_discovery(testbed.landed_events(s, d)),
    "date_windows": date_windows,
    "incremental_events": incremental_events,
    "watermark_merge": watermark_merge,
    "watermark_merge_monotonic": partial(watermark_merge, monotonic=True),
    "latest_success_per_stage": latest_success_per_stage,
    "commit_gate": commit_gate,
    "date_parts": date_parts,
    "pseudonymize": pseudonymize,
    "nested_flatten": nested_flatten,
    "scalar_cleanup": scalar_cleanup,
    "json_schema_profile": lambda s, d: json_profile.schema_profile(testbed.json_payloads(s, d), "body", ["dataset"]),
    "json_record_count": json_record_count,
    "json_find_first": json_find_first,
    "json_endpoint_report": lambda s, d: json_profile.endpoint_report(testbed.json_payloads(s, d), "body", ["dataset"]),
}


def queries() -> dict[str, Query]:
    def with_settings(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    return {name: with_settings(query) for name, query in QUERIES.items()}
