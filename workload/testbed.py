"""Landed payloads derived from the given tables, every row of them.

Each function returns rows as ``sources.landing.read_landed`` would: payload
fields plus the source file. ``workload.oracles`` derives the same in SQL.

* events: all five types. The run of day D lands the dates D - 1 and D, so
  each event is landed twice, the second time with a value one higher. Sunday
  runs fail and their rows must vanish.
* daily stats, cumulative stats and curves: events per media and date.
* media versions: one per ``lineitem`` row; visitor versions: one per ``orders`` row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.functions.scalars import steady_mean, steady_sum
from reelmart.session import configure
from reelmart.sources.landing import SOURCE, successful_runs

CURVE_BINS = 10
# Lines that one task makes media versions of: a version is some fifty times as wide as its line in the
# file, so tasks sized by the file's bytes would sort more than their memory holds.
LINES_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ts: Column) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def run_id_of(day: Column) -> Column:
    return F.concat(F.lit("run-"), F.replace(day.cast("string"), F.lit("-")))


def run_status(day: Column) -> Column:
    return F.when(F.dayofweek(day) == 1, "FAILED").otherwise("SUCCESS")


def path_of(dataset: str, run_date: Column, media_id: Column | None, name: Column) -> Column:
    parts = [F.lit(f"bronze/{dataset}/ingestion_date="), run_date.cast("string"), F.lit("/run_id="), run_id_of(run_date)]
    if media_id is not None:
        parts += [F.lit("/media_id="), media_id]
    return F.concat(*parts, F.lit("/"), name)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with its domain names; ts is read without a zone and is UTC."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("day"),
        "user_id",
        "event_type",
        "value",
        k.alias("k"),
        F.concat(F.lit("m"), k).alias("media_id"),
    )


def landed_twice(df: DataFrame) -> DataFrame:
    """Each row once per run that covers its day: the day's own run and the next."""
    return df.withColumn("lag", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "run_date", F.date_add("day", F.col("lag"))
    )


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit record per ingestion run: the days with events and the day after the last."""
    days = landed_twice(events(spark, sf_dir).select("day").distinct()).select("run_date").distinct()
    start = F.col("run_date").cast("timestamp") + F.expr("INTERVAL 26 HOURS")
    return days.select(
        run_id_of(F.col("run_date")).alias("run_id"),
        F.lit("BRONZE_INGESTION").alias("pipeline_stage"),
        run_status(F.col("run_date")).alias("status"),
        iso(start).alias("start_ts"),
        iso(start + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"),
        "run_date",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return successful_runs(audits(spark, sf_dir))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def agent(browser: Column, version: Column, mobile: Column, platform: Column) -> Column:
    return F.struct(
        browser.alias("browser"), version.alias("browser_version"), mobile.alias("mobile"), platform.alias("platform")
    )


def event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement events with the payload fields of a landed event, one row per event."""
    made = events(spark, sf_dir)
    who = people(spark, sf_dir)
    purchase = F.col("event_type") == "purchase"
    return made.join(who, F.col("user_id") == F.col("c_custkey")).select(
        "event_id",
        "day",
        "ts",
        "value",
        F.col("media_id").alias("path_media"),
        F.col("c_mktsegment").alias("city"),
        F.when(purchase, "purchase").alias("conversion_type"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("n_name")).alias("country"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("https://example.com/embed/"), F.col("k")).alias("embed_url"),
        F.concat(F.lit("e"), F.col("event_id")).alias("event_key"),
        F.lit(None).cast("string").alias("iframe_heatmap_url"),
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("ip"),
        F.col("c_nationkey").cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"),
        # the payload of a purchase names no media; the path does
        F.when(~purchase, F.col("media_id")).alias("media_id"),
        F.concat(F.lit("Media "), F.col("k")).alias("media_name"),
        F.concat(F.lit("https://example.com/media/"), F.col("k")).alias("media_url"),
        F.col("c_mktsegment").alias("org"),
        F.when(purchase & (F.col("value") > 300), "not-a-time").otherwise(iso(F.col("ts"))).alias("received_at"),
        F.col("r_name").alias("region"),
        agent(F.col("event_type"), F.col("k"), F.col("value") > 50, F.col("r_name")).alias("user_agent_details"),
        F.when(F.col("value") < 200, F.concat(F.lit("v"), F.col("user_id"))).alias("visitor_key"),
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed_twice(event_payload(spark, sf_dir))
    name = F.lit("page=000001.json")
    return (
        rows.withColumn("percent_viewed", F.least(F.col("value") + F.col("lag"), F.lit(100.0)))
        .withColumn(SOURCE, path_of("events", F.col("run_date"), F.col("path_media"), name))
        .drop("event_id", "day", "ts", "value", "path_media", "lag", "run_date")
    )


def media_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all events per media and date."""
    kind = F.col("event_type")
    return events(spark, sf_dir).groupBy("media_id", "day").agg(
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "purchase").alias("buys"),
        F.count_distinct("user_id").alias("users"),
        steady_sum(F.col("value")).alias("total"),
        steady_mean(F.col("value")).alias("mean"),
    )


def landed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed_twice(media_days(spark, sf_dir))
    return rows.select(
        F.col("day").cast("string").alias("date"),
        (F.col("total") / 3600.0).alias("hours_watched"),
        # no clicks: loads unknown; three views: plays unknown
        F.when(F.col("clicks") > 0, F.col("views") + F.col("lag") * F.col("clicks")).alias("load_count"),
        F.when(F.col("views") != 3, F.col("clicks")).alias("play_count"),
        path_of("media_daily_stats", F.col("run_date"), F.col("media_id"), F.lit("media_daily_stats.json")).alias(SOURCE),
    )


def landed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files per media and run, named by day, of which one snapshot survives."""
    rows = landed_twice(media_days(spark, sf_dir))
    name = F.concat(F.lit("media_stats-"), F.col("day").cast("string"), F.lit(".json"))
    return rows.select(
        F.col("mean").alias("engagement"),
        (F.col("total") / 3600.0).alias("hours_watched"),
        F.col("views").alias("load_count"),
        F.col("clicks").alias("play_count"),
        F.when(F.col("views") > 0, F.col("clicks") / F.col("views")).alias("play_rate"),
        F.col("users").alias("visitors"),
        path_of("media_stats", F.col("run_date"), F.col("media_id"), name).alias(SOURCE),
    )


def landed_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curves of ten counts each: events per tenth of the value scale, the last one open."""
    rows = events(spark, sf_dir)
    tenth = F.least(F.floor(F.col("value") / 10), F.lit(CURVE_BINS - 1))
    bins = range(CURVE_BINS)
    counts = rows.groupBy("media_id", "day").agg(
        steady_mean(F.col("value")).alias("engagement"),
        F.array(*[F.count_if(tenth == b) for b in bins]).alias("engagement_data"),
        F.array(*[F.count_if((tenth == b) & (F.col("event_type") == "view")) for b in bins]).alias("rewatch_data"),
    )
    name = F.concat(F.lit("engagement-"), F.col("day").cast("string"), F.lit(".json"))
    return landed_twice(counts).select(
        "engagement",
        "engagement_data",
        "rewatch_data",
        path_of("engagement", F.col("run_date"), F.col("media_id"), name).alias(SOURCE),
    )


def lines_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items dealt by part to tasks of similar size, however many there are; all lines of a part in one."""
    line = table(spark, sf_dir, "lineitem")
    return line.repartition(max(1, -(-line.count() // LINES_PER_TASK)), "l_partkey")


def landed_media(spark: SparkSession, sf_dir: str, line: DataFrame | None = None) -> DataFrame:
    """One media version per line item; the sixth line of an order lands in the run that fails."""
    line = table(spark, sf_dir, "lineitem") if line is None else line
    part = table(spark, sf_dir, "part")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "run_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("l_linenumber"))
    )
    size = F.col("p_size").cast("long")
    asset = F.struct(
        F.lit("video/mp4").alias("content_type"),
        F.col("l_quantity").cast("long").alias("file_size"),
        size.alias("height"),
        F.lit("original").alias("type"),
        F.concat(F.lit("https://example.com/a/"), F.col("l_orderkey")).alias("url"),
        size.alias("width"),
    )
    name = F.concat_ws(
        "-", F.lit("media"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_quantity").cast("long")
    )
    flag = F.col("l_returnflag")
    return rows.select(
        (flag == "R").alias("archived"),
        F.when(flag == "A", F.array(asset)).when(flag == "R", F.slice(F.array(asset), 1, 0)).alias("assets"),
        F.concat(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).cast("string"), F.lit("T00:00:00Z")).alias("created"),
        F.col("p_brand").alias("description"),
        (F.col("p_size") * 60.0).alias("duration"),
        F.struct(
            F.concat(F.lit("f"), F.col("l_suppkey")).alias("hashed_id"),
            F.col("l_suppkey").alias("id"),
            F.col("p_brand").alias("name"),
        ).alias("folder"),
        F.concat(F.lit("h"), F.col("l_partkey")).alias("hashed_id"),
        F.col("l_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("l_discount").alias("progress"),
        F.lit(None).cast("boolean").alias("protected"),
        F.lit(None).cast("string").alias("section"),
        F.col("l_linestatus").alias("status"),
        F.struct(
            size.alias("height"),
            F.concat(F.lit("https://example.com/t/"), F.col("l_partkey")).alias("url"),
            size.alias("width"),
        ).alias("thumbnail"),
        F.col("p_type").alias("type"),
        # untaxed lines: time of update unknown, sorts last
        F.when(F.col("l_tax") > 0, iso(F.col("l_shipdate"))).alias("updated"),
        path_of("media", F.col("run_date"), F.concat(F.lit("m"), F.col("l_partkey")),
                F.concat(name, F.lit(".json"))).alias(SOURCE),
    )


def landed_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visitor version per order; the text of its priority picks the run, one of which fails."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.join(people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "run_date", F.date_add(F.lit("2024-01-01").cast("date"), F.length("o_orderpriority"))
    )
    key = F.concat(F.lit("v"), F.col("o_custkey"))
    name = F.concat(F.lit("visitor="), F.substring(F.sha2(key, 256), 1, 24), F.lit(".json"))
    return rows.select(
        F.concat(F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_nationkey")).cast("string"), F.lit("T00:00:00Z")).alias("created_at"),
        iso(F.col("o_orderdate")).alias("last_active_at"),
        F.concat(F.lit("o"), F.col("o_orderkey")).alias("last_event_key"),
        F.floor("o_totalprice").cast("long").alias("load_count"),
        F.length("o_orderpriority").cast("long").alias("play_count"),
        agent(F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderstatus") == "F", F.col("r_name")).alias(
            "user_agent_details"
        ),
        F.struct(
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("name"),
            F.struct(F.col("c_mktsegment").alias("name"), F.col("o_orderstatus").alias("title")).alias("org"),
        ).alias("visitor_identity"),
        key.alias("visitor_key"),
        path_of("visitors", F.col("run_date"), None, name).alias(SOURCE),
    )


def unchecked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as an event table nobody checked: signups repeat keys, errors have
    blank keys, unknown media and unknown visitors."""
    kind, value = F.col("event_type"), F.col("value")
    error = kind == "error"
    return events(spark, sf_dir).select(
        F.when(error & (value < 5), F.lit(None))
        .when(error & (value < 10), F.lit("  "))
        .when(kind == "signup", F.concat(F.lit("s"), F.floor(F.col("event_id") / 2)))
        .otherwise(F.concat(F.lit("e"), F.col("event_id"))).alias("event_key"),
        F.when(error & (value > 150), F.lit(None))
        .when(error & (value > 100), F.concat(F.lit("x"), F.col("k")))
        .otherwise(F.col("media_id")).alias("media_id"),
        F.when(~(error & value.between(20, 40)), F.concat(F.lit("v"), F.col("user_id"))).alias("visitor_key"),
        F.col("ts").alias("received_at"),
        F.col("day").alias("event_date"),
        F.least(value, F.lit(100.0)).alias("percent_viewed"),
    )


def json_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per event, differing in shape by event type."""
    rows = events(spark, sf_dir)
    kind = F.col("event_type")
    person = F.struct(
        F.col("user_id").alias("id"), F.concat(F.lit("v"), F.col("user_id")).alias("visitor_key")
    )
    record = F.struct(
        F.col("event_id").alias("id"),
        F.col("value").alias("value"),
        F.lit(None).cast("string").alias("note"),
        person.alias("visitor"),
    )
    keep = {"ignoreNullFields": "false"}
    body = (
        F.when(kind == "click", F.to_json(F.struct(F.array(record, record).alias("events")), keep))
        .when(kind == "purchase", F.to_json(F.array(record), keep))
        .when(kind == "view", F.to_json(F.struct(F.struct(F.struct(person.alias("p")).alias("q")).alias("r")), keep))
        .when(kind == "signup", F.lit("[]"))
        .otherwise(F.to_json(F.struct((F.col("value") > 50).alias("late"), F.lit("").alias("visitor_key")), keep))
    )
    return rows.select("event_id", kind.alias("dataset"), body.alias("body"))


def documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """JSON documents as one ingestion run would fetch them, per dataset: (media_id, body)."""
    media = events(spark, sf_dir).select("media_id", F.col("k").cast("long").alias("k")).distinct()
    part = table(spark, sf_dir, "part")
    days = media_days(spark, sf_dir)
    day = F.struct(
        F.col("day").cast("string").alias("date"),
        (F.col("total") / 3600.0).alias("hours_watched"),
        F.col("views").alias("load_count"),
        F.col("clicks").alias("play_count"),
    )
    total = F.struct(F.sum("views").alias("load_count"), F.sum("clicks").alias("play_count"))
    curve = F.struct(F.array(F.sum("views"), F.sum("clicks"), F.sum("buys")).alias("engagement_data"))
    version = F.struct(F.col("k").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("type"))
    per_media = days.groupBy("media_id")
    return {
        "media": media.join(part, F.col("k") == F.col("p_partkey")).select("media_id", F.to_json(version).alias("body")),
        "media_stats": per_media.agg(F.to_json(total).alias("body")),
        # one element per date of the window
        "media_daily_stats": per_media.agg(F.to_json(F.array_sort(F.collect_list(day))).alias("body")),
        "engagement": per_media.agg(F.to_json(curve).alias("body")),
    }


def visitor_documents(keys: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of every discovered visitor: (visitor_key, body)."""
    who = people(spark, sf_dir).withColumn("visitor_key", F.concat(F.lit("v"), "c_custkey")).join(keys, "visitor_key")
    profile = F.struct(
        "visitor_key", F.struct(F.col("c_name").alias("name")).alias("visitor_identity"), F.lit(1).alias("play_count")
    )
    return who.select("visitor_key", F.to_json(profile).alias("body"))
