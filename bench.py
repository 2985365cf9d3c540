"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR picks the data (default sf0.1), BENCH_CPUS the local cores. Landed
rows are written once, outside the timing, so that the numbers are those of the
operators and not of the derivation of test data. Each number is the median of
BENCH_RUNS runs after one warm-up; the builds run once, at the end: one that adds the last run
to a published build, and two of everything.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from reelmart.functions import json_profile  # noqa: E402
from reelmart.operators import incremental, paging, quality  # noqa: E402
from reelmart.plans import gold, pipeline, reports, silver  # noqa: E402
from reelmart.schemas import GOLD, SILVER  # noqa: E402
from reelmart.session import cut_lineage, local_session, scratch_path  # noqa: E402
from reelmart.sinks import builds, tables  # noqa: E402
from workload import queries as workload  # noqa: E402
from workload import testbed  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def written(df: DataFrame, name: str) -> DataFrame:
    """Landed data lies in many files; the given tables are one file each."""
    return cut_lineage(df.repartition(int(CPUS)), name)


def timed(body: Callable[[], None], runs: int = RUNS, warm_up: bool = True) -> float:
    if warm_up:
        body()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        body()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    runs = cut_lineage(testbed.runs(spark, SF_DIR), "bench-runs")
    landed = {
        name: written(rows(spark, SF_DIR), f"bench-landed-{name}") for name, rows in workload.LANDED.items()
    }
    written_silver = {
        name: cut_lineage(plan(landed[name], runs), f"bench-silver-{name}")
        for name, plan in silver.SILVER_PLANS.items()
    }
    fact = cut_lineage(gold.fact_media_engagement(written_silver["media_daily_stats"], written_silver["events"]), "bench-fact")
    fact_event = cut_lineage(gold.fact_engagement_event(written_silver["events"]), "bench-fact-event")
    media = cut_lineage(gold.dim_media(written_silver["media"]), "bench-dim-media")
    windows = cut_lineage(workload.date_windows(spark, SF_DIR), "bench-windows")
    payloads = written(testbed.json_payloads(spark, SF_DIR), "bench-payloads")
    engagement = written(workload.engagement_events(spark, SF_DIR), "bench-engagement")

    def all_silver() -> dict[str, DataFrame]:
        return {name: plan(landed[name], runs) for name, plan in silver.SILVER_PLANS.items()}

    def build_once() -> None:
        """Every table written once with its checks in the same pass."""
        base = scratch_path(spark, "bench-build")
        done = {name: df for name, (df, _) in tables.stage_all(all_silver(), base, SILVER).items()}
        made = gold.build_gold(done)
        dims = tables.stage_all({n: df for n, df in made.items() if n.startswith("dim_")}, base, GOLD)
        known = {name: df for name, (df, _) in dims.items()}
        tables.stage_all({n: df for n, df in made.items() if n not in dims}, base, GOLD, known)

    def build_per_check() -> None:
        """The same build with an action of its own for every check, count and write."""
        base, done, dims = scratch_path(spark, "bench-naive"), {}, {}

        def check_and_write(name: str, df: DataFrame, contract) -> None:
            for column in (*contract.not_blank, *contract.not_null):
                df.filter(df[column].isNull()).limit(1).count()
            quality.check_unique(name, df, contract.key)
            for key, dim, dim_key in contract.foreign_keys:
                quality.check_fk(name, df, key, dims[dim], dim_key)
            df.count()
            tables.write_parquet(df, f"{base}/{name}", contract.partitions)

        for name, df in all_silver().items():
            check_and_write(name, df, SILVER[name])
            done[name] = spark.read.schema(df.schema).parquet(f"{base}/{name}")
        for name, df in gold.build_gold(done).items():
            check_and_write(name, df, GOLD[name])
            dims[name] = df

    last = runs.agg({"ingested_at": "max"}).first()[0]
    layout = workload.fresh_layout(spark)

    def silver_of(some_runs: DataFrame) -> dict[str, DataFrame]:
        return {name: plan(landed[name], some_runs) for name, plan in silver.SILVER_PLANS.items()}

    def published(frames: dict[str, DataFrame], build_id: str) -> builds.Build:
        """One silver build: what ``frames`` change is written, checked and switched to."""
        before = builds.current(spark, layout.silver_db, layout.silver)
        changed, parts, layers = pipeline.changed_tables(spark, layout, before, frames)
        staged = tables.stage_all(changed, f"{layout.silver}/run_id={build_id}", SILVER)
        parts += [p for name, (df, _) in staged.items() for p in builds.written_parts(name, df, SILVER[name], layers[name])]
        return builds.switch(spark, layout.silver_db, layout.silver, build_id, parts, SILVER, silver.LAYERED)

    # all runs but the last one are there before the clock starts
    published(silver_of(runs.filter(runs["ingested_at"] < last)), "first")

    queries = {
        "silver_events_dedup": lambda: drain(silver.silver_events(landed["events"], runs)),
        "silver_media_dedup": lambda: drain(silver.silver_media(landed["media"], runs)),
        "dim_visitor": lambda: drain(gold.dim_visitor(written_silver["visitors"], written_silver["events"])),
        "fact_media_engagement": lambda: drain(
            gold.fact_media_engagement(written_silver["media_daily_stats"], written_silver["events"])
        ),
        "daily_engagement_report": lambda: drain(reports.daily_engagement(fact, media)),
        "engagement_by_country": lambda: drain(reports.engagement_by_country(fact_event)),
        "fk_violations": lambda: drain(quality.fk_violations(fact_event, "media_id", media, "media_id")),
        "duplicate_event_keys": lambda: drain(reports.duplicate_keys(fact_event, ["event_key"])),
        "incremental_events": lambda: drain(incremental.rows_in_windows(engagement, windows, "day")),
        "page_assignment": lambda: drain(paging.assign_pages(engagement, "media_id", ["ts", "event_id"])),
        "json_schema_profile": lambda: drain(json_profile.schema_profile(payloads, "body", ["dataset"])),
        "build_second_run": lambda: published(silver_of(runs.filter(runs["ingested_at"] == last)), "second"),
        "build_single_pass": build_once,
        "build_action_per_check": build_per_check,
    }
    seconds = {
        # the builds run once: by then everything they use is warm
        name: timed(body, 1, warm_up=False) if name.startswith("build") else timed(body)
        for name, body in queries.items()
    }
    total = sum(v for k, v in seconds.items() if k != "build_action_per_check")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
