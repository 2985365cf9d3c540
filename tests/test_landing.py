"""Files on disk: scans, lineage, broken files, isolation of runs."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reelmart.plans.silver import build_silver, landing_reader, silver_events, silver_media, silver_media_daily_stats
from reelmart.sources.landing import (
    quarantined, read_audits, read_landed, require_runs, successful_runs,
)
from tests.conftest import rows

RUNS = [("r1", datetime(2026, 1, 2)), ("r2", datetime(2026, 1, 3))]


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(RUNS, "run_id string, ingested_at timestamp")


def put(base, path, payload):
    file = base / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(payload if isinstance(payload, str) else json.dumps(payload))


def event(key, **fields):
    return {"event_key": key, "received_at": "2026-01-01T10:00:00Z", **fields}


def test_events_from_pages(spark, tmp_path, runs):
    at = "events/ingestion_date=2026-01-0{}/run_id={}/media_id={}/page={:06d}.json"
    put(tmp_path, at.format(1, "r1", "007", 1), [event("a", percent_viewed=1), event("b", media_id="other")])
    put(tmp_path, at.format(1, "r1", "007", 2), [])
    put(tmp_path, at.format(2, "r2", "007", 1), [event("a", percent_viewed=2.5, media_id=None)])
    put(tmp_path, at.format(3, "lost", "007", 1), [event("c")])
    put(tmp_path, at.format(3, "r2", "008", 1), [event("d", received_at="garbage")])
    landed = read_landed(spark, str(tmp_path), "events")
    assert landed.count() == 5
    found = silver_events(landed, runs).select("event_key", "media_id", "percent_viewed", "run_id", "event_date")
    assert rows(found) == [
        ("a", "007", 2.5, "r2", date(2026, 1, 1)),  # later run wins, path names the media as text
        ("b", "other", None, "r1", date(2026, 1, 1)),  # payload's own media wins
        ("d", "008", None, "r2", None),
    ]


def test_only_listed_dates_are_read(spark, tmp_path, runs):
    for day in (1, 2):
        put(tmp_path, f"events/ingestion_date=2026-01-0{day}/run_id=r1/media_id=m/page=000001.json", [event(f"e{day}")])
    assert read_landed(spark, str(tmp_path), "events", ["2026-01-02"]).first()["event_key"] == "e2"


def test_broken_file_is_one_empty_row_and_can_be_found(spark, tmp_path):
    at = "media_daily_stats/ingestion_date=2026-01-01/run_id=r1/media_id={}/media_daily_stats.json"
    put(tmp_path, at.format("a"), '[{"date": "2026-01-01", "load_co')
    put(tmp_path, at.format("b"), [{"date": "2026-01-01", "hours_watched": 1, "load_count": 2}])
    landed = read_landed(spark, str(tmp_path), "media_daily_stats")
    assert landed.count() == 2
    bad = quarantined(landed.cache()).collect()
    assert len(bad) == 1 and "media_id=a" in bad[0]["_source_file"]


def test_daily_hours_mix_whole_and_broken_numbers(spark, tmp_path, runs):
    at = "media_daily_stats/ingestion_date=2026-01-01/run_id=r1/media_id={}/media_daily_stats.json"
    put(tmp_path, at.format("a"), [{"date": "2026-01-01", "hours_watched": 1}])
    put(tmp_path, at.format("b"), [{"date": "2026-01-01", "hours_watched": 1.5}, {"date": "nonsense"}])
    found = silver_media_daily_stats(read_landed(spark, str(tmp_path), "media_daily_stats"), runs)
    assert rows(found.select("media_id", "stat_date", "hours_watched", "stat_year", "stat_month")) == [
        ("a", date(2026, 1, 1), 1.0, 2026, 1), ("b", None, None, None, None), ("b", date(2026, 1, 1), 1.5, 2026, 1),
    ]


def test_media_version_and_assets(spark, tmp_path, runs):
    at = "media/ingestion_date=2026-01-0{}/run_id=r{}/media_id={}/media.json"
    put(tmp_path, at.format(1, 1, "m"), {"id": 1, "updated": "2026-01-01T00:00:00Z", "name": "old", "assets": []})
    put(tmp_path, at.format(2, 2, "m"), {"id": 1, "updated": None, "name": "undated"})
    put(tmp_path, at.format(2, 2, "n"), {"id": 2, "name": "n", "assets": [{"type": "o", "width": 3}], "tags": ["x"]})
    found = silver_media(read_landed(spark, str(tmp_path), "media"), runs)
    assert rows(found.select("media_id", "title", "asset_count", "assets_json")) == [
        ("m", "old", 0, "[]"), ("n", "n", 1, '[{"type":"o","width":3}]'),
    ]


def test_missing_visitors_give_an_empty_table_and_other_datasets_fail(spark, tmp_path, runs):
    visitors = read_landed(spark, str(tmp_path), "visitors", optional=True)
    assert visitors.isEmpty() and "visitor_identity" in visitors.columns
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        build_silver(landing_reader(spark, str(tmp_path)), runs)


def test_audits(spark, tmp_path):
    summary = "ingestion_date=2026-01-01/run_id={}/summary.json"
    put(tmp_path, summary.format("r1"), {"run_id": "r1", "status": "SUCCESS", "start_ts": "2026-01-01T00:00:00+00:00"})
    put(tmp_path, summary.format("r1b"), {"run_id": "r1", "status": "SUCCESS", "start_ts": "2026-01-01T06:00:00Z"})
    put(tmp_path, summary.format("r2"), {"run_id": "r2", "status": "FAILED", "error_type": "X"})
    runs = successful_runs(read_audits(spark, str(tmp_path)))
    assert rows(runs) == [("r1", datetime(2026, 1, 1, 6))]
    with pytest.raises(ValueError):
        require_runs(runs.filter(F.lit(False)))
