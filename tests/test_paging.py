import json

import pytest
from pyspark.sql import functions as F

from reelmart.operators import paging
from reelmart.sinks import landing as landing_sink
from reelmart.sinks.landing import land_documents, land_pages, land_visitors
from reelmart.sources.landing import landed_objects, read_landed
from tests.conftest import rows


def media_rows(spark, sizes):
    return spark.createDataFrame([(m, i) for m, n in sizes.items() for i in range(n)], "media_id string, at int")


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_numbers_match_brute_force_with_a_hot_media(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    df = media_rows(spark, {"hot": 3000, None: 50, **{f"m{i}": i for i in range(80)}}).repartition(5)
    numbered = paging.number_within(df, "media_id", ["at"]).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(numbered) == 3000 + 50 + sum(range(80))
    assert all(r["row_no"] == r["at"] + 1 for r in numbered)


def test_hot_media_is_cut_into_slices(spark):
    df = media_rows(spark, {"hot": 4000, "cold": 10})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        plan = paging.number_within(df, "media_id", ["at"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wide = next(f for f in plan.inputFiles() if "/numbered-" in f)
    slices = spark.read.parquet(wide.rsplit("/", 1)[0])
    sizes = slices.filter("media_id = 'hot'").groupBy("_slice").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 4000


@pytest.mark.parametrize("size,pages", [(0, [0]), (1, [1]), (2, [2]), (3, [3, 0]), (7, [3, 3, 1]), (6, [3, 3, 0])])
def test_last_page_is_always_short(spark, size, pages):
    keys = spark.createDataFrame([("m",)], "media_id string")
    spine = paging.page_spine(keys, media_rows(spark, {"m": size} if size else {"x": 1}), "media_id", ["at"], 3)
    spine = spine.filter("media_id = 'm'")
    assert [r["records"] for r in spine.orderBy("page").collect()] == pages


def test_landed_pages_read_back_with_empty_ones(spark, tmp_path):
    keys = spark.createDataFrame([("a",), ("b",), ("none",)], "media_id string")
    events = media_rows(spark, {"a": 4, "b": 3}).withColumn("event_key", F.concat("media_id", "at"))
    pages = paging.page_payloads(keys, events, "media_id", ["event_key"], ["at"], per_page=2)
    assert {(r["media_id"], r["page"]): json.loads(r["body"]) for r in pages.collect()}["a", "000002"] == [
        {"event_key": "a2"}, {"event_key": "a3"}
    ]
    for _ in range(2):  # a repeated landing replaces the run
        land_pages(pages, str(tmp_path), "2026-01-01", "r1")
    objects = landed_objects(spark, str(tmp_path), "events")
    assert rows(objects.select("run_id", "media_id", "page", "records")) == [
        ("r1", "a", 1, 2), ("r1", "a", 2, 2), ("r1", "a", 3, 0), ("r1", "b", 1, 2), ("r1", "b", 2, 1), ("r1", "none", 1, 0)
    ]
    assert paging.page_completeness(objects, ["run_id", "media_id"], 2).filter("complete").count() == 3
    files = [p for p in tmp_path.rglob("page=*") if p.is_dir()]
    assert len(files) == 3 + 2 + 1
    assert sorted(r["event_key"] for r in read_landed(spark, str(tmp_path), "events").collect()) == [
        "a0", "a1", "a2", "a3", "b0", "b1", "b2"
    ]


def test_odd_names_and_broken_pages(spark, tmp_path):
    """Media with characters that paths escape, and a page that does not parse."""
    for media, bodies in {"a b": ['[{"event_key": "1"}, {"event_key": "2"}]', "[]"], "c%2Fd+e": ['[{"event_key": "3"}]'], "x": ["[{]"]}.items():
        for page, body in enumerate(bodies, 1):
            folder = tmp_path / "events" / "ingestion_date=2026-01-01" / "run_id=r 1" / f"media_id={media}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"page={page:06d}.json").write_text(body)
    objects = landed_objects(spark, str(tmp_path), "events")
    found = rows(objects.select("run_id", "media_id", "page", "records", "broken"))
    assert found == [("r 1", "a b", 1, 2, False), ("r 1", "a b", 2, 0, False), ("r 1", "c/d+e", 1, 1, False), ("r 1", "x", 1, 0, True)]
    whole = paging.page_completeness(objects, ["run_id", "media_id"], 2).filter("complete").collect()
    assert {r["media_id"] for r in whole} == {"a b", "c/d+e"}


def test_landed_visitors_do_not_show_their_key(spark, tmp_path):
    visitors = spark.createDataFrame([("visitor-9", '{"visitor_key": "visitor-9"}')], "visitor_key string, body string")
    land_visitors(visitors, str(tmp_path), "2026-01-01", "r1")
    assert not [p for p in tmp_path.rglob("*visitor-9*")]
    assert read_landed(spark, str(tmp_path), "visitors").first()["visitor_key"] == "visitor-9"


PAGES = {
    "whole": [(1, 3), (2, 3), (3, 0)],
    "single": [(1, 0)],
    "gap": [(1, 3), (3, 1)],
    "no first": [(2, 3), (3, 1)],
    "short inside": [(1, 3), (2, 2), (3, 1)],
    "cut at limit": [(1, 3), (2, 3), (3, 3)],
    "beyond limit": [(1, 3), (2, 3), (3, 3), (4, 3), (5, 3), (6, 1)],
    "repeated": [(1, 3), (1, 3), (3, 1)],
    "no number": [(1, 3), (2, 1), (None, 1)],
}


def test_completeness(spark):
    pages = spark.createDataFrame(
        [(m, p, n) for m, ps in PAGES.items() for p, n in ps], "media_id string, page long, records long"
    )
    found = {r["media_id"]: r for r in paging.page_completeness(pages, ["media_id"], 3, 3).collect()}
    assert {m for m, r in found.items() if r["complete"]} == {"whole", "single"}
    assert {m for m, r in found.items() if r["over_limit"]} == {"cut at limit", "beyond limit"}
    with pytest.raises(ValueError):
        paging.require_complete(paging.page_completeness(pages, ["media_id"], 3))


def test_endpoint_audit(spark):
    objects = spark.createDataFrame(
        [("m", "media", 1), ("m", "events", 100), ("m", "events", 7), ("m", "media_daily_stats", 9)],
        "media_id string, endpoint string, records long",
    )
    windows = spark.sql("SELECT 'm' AS media_id, DATE '2026-01-01' AS start_date, DATE '2026-01-09' AS end_date")
    audit = {r["endpoint"]: r for r in paging.endpoint_audit(objects, ["media_id"], windows).collect()}
    assert (audit["events"]["pages_fetched"], audit["events"]["records_fetched"]) == (2, 107)
    assert audit["media"]["start_date"] is None and audit["events"]["end_date"].day == 9


def test_visitor_discovery(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("a",)], "visitor_key string")
    assert [r[0] for r in paging.visitor_discovery(df).collect()] == ["a", "b"]


ODD_NAMES = ["plain", "a b", "c/d%2F+e", "q?=[x]{y}:*\"'#\\^|<>~", "ä\t", "", None, None]


@pytest.mark.parametrize("mounted", [True, False])
def test_files_made_by_tasks_read_back_as_those_of_sparks_writer(spark, tmp_path, monkeypatch, mounted):
    """Odd, empty and missing names, and two documents of one name; few files to a task."""
    monkeypatch.setattr(landing_sink, "FILES_PER_TASK", 2)
    if not mounted:
        monkeypatch.setattr(landing_sink, "local_folder", lambda *_: None)
    documents = spark.createDataFrame(
        [(m, json.dumps([{"event_key": f"{k}"}])) for k, m in enumerate(ODD_NAMES)], "media_id string, body string"
    )
    old = spark.createDataFrame([("gone", "[]")], documents.schema)
    for landed in (old, documents):
        land_documents(landed, f"file://{tmp_path}", "events", "2026-01-01", "r1")
    found = landed_objects(spark, str(tmp_path), "events")
    named = [m or "__HIVE_DEFAULT_PARTITION__" for m in ODD_NAMES]
    assert {r["media_id"] for r in found.collect()} == set(named)
    texts = [line for p in tmp_path.rglob("media_id=*/*") if p.suffix != ".crc" for line in p.read_text().splitlines()]
    assert sorted(texts) == sorted(r["body"] for r in documents.collect())
    if mounted:  # no document hides another of its name
        keys = [r["event_key"] for r in read_landed(spark, str(tmp_path), "events").collect()]
        assert sorted(keys) == sorted(str(k) for k in range(len(ODD_NAMES)))
    folders = {p.name for p in (tmp_path / "events/ingestion_date=2026-01-01/run_id=r1").glob("media_id=*")}
    documents.write.partitionBy("media_id").text(str(tmp_path / "by-spark"))
    assert folders == {p.name for p in (tmp_path / "by-spark").glob("media_id=*")}


def test_a_visitor_is_one_file_in_few_folders(spark, tmp_path):
    visitors = spark.range(600).select(
        F.concat(F.lit("v"), "id").alias("visitor_key"), F.to_json(F.struct(F.concat(F.lit("v"), "id").alias("visitor_key"))).alias("body")
    )
    assert land_visitors(visitors, str(tmp_path), "2026-01-01", "r1") == 600
    run = tmp_path / "visitors/ingestion_date=2026-01-01/run_id=r1"
    assert len([p for p in run.rglob("*") if p.is_file()]) == 600
    assert len([p for p in run.rglob("*") if p.is_dir()]) <= 256
    assert read_landed(spark, str(tmp_path), "visitors").select("visitor_key").distinct().count() == 600


def test_bodies_of_pages_are_made_once_and_kept_in_no_table(spark, tmp_path, monkeypatch):
    """A Parquet copy of the pages takes thousands of them into memory at once when it is read."""
    monkeypatch.setattr(landing_sink, "FILES_PER_TASK", 2)
    keys = spark.createDataFrame([("a",), ("none",)], "media_id string")
    events = media_rows(spark, {"a": 7}).withColumn("event_key", F.concat("media_id", "at"))
    pages = paging.page_payloads(keys, events, "media_id", ["event_key"], ["at"], per_page=2)
    monkeypatch.setattr(landing_sink, "cut_lineage", lambda *_: pytest.fail("pages were copied"))
    land_pages(pages, str(tmp_path), "2026-01-01", "r1")
    noted = landing_sink.read_manifest(spark, str(tmp_path), "2026-01-01", "r1", ["events"])
    found = [("a", 1, 2, 1), ("a", 2, 2, 1), ("a", 3, 2, 1), ("a", 4, 1, 1), ("none", 1, 0, 1)]
    assert rows(noted.select("media_id", "page", "records", "objects")) == found
    assert read_landed(spark, str(tmp_path), "events").count() == 7


@pytest.mark.parametrize("mounted", [True, False])
def test_the_manifest_names_media_as_they_came(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(landing_sink, "local_folder", lambda *_: None)
    documents = spark.createDataFrame([(m, "[1, 2]") for m in ODD_NAMES] + [("wide", None)], "media_id string, body string")
    land_documents(documents, f"file://{tmp_path}", "events", "2026-01-01", "r1")
    noted = landing_sink.read_manifest(spark, str(tmp_path), "2026-01-01", "r1", ["events"])
    assert rows(noted.select("media_id", "page", "records", "objects")) == sorted(
        [(m, None, 2, 1) for m in ODD_NAMES] + [("wide", None, 1, 1)], key=repr
    )


def test_a_landing_that_fails_leaves_the_one_before(spark, tmp_path):
    pages = spark.createDataFrame([("m", 1, 1, '[{"event_key": "old"}]')], "media_id string, page int, records int, body string")
    land_pages(pages, str(tmp_path), "2026-01-01", "r1")
    broken = pages.withColumn("body", F.raise_error(F.col("media_id")).cast("string"))
    with pytest.raises(Exception):
        land_pages(broken, str(tmp_path), "2026-01-01", "r1")
    assert [r["event_key"] for r in read_landed(spark, str(tmp_path), "events").collect()] == ["old"]


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    run = tmp_path / "events/ingestion_date=2026-01-01/run_id=r1/media_id=m"
    run.mkdir(parents=True)
    for page in range(1, 401):
        (run / f"page={page:06d}.json").write_text(f'[{{"event_key": "{page}"}}]')
    landed = read_landed(spark, str(tmp_path), "events")
    assert landed.count() == 400 and landed.rdd.getNumPartitions() <= 6
