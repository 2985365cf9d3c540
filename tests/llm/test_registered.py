"""Registered queries next to their SQL, the pipeline, and the guard around the subpackage."""

import tracemalloc

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import TABLES, as_rows
from reelmart.llm import common, ngrams, oracles, queries
from reelmart.session import cut_lineage


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.queries()[name](spark, sf_dir)
    cursor = db.execute(oracles.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert as_rows(df.columns, [tuple(r) for r in df.collect()]) == as_rows(columns, cursor.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) >= 0.7 * len(ids), name
        ids = now
    left = docs.filter("text LIKE '%@mail%'").count()
    assert left == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in last.collect()} == ids


@pytest.mark.parametrize("name, stage", [s for s in corpus_pipeline.STAGES if s[0] != "personal_data"])
def test_stages_hand_bounded_batches_to_python(spark, sf_dir, name, stage):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["rows"])

    many = spark.range(3000, numPartitions=1)
    docs = spark.createDataFrame([(k, f"one two three four five {k}", "en") for k in range(40)], "doc_id long, text string, lang string")
    before = spark.conf.get(setting)
    try:
        spark.conf.unset(setting)
        stage(spark, docs, sf_dir)
        assert max(r.rows for r in many.mapInArrow(sizes, "rows long").collect()) <= common.BATCH_ROWS
        spark.conf.set(setting, "100")
        assert common.small_batches(spark).conf.get(setting) == "100"
    finally:
        spark.conf.set(setting, before)


def test_hashing_words_keeps_nothing_in_the_worker():
    text = " ".join(f"word{k}" for k in range(50_000))
    ngrams.shingle_set("a b c", 3)
    tracemalloc.start()
    try:
        sets = ngrams.shingle_set(text, 3)
        held = tracemalloc.get_traced_memory()[0] - sets.nbytes
    finally:
        tracemalloc.stop()
    assert len(sets) == 49_998 and held < 200_000
