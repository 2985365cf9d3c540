from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelmart.operators.dedup import newest_per, last_event_of_visitors, snapshot_per
from tests.conftest import rows


def test_latest_wins_and_nulls_sort_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", None, "w")], "k string, t int, v string")
    assert rows(newest_per(df, ["k"], [F.desc_nulls_last("t")])) == [("a", 2, "y"), ("b", None, "w")]


def test_ties_are_settled_the_same_way_for_any_partitioning(spark):
    df = spark.createDataFrame([("a", 1, f"v{i}", [i]) for i in range(50)], "k string, t int, v string, l array<int>")
    found = [rows(newest_per(df.repartition(n), ["k"], [F.desc("t")])) for n in (1, 3, 7)]
    assert found == [[("a", 1, "v9", [9])]] * 3


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, t int")
    assert newest_per(df, ["k"], [F.desc("t")]).count() == 2


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    latest = newest_per(df, ["k"], [F.desc("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "limit per key in the map tasks and after the shuffle"
    assert latest.filter("k = 'hot'").collect()[0]["id"] == 2999
    assert latest.count() == 6001


def test_snapshot_is_deterministic(spark):
    df = spark.createDataFrame([("m", "r", 1.0), ("m", "r", 3.0), ("m", "s", None)], "m string, r string, v double")
    assert rows(snapshot_per(df, ["m", "r"])) == [("m", "r", 3.0), ("m", "s", None)]


def test_latest_event_drops_unknown_visitors(spark):
    df = spark.createDataFrame([("v", 1), ("v", 5), (None, 9)], "visitor_key string, received_at int")
    assert rows(last_event_of_visitors(df)) == [("v", 5)]


facts = st.lists(
    st.tuples(st.sampled_from(["hot", "a", "b", None]), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)),
    min_size=1, max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(facts, st.integers(1, 5))
def test_latest_by_agrees_with_a_plain_sort(spark, data, partitions):
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(partitions)
    want = {}
    for key, t, v in data:
        rank = (t is not None, t or 0, v)
        if key not in want or rank > want[key][0]:
            want[key] = (rank, (key, t, v))
    found = rows(newest_per(df, ["k"], [F.desc_nulls_last("t")]))
    assert found == sorted((row for _, row in want.values()), key=repr)
