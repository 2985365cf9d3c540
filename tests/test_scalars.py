import math
from datetime import date, datetime

from pyspark.sql import functions as F

from reelmart.functions import scalars as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_pseudonym_hides_the_key(spark):
    name = one(spark, fn.pseudonym(F.lit("visitor-secret-123")))
    assert len(name) == 24 and "visitor" not in name


def test_timestamps_with_zone_offset_or_neither_are_utc(spark):
    texts = ["2026-09-12T12:00:00Z", "2026-09-12T14:00:00+02:00", "2026-09-12T12:00:00"]
    for text in texts:
        assert one(spark, fn.iso_timestamp(F.lit(text))) == datetime(2026, 9, 12, 12)


def test_bad_times_and_dates_give_null(spark):
    for text in ("garbage", "", None):
        assert one(spark, fn.iso_timestamp(F.lit(text).cast("string"))) is None
        assert one(spark, fn.iso_date(F.lit(text).cast("string"))) is None


def test_date_key(spark):
    assert one(spark, fn.date_key(F.lit("2027-01-03").cast("date"))) == 20270103
    assert one(spark, fn.date_key(F.lit(None).cast("date"))) is None


def test_flags(spark):
    assert [one(spark, fn.flag(F.lit(t))) for t in (" YES ", "y", "1", "True", "no", "")] == [True] * 4 + [False] * 2


def test_list_items_drops_blanks(spark):
    assert one(spark, fn.list_items(F.lit(" a ,, b,  "))) == ["a", "b"]


def test_page_names_keep_long_numbers(spark):
    assert [one(spark, fn.page_name(F.lit(n))) for n in (1, 1234567)] == ["000001", "1234567"]


def test_days_before_never_runs_forward(spark):
    end = F.lit("2026-09-10").cast("date")
    assert [one(spark, fn.days_before(end, F.lit(n))) for n in (0, 1, 7)] == [
        date(2026, 9, 10), date(2026, 9, 10), date(2026, 9, 4)
    ]


def test_age_and_short_text(spark):
    ts = [F.lit(t).cast("timestamp") for t in ("2026-01-02 01:30:00", "2026-01-01 00:00:00")]
    assert one(spark, fn.age_hours(*ts)) == 25.5
    assert one(spark, fn.short_text(F.lit("abcdef"), 3)) == "abc"


def test_asset_count_of_missing_and_empty_arrays(spark):
    df = spark.createDataFrame([(None,), ([],), ([1, 2],)], "a array<int>")
    assert [r[0] for r in df.select(fn.asset_count(F.col("a"))).collect()] == [-1, 0, 2]


def test_ratio_guards_zero_and_missing(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2)], "p long, l long")
    assert [r[0] for r in df.select(fn.ratio_or_zero(F.col("p"), F.col("l"))).collect()] == [0.5, 0.0, 0.0, None]


def test_steady_mean_does_not_depend_on_order(spark):
    df = spark.range(10_000).select((F.rand(7) * 100).alias("v")).cache()
    means = {df.repartition(n).agg(fn.steady_mean(F.col("v"))).first()[0] for n in (1, 3, 16)}
    assert len(means) == 1
    assert abs(means.pop() - df.agg(F.avg("v")).first()[0]) < 1e-6


def test_steady_mean_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(fn.steady_mean(F.col("v"))).first()[0] == 1.5
    assert df.filter("v is null").agg(fn.steady_mean(F.col("v"))).first()[0] is None


def test_steady_mean_of_values_no_decimal_holds(spark):
    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(fn.steady_mean(F.col("v"))).first()[0]

    assert mean(1e30, 1.0) == (1e30 + 1.0) / 2 and mean(float("inf")) == float("inf")
    assert math.isnan(mean(1.0, float("nan")))


def test_steady_sum_keeps_small_and_large_values(spark):
    df = spark.createDataFrame([(4e-9,), (4e-9,), (4e-9,)], "v double")
    assert abs(df.agg(fn.steady_sum(F.col("v"))).first()[0] - 1.2e-8) < 1e-20
    df = spark.createDataFrame([(1e22,), (1e22,), (0.5,)], "v double")
    assert df.agg(fn.steady_sum(F.col("v"))).first()[0] == 2e22
