import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.functions import scalars as sc
from gridpulse.functions import values as v
from gridpulse.functions.buckets import (
    Bucket, at_local_time, bucket_of, ceil_to, date_bin, floor_to, sample_bucket, to_local, to_utc,
)

TS = "t timestamp_ntz"


def one(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()[0]


@pytest.mark.parametrize("kind,expected", [("int64", 5.0), ("float64", 1.5), ("numeric", 2.25), (None, None), ("other", None)])
def test_reading_value(spark, kind, expected):
    row = (5, 1.5, decimal.Decimal("2.25"), kind)
    schema = "value_bigint bigint, value_double double, value_numeric decimal(38,9), value_type string"
    assert one(spark, v.reading_value(), schema, row) == expected


def test_any_value_prefers_double(spark):
    schema = "value_bigint bigint, value_double double, value_numeric decimal(38,9)"
    assert one(spark, v.any_value_of(), schema, (5, 1.5, decimal.Decimal(2))) == 1.5
    assert one(spark, v.any_value_of(), schema, (5, None, decimal.Decimal(2))) == 5.0
    assert one(spark, v.any_value_of(), schema, (None, None, None)) is None


@pytest.mark.parametrize("q,expected", [
    ("online", "online"), ("estimated", "estimated"), ("over_range", "offline"), ("error", "offline"), (None, "offline"),
])
def test_quality(spark, q, expected):
    assert one(spark, v.quality_to_aggregate(), "data_quality string", (q,)) == expected
    assert one(spark, v.quality_label(v.quality_code()), "data_quality string", (q,)) == expected


@pytest.mark.parametrize("uom,rollup,factor", [
    ("W", "kWh", 0.001), ("MW", "kWh", 1000.0), ("kWh", "MWh", 0.001), ("degC", "kWh", 1.0), (None, "kWh", 1.0),
    ("kW", None, 1.0), ("Wh/m2", "kWh/m2", 0.001),
])
def test_unit_factor(spark, uom, rollup, factor):
    assert one(spark, v.uom_conversion_factor("uom", "r"), "uom string, r string", (uom, rollup)) == factor


def test_enum_sort(spark):
    df = spark.createDataFrame([("high",), ("critical",), ("information",), (None,)], "s string")
    ordered = df.orderBy(v.enum_ordinal("alarm_severity", "s").asc_nulls_last())
    assert [r[0] for r in ordered.collect()] == ["information", "high", "critical", None]


def test_array_index(spark):
    assert one(spark, sc.element("a", 1), "a array<int>", ([7],)) == 7
    assert one(spark, sc.element("a", 2), "a array<int>", ([7],)) is None


def test_bitmask_and_translation(spark):
    schema = "x bigint, i array<int>, d array<string>"
    assert one(spark, v.decode_bits("x", "i", "d"), schema, (5, [0, 1, 2], ["a", "b", "c"])) == ["a", "c"]
    assert one(spark, v.translate("x", "i", "d"), schema, (2, [0, 2], ["a", "b"])) == "b"
    assert one(spark, v.translate("x", "i", "d"), schema, (9, [0, 2], ["a", "b"])) is None


def test_range_quality(spark):
    got = [one(spark, v.range_quality("x", "lo", "hi", "q"), "x double, lo double, hi double, q string", (x, 0.0, 10.0, "online"))
           for x in (-1.0, 5.0, 11.0)]
    assert got == ["under_range", "online", "over_range"]


def test_rounding(spark):
    assert one(spark, sc.round_half_away("x", 1), "x double", (30 * 0.985,)) == 29.6
    assert one(spark, sc.round_half_away("x", 1), "x double", (-0.25,)) == -0.3
    assert [one(spark, sc.to_int("x"), "x double", (x,)) for x in (1.5, 2.5, 2.6)] == [2, 2, 3]


def test_null_safe_helpers(spark):
    assert one(spark, sc.safe_divide("x", "y"), "x double, y double", (1.0, 0.0)) is None
    assert [one(spark, sc.is_not_true("b"), "b boolean", (b,)) for b in (True, False, None)] == [False, True, True]
    assert one(spark, sc.squeeze("s", 2000), "s string", ("a \n\t b",)) == "a b"
    assert one(spark, sc.json_text("s", "k"), "s string", ('{"k": "7 days"}',)) == "7 days"


def test_bucket_widths():
    assert Bucket.of("15 minutes") == Bucket(seconds=900)
    assert Bucket.of("1 month").nominal_hours == 720.0
    assert Bucket.of(dt.timedelta(days=7)) == Bucket.of("1 week")
    for bad in ("", "0 hours", "3 fortnights", "hour"):
        with pytest.raises(ValueError):
            Bucket.of(bad)


def test_sample_keywords():
    assert sample_bucket("DAY") == Bucket.of("1 day")
    with pytest.raises(ValueError):
        sample_bucket("week")


def test_week_starts_monday(spark):
    assert one(spark, bucket_of(F.col("t"), "1 week"), TS, (dt.datetime(2024, 1, 3),)) == dt.datetime(2024, 1, 1)
    assert floor_to(dt.datetime(2024, 1, 3), "1 week") == dt.datetime(2024, 1, 1)


def test_calendar_buckets(spark):
    assert one(spark, bucket_of(F.col("t"), "1 month"), TS, (dt.datetime(2024, 2, 29, 5),)) == dt.datetime(2024, 2, 1)
    assert one(spark, bucket_of(F.col("t"), "3 months"), TS, (dt.datetime(1999, 12, 31),)) == dt.datetime(1999, 10, 1)


def test_date_bin_before_origin(spark):
    assert one(spark, date_bin(F.col("t"), "5 minutes"), TS, (dt.datetime(1999, 12, 31, 12, 7),)) == dt.datetime(1999, 12, 31, 12, 5)


def test_driver_side_bounds():
    t = dt.datetime(2024, 1, 5, 10, 20)
    assert (floor_to(t, "1 hour"), ceil_to(t, "1 hour")) == (at("10:00"), at("11:00"))
    assert ceil_to(at("10:00"), "1 hour") == at("10:00")
    assert ceil_to(dt.datetime(2023, 12, 2), "1 month") == dt.datetime(2024, 1, 1)


def _day_start(spark, t, tz):
    local = bucket_of(to_local(F.col("t"), tz), "1 day")
    df = spark.createDataFrame([(t,)], TS).withColumn("b", local)
    return df.select(to_utc(F.col("b"), tz)).first()[0]


@pytest.mark.parametrize("tz,t,start", [
    ("America/Chicago", (2024, 3, 10, 5, 59), (2024, 3, 9, 6)),
    ("America/Chicago", (2024, 3, 10, 6, 0), (2024, 3, 10, 6)),
    ("America/Chicago", (2024, 3, 11, 4, 59), (2024, 3, 10, 6)),
    ("America/Chicago", (2024, 3, 11, 5, 0), (2024, 3, 11, 5)),
    ("America/Phoenix", (2024, 3, 10, 6, 59), (2024, 3, 9, 7)),
    ("America/Phoenix", (2024, 3, 10, 7, 0), (2024, 3, 10, 7)),
    ("Asia/Kolkata", (2024, 1, 5, 18, 29), (2024, 1, 4, 18, 30)),
    ("Asia/Kolkata", (2024, 1, 5, 18, 30), (2024, 1, 5, 18, 30)),
])
def test_local_days(spark, tz, t, start):
    assert _day_start(spark, dt.datetime(*t), tz) == dt.datetime(*start)


def test_repeated_and_skipped_wall_clock(spark):
    def utc(t):
        return one(spark, to_utc(F.col("t"), "America/Chicago"), TS, (t,))

    assert utc(dt.datetime(2024, 11, 3, 1, 30)) == dt.datetime(2024, 11, 3, 7, 30)  # standard time
    assert utc(dt.datetime(2024, 11, 3, 0, 30)) == dt.datetime(2024, 11, 3, 5, 30)
    assert utc(dt.datetime(2024, 11, 3, 2, 30)) == dt.datetime(2024, 11, 3, 8, 30)
    assert utc(dt.datetime(2024, 3, 10, 2, 30)) == dt.datetime(2024, 3, 10, 8, 30)  # skipped


def test_results_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = dt.datetime(2024, 3, 10, 7, 15)
        df = spark.createDataFrame([(t,)], TS).withColumn("b", bucket_of(F.col("t"), "1 hour"))
        got = df.select("b", to_local(F.col("b"), "Asia/Kolkata")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == (dt.datetime(2024, 3, 10, 7), dt.datetime(2024, 3, 10, 12, 30))


def test_local_clock_to_utc(spark):
    col = at_local_time(F.col("d"), dt.time(11), "America/Phoenix")
    assert one(spark, col, "d date", (dt.date(2024, 1, 5),)) == at("18:00")


def test_sampling_is_stable(spark):
    df = spark.range(10000).filter(sc.sampled("id", 0.1))
    again = spark.range(10000).repartition(7).filter(sc.sampled("id", 0.1))
    assert rows(df, "id") == rows(again, "id")
    assert 800 < df.count() < 1200
