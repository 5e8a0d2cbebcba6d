import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.functions import sql
from gridpulse.functions.buckets import SAMPLE_TIMES, Bucket, bucket_of, to_utc
from gridpulse.functions.values import UNIT_FACTORS, uom_conversion_factor
from gridpulse.operators.rollup import point_history, readings_rollup

SITES = "site_id string, timezone string"


@pytest.fixture
def plant(spark, readings, points):
    clock = [at("00:00") + dt.timedelta(minutes=37 * i) for i in range(120)]
    rows_ = [(t, p, float(i % 11), ["online", "estimated", "error"][i % 3]) for i, t in enumerate(clock) for p in ("a", "b")]
    given = readings(*rows_, (at("10:01"), "a", 99.0, "online", "heartbeat"))
    catalog = points(("a", "W", "kWh", "s"), ("b", "degC", None, "t"))
    sites = spark.createDataFrame([("s", "America/Chicago"), ("t", "Asia/Kolkata")], SITES)
    sql.register(spark, given, catalog, sites, "t_")
    return given, catalog, sites


@pytest.mark.parametrize("sample", list(SAMPLE_TIMES))
def test_rollup_is_that_of_the_operator(spark, plant, sample):
    given, catalog, _ = plant
    got = spark.sql(f"SELECT * FROM t_readings_rollup(TIMESTAMP_NTZ '2024-01-05 03:00:00', NULL, '{sample}', 'Asia/Kolkata')")
    want = readings_rollup(given, catalog, at("03:00"), None, SAMPLE_TIMES[sample], "Asia/Kolkata")
    assert rows(got, *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("kind", ["avg", "min", "MAX", "sum", "last", "energy", "median"])
def test_history_of_every_site_by_lateral_calls(spark, plant, kind):
    given, catalog, sites = plant
    got = spark.sql(f"SELECT h.* FROM t_function_sites s, LATERAL t_point_history(s.site_id, NULL, NULL, 'day', '{kind}') h")
    want = point_history(given, catalog, sites, "day", value_kind=kind)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    one = spark.sql(f"SELECT * FROM t_point_history('t', NULL, NULL, 'day', '{kind}')")
    assert rows(one, *want.columns) == [r for r in rows(want, *want.columns) if r[0] == "b"]


def test_clocks_and_units(spark, plant):
    times = spark.createDataFrame(
        [(dt.datetime(2024, 3, 9) + dt.timedelta(minutes=17 * i),) for i in range(300)]
        + [(dt.datetime(2024, 11, 2) + dt.timedelta(minutes=17 * i),) for i in range(300)] + [(dt.datetime(1969, 12, 31, 23, 59),)],
        "t timestamp_ntz",
    )
    back = times.select(
        F.expr("t_from_local_clock(t, 'America/Chicago')").alias("got"), to_utc(F.col("t"), "America/Chicago").alias("want"))
    assert back.filter("got <> want").count() == 0
    for sample, width in SAMPLE_TIMES.items():
        cut = times.select(F.expr(f"t_sample_bucket('{sample}', t)").alias("got"), bucket_of(F.col("t"), Bucket.of(width)).alias("want"))
        assert cut.filter("got <> want").count() == 0
    pairs = spark.createDataFrame([*UNIT_FACTORS, ("W", "x"), (None, "kWh")], "a string, b string")
    both = pairs.select(F.expr("t_uom_conversion_factor(a, b)").alias("got"), uom_conversion_factor("a", "b").alias("want"))
    assert both.filter("NOT got <=> want").count() == 0


def test_an_unknown_sample_fails(spark, plant):
    with pytest.raises(PySparkException, match="unknown sample time"):
        spark.sql("SELECT * FROM t_readings_rollup(NULL, NULL, 'week', 'UTC')").collect()


def test_calls_are_inlined(spark, plant):
    plan = spark.sql("SELECT * FROM t_point_history('s', NULL, NULL, 'day', 'avg')")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "NestedLoop", "CartesianProduct", "SortAggregate"))
