import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import POINTS, READINGS, at, rows
from gridpulse.operators.gapfill import readings_gapfilled
from gridpulse.functions.buckets import to_local, to_utc
from gridpulse.operators.rollup import point_history, power_to_energy, readings_rollup

STATS = ("sample_count", "avg_value", "min_value", "max_value", "sum_value", "first_value", "last_value", "data_quality")


def test_hour(readings, points):
    df = readings((at("10:00"), "p", 2.0), (at("10:20"), "p", 6.0), (at("10:40"), "p", 4.0))
    out = readings_rollup(df, points(("p",)), at("10:00"), at("11:00"))
    assert rows(out, "bucket_start", "bucket_end", *STATS) == [
        (at("10:00"), at("11:00"), 3, 4.0, 2.0, 6.0, 12.0, 2.0, 4.0, "online")
    ]


def test_mixed_quality(readings, points):
    df = readings((at("10:00"), "p", 1.0, "online"), (at("10:30"), "p", 1.0, "error"))
    assert rows(readings_rollup(df, points(("p",))), "data_quality") == [("mixed",)]
    same = readings((at("10:00"), "p", 1.0, "over_range"), (at("10:30"), "p", 1.0, "error"))
    assert rows(readings_rollup(same, points(("p",))), "data_quality") == [("offline",)]


def test_heartbeats_do_not_count(readings, points):
    df = readings((at("10:00"), "p", 2.0), (at("10:10"), "p", 99.0, "online", "heartbeat"))
    assert rows(readings_rollup(df, points(("p",))), "sample_count", "avg_value") == [(1, 2.0)]


def test_range_is_half_open(readings, points):
    df = readings((at("10:00"), "p", 2.0), (at("11:00"), "p", 3.0))
    assert rows(readings_rollup(df, points(("p",)), at("10:00"), at("11:00")), "bucket_start") == [(at("10:00"),)]


def test_points_may_be_a_list_or_a_table(spark, readings, points):
    df = readings((at("10:00"), "a", 1.0), (at("10:00"), "b", 2.0))
    table = spark.createDataFrame([("b",)], "point_id string")
    catalog = points(("a",), ("b",))
    assert rows(readings_rollup(df, catalog, point_ids=["a"]), "point_id") == [("a",)]
    assert rows(readings_rollup(df, catalog, point_ids=table), "point_id") == [("b",)]


def test_unfilled_column_gives_null(spark, readings):
    points = spark.createDataFrame([("p", "s", "p", "int64", "kW", "kWh")], POINTS)
    out = readings_rollup(readings((at("10:00"), "p", 2.0)), points)
    assert rows(out, "sample_count", "avg_value", "first_value") == [(1, None, None)]


def _random_tables(spark, seed=5):
    rng = random.Random(seed)
    kinds = ["int64", "float64", "numeric"]
    zones = ["UTC", "America/Chicago", "Asia/Kolkata", "Asia/Kathmandu"]
    catalog = [(f"p{i}", f"s{i % 4}", f"p{i}", kinds[i % 3], "kW", "kWh") for i in range(8)]
    rows_, seen = [], set()
    for _ in range(1500):
        i = rng.randrange(8) if rng.random() > 0.4 else 0
        t = dt.datetime(2024, 3, 8) + dt.timedelta(minutes=rng.randrange(4 * 1440))
        if (i, t) in seen:
            continue
        seen.add((i, t))
        x = rng.randrange(1000)
        rows_.append((t, f"p{i}", "raw", x if i % 3 == 0 else None, x / 4 if i % 3 == 1 else None, x if i % 3 == 2 else None,
                      rng.choice(["online", "estimated", "error"])))
    from decimal import Decimal

    rows_ = [(*r[:5], None if r[5] is None else Decimal(r[5]) / 8, r[6]) for r in rows_]
    df = spark.createDataFrame(rows_, READINGS)
    points = spark.createDataFrame(catalog, POINTS)
    sites = spark.createDataFrame([(f"s{i}", z) for i, z in enumerate(zones)], "site_id string, timezone string")
    return df, points, points.join(sites, "site_id")


@pytest.mark.parametrize("bucket,tz", [("1 hour", "UTC"), ("1 day", "America/Chicago"), ("1 month", "Asia/Kolkata"), ("5 minutes", "UTC")])
@pytest.mark.parametrize("bounded", [True, False])
def test_one_clock_and_clocks_per_point_agree(spark, bucket, tz, bounded):
    df, points, _ = _random_tables(spark)
    start = dt.datetime(2024, 3, 9, 1, 7) if bounded else None
    end = dt.datetime(2024, 3, 11, 13, 0) if bounded else None
    each = points.withColumn("timezone", F.lit(tz))
    out = [
        rows(readings_rollup(df, catalog, start, end, bucket, zone), "point_id", "bucket_start", "bucket_end", *STATS)
        for catalog, zone in ((points, tz), (each, None))
    ]
    assert out[0] == out[1] and out[0]


def test_carried_columns(readings, points):
    out = readings_rollup(readings((at("10:00"), "p", 2.0)), points(("p", "MW")), carry=("uom", "site_id"))
    assert rows(out, "point_id", "uom", "site_id") == [("p", "MW", "s")]


def test_energy(readings, points):
    df = readings((at("10:00"), "p", 4.0), (at("10:05"), "p", 4.0))
    catalog = points(("p", "kW", "kWh"))
    assert rows(power_to_energy(df, catalog, bucket="1 hour"), "energy", "energy_uom") == [(4.0, "kWh")]
    assert rows(power_to_energy(df, catalog, bucket="15 minutes"), "energy") == [(1.0,)]
    one = readings((at("10:00"), "p", 1.0))
    assert rows(power_to_energy(one, catalog, bucket="1 month"), "energy") == [(720.0,)]


def test_history(spark, readings, points):
    df = readings((at("10:00"), "p", 2.0), (at("10:30"), "p", 4.0))
    sites = spark.createDataFrame([("s", "site", "America/Phoenix")], "site_id string, name string, timezone string")
    catalog = points(("p",))

    def value(kind, **kw):
        return rows(point_history(df, catalog, sites, "Hour", value_kind=kind, **kw), "value", "value_kind")

    assert value("max") == [(4.0, "max")]
    assert value("LAST") == [(4.0, "last")]
    assert value("MEDIAN") == [(3.0, "median")]
    assert value("energy") == [(3.0, "energy")]
    assert value("sum", site_id="s") == [(6.0, "sum")]
    day = point_history(df, catalog, sites, "day", site_id="s")
    assert rows(day, "bucket_start", "bucket_end") == [(at("07:00"), at("07:00") + dt.timedelta(days=1))]
    assert rows(point_history(df, catalog, sites, "day"), "bucket_start") == [(at("07:00"),)]
    with pytest.raises(ValueError):
        point_history(df, catalog, sites, "week")
    with pytest.raises(ValueError):
        point_history(df, catalog, sites, "day", site_id="nowhere")


def test_gapfill(readings, points):
    df = readings((at("10:20"), "p", 7.0), (at("10:50"), "p", 9.0, "error"))
    out = readings_gapfilled(df, points(("p",), ("unseen",)), at("10:00"), at("11:15"), "15 minutes")
    assert rows(out, "bucket_time", "point_id", "value", "data_quality", "is_generated") == [
        (at("10:00"), "p", None, None, True),
        (at("10:15"), "p", 7.0, "online", False),
        (at("10:30"), "p", 7.0, "online", True),
        (at("10:45"), "p", 9.0, "offline", False),
        (at("11:00"), "p", 9.0, "offline", True),
    ]


def test_gapfill_starts_at_the_bucket_holding_start(readings, points):
    out = readings_gapfilled(readings((at("10:20"), "p", 7.0)), points(("p",)), at("10:07"), at("10:31"), "15 minutes")
    assert rows(out, "bucket_time") == [(at("10:00"),), (at("10:15"),), (at("10:30"),)]


def test_gapfill_row_count(spark):
    df, points, _ = _random_tables(spark)
    start, end = dt.datetime(2024, 3, 8), dt.datetime(2024, 3, 12)
    out = readings_gapfilled(df, points, start, end, "1 hour")
    assert out.count() == 8 * 96


@pytest.mark.parametrize("day,hours", [((2024, 3, 10), 23), ((2024, 11, 3), 24), ((2024, 7, 1), 24)])
def test_gapfill_across_daylight_saving(readings, points, day, hours):
    start = dt.datetime(*day) + dt.timedelta(hours=6 if day[1] != 11 and day[1] != 7 else 5)
    length = {3: 23, 11: 25, 7: 24}[day[1]]
    end = start + dt.timedelta(hours=length)
    out = readings_gapfilled(readings((start, "p", 1.0)), points(("p",)), start, end, "1 hour", "America/Chicago")
    times = [r[0] for r in rows(out, "bucket_time")]
    assert len(times) == len(set(times)) == hours


def test_local_days_of_gapfill(readings, points):
    start = dt.datetime(2024, 3, 9, 6)
    out = readings_gapfilled(
        readings((start, "p", 1.0)), points(("p",)), start, dt.datetime(2024, 3, 12, 5), "1 day", "America/Chicago"
    )
    assert rows(out, "bucket_time") == [
        (dt.datetime(2024, 3, 9, 6),), (dt.datetime(2024, 3, 10, 6),), (dt.datetime(2024, 3, 11, 5),)
    ]


def test_plan_prunes_and_pushes_down(spark, tmp_path, points, readings, capsys):
    path = str(tmp_path / "r")
    readings((at("10:00"), "p", 2.0)).write.parquet(path)
    readings_rollup(spark.read.parquet(path), points(("p",)), at("10:00"), at("11:00")).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(event_time" in plan and "EqualTo(reading_type,raw)" in plan
    assert "SortAggregate" not in plan and plan.count("Arguments: hashpartitioning") == 1


@pytest.mark.parametrize("tz", ["America/Chicago", "Australia/Lord_Howe", "Antarctica/Troll", "Europe/Berlin", "Asia/Kolkata"])
def test_wall_clocks_there_and_back(spark, tz):
    """Every quarter hour of a year: the later of two instants that show the same wall clock."""
    quarters = spark.range(366 * 96).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("id") * 15).cast("int"))).alias("t"))
    shown = quarters.withColumn("wall", to_local(F.col("t"), tz))
    latest = shown.groupBy("wall").agg(F.max("t").alias("t"))
    assert latest.filter(to_utc(F.col("wall"), tz) != F.col("t")).count() == 0


def test_a_skipped_wall_clock_moves_forward(spark):
    one = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 01:30:00' AS wall")
    assert one.select(to_utc(F.col("wall"), "Antarctica/Troll")).first()[0] == dt.datetime(2024, 3, 31, 1, 30)
