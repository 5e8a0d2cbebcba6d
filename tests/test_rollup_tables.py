import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators import rollups as ru
from gridpulse.session import run_database
from gridpulse.sources.tables import with_partition

COLUMNS = ru.ROLLUP_COLUMNS


def test_day_average_is_exact(spark):
    hours = spark.createDataFrame(
        [("p", at("01:00"), 1, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 0), ("p", at("02:00"), 3, 6.0, 2.0, 1.0, 3.0, 3.0, 1.0, 2)],
        "point_id string, bucket timestamp_ntz, n bigint, sum_value double, avg_value double, min_value double, "
        "max_value double, first_value double, last_value double, not_online_n bigint",
    )
    assert rows(ru.rollup_1d(hours), *COLUMNS) == [("p", at("00:00"), 4, 16.0, 4.0, 1.0, 10.0, 10.0, 1.0, 2)]


@pytest.fixture
def table(spark, readings):
    db = run_database(spark, "test_rollup")
    name = f"{db}.readings_1h"
    ru.create_rollup(spark, name, ru.rollup_1h(readings((at("00:00"), "p", 1.0))))
    return name


def test_realtime_union(spark, readings, table):
    raw = readings((at("10:30"), "p", 1.0), (at("11:10"), "p", 5.0))
    ru.refresh(spark, table, raw, None, at("11:00"))
    assert ru.watermark(spark, table) == at("11:00")
    late = readings((at("10:30"), "p", 100.0), (at("11:10"), "p", 5.0))
    assert rows(ru.read_1h(spark, table, late), "bucket", "sum_value") == [(at("10:00"), 1.0), (at("11:00"), 5.0)]


def test_refresh_twice_is_refresh_once(spark, readings, table):
    raw = readings((at("10:30"), "p", 1.0), (at("11:10"), "q", 5.0))
    ru.refresh(spark, table, raw, None, at("12:00"))
    first = rows(spark.table(table), *COLUMNS)
    ru.refresh(spark, table, raw, None, at("12:00"))
    assert rows(spark.table(table), *COLUMNS) == first and len(first) == 2


def test_late_row_waits_for_an_explicit_refresh(spark, readings, table):
    day = dt.timedelta(days=1)
    raw = readings((at("10:30"), "p", 1.0), (at("10:30") + 6 * day, "p", 2.0))
    ru.refresh(spark, table, raw, None, at("12:00") + 6 * day)
    more = raw.unionByName(readings((at("10:40"), "p", 9.0)))
    ru.refresh_due(spark, table, more, at("12:00") + 6 * day, "1h")
    assert rows(spark.table(table), "bucket", "sum_value")[0] == (at("10:00"), 1.0)
    ru.refresh(spark, table, more, at("10:00"), at("11:00"))
    assert rows(spark.table(table), "bucket", "sum_value")[0] == (at("10:00"), 10.0)


def test_partial_buckets_at_the_bounds_are_left_alone(spark, readings, table):
    raw = readings(*[(at(f"{h}:30"), "p", float(h)) for h in range(9, 13)])
    ru.refresh(spark, table, raw, None, at("13:00"))
    changed = readings(*[(at(f"{h}:30"), "p", 100.0) for h in range(9, 13)])
    ru.refresh(spark, table, changed, at("09:20"), at("12:40"))
    assert [r[1] for r in rows(spark.table(table), "bucket", "sum_value")] == [9.0, 100.0, 100.0, 12.0]
    assert ru.watermark(spark, table) == at("13:00")


def test_refresh_removes_what_the_source_lost(spark, readings, table):
    day = dt.timedelta(days=1)
    raw = readings((at("10:30"), "p", 1.0), (at("10:30") + day, "p", 2.0), (at("10:30") + 2 * day, "p", 3.0))
    ru.refresh(spark, table, raw, None, at("00:00") + 3 * day)
    fewer = raw.filter(F.col("value_double") != 2.0)
    ru.refresh(spark, table, fewer, at("00:00") + day, at("00:00") + 2 * day)
    assert rows(spark.table(table), "sum_value") == [(1.0,), (3.0,)]


def test_refresh_keeps_other_days_untouched(spark, readings, table):
    day = dt.timedelta(days=1)
    raw = readings((at("10:30"), "p", 1.0), (at("10:30") + day, "p", 2.0))
    ru.refresh(spark, table, raw, None, at("00:00") + 2 * day)
    ru.refresh(spark, table, raw.filter("value_double = 2"), at("00:00") + day, at("00:00") + 2 * day)
    assert rows(spark.table(table), "sum_value") == [(1.0,), (2.0,)]


def test_daily_realtime_read(spark, readings, table):
    db = table.split(".")[0]
    day = dt.timedelta(days=1)
    raw = readings((at("10:30"), "p", 1.0), (at("10:30") + day, "p", 3.0), (at("11:30") + day, "p", 5.0))
    daily = f"{db}.readings_1d"
    ru.create_rollup(spark, daily, ru.rollup_1d(ru.rollup_1h(raw)))
    ru.refresh(spark, table, raw, None, at("11:00") + day)
    ru.refresh(spark, daily, spark.table(table), None, at("00:00") + day, "1d")
    assert rows(ru.read_1d(spark, daily, table, raw), "bucket", "n", "avg_value") == [
        (at("00:00"), 1, 1.0), (at("00:00") + day, 2, 4.0)
    ]


def test_partitions_are_skipped(spark, readings, tmp_path):
    from gridpulse.sources.tables import create_partitioned, in_range

    day = dt.timedelta(days=1)
    db = run_database(spark, "test_prune")
    df = with_partition(readings(*[(at("10:00") + i * day, "p", float(i)) for i in range(5)]), "event_time")
    create_partitioned(spark, f"{db}.point_readings", df)
    got = in_range(spark.table(f"{db}.point_readings"), "event_time", at("00:00") + day, at("00:00") + 3 * day)
    assert rows(got, "value_double") == [(1.0,), (2.0,)]
    assert "event_date" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]


def test_refresh_must_fit_retention():
    ru.check_refresh_within_retention("1d", 45)
    with pytest.raises(ValueError):
        ru.check_refresh_within_retention("1d", 5)


def test_bounded_realtime_reads_equal_the_filtered_whole(spark, readings, table):
    db = table.split(".")[0]
    raw = readings(*[(at("00:20") + dt.timedelta(hours=5 * i), "p", float(i)) for i in range(30)])
    daily = f"{db}.readings_1d"
    ru.create_rollup(spark, daily, ru.rollup_1d(ru.rollup_1h(raw)))
    ru.refresh(spark, table, raw, None, at("00:00") + dt.timedelta(days=4))
    ru.refresh(spark, daily, spark.table(table), None, at("00:00") + dt.timedelta(days=3), "1d")
    for start, end in ((at("10:30"), at("00:00") + dt.timedelta(days=5)), (at("06:00") + dt.timedelta(days=4), None), (None, at("12:00"))):
        hit = F.lit(True)
        if start:
            hit = hit & (F.col("bucket") >= F.lit(str(start)).cast("timestamp_ntz"))
        if end:
            hit = hit & (F.col("bucket") < F.lit(str(end)).cast("timestamp_ntz"))
        for bounded, whole in (
            (ru.read_1h(spark, table, raw, start, end), ru.read_1h(spark, table, raw)),
            (ru.read_1d(spark, daily, table, raw, start, end), ru.read_1d(spark, daily, table, raw)),
        ):
            assert rows(bounded, *COLUMNS) == rows(whole.filter(hit), *COLUMNS)
