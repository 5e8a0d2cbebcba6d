"""Hourly and daily rollup tables, their refresh, and the real-time read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.buckets import Bucket, bucket_of, ceil_to, floor_to, instant
from gridpulse.functions.scalars import safe_divide
from gridpulse.functions.values import any_value_of
from gridpulse.sources.tables import (
    PARTITION_COLUMN,
    clustered,
    in_range,
    partition_files,
    replace_partitions,
    with_partition,
)

ROLLUP_COLUMNS = (
    "point_id", "bucket", "n", "sum_value", "avg_value", "min_value", "max_value",
    "first_value", "last_value", "not_online_n",
)
WATERMARK = "gridpulse.watermark"
HOUR, DAY = Bucket.of("1 hour"), Bucket.of("1 day")
# Refresh windows before now: (start offset, end offset).
REFRESH_WINDOWS = {
    "1h": (dt.timedelta(days=3), dt.timedelta(hours=1)),
    "1d": (dt.timedelta(days=7), dt.timedelta(days=1)),
}


def hourly_aggregates(value: Column, t: Column, quality: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("sum_value"),
        F.avg(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.min_by(value, t).alias("first_value"),
        F.max_by(value, t).alias("last_value"),
        F.sum(F.when(quality != "online", 1).otherwise(0)).alias("not_online_n"),
    ]


def rollup_1h(readings: DataFrame) -> DataFrame:
    """Hourly statistics per point over raw readings, UTC hours, no join."""
    raw = readings.filter(F.col("reading_type") == "raw")
    raw = raw.withColumn("bucket", bucket_of(F.col("event_time"), HOUR)).withColumn("v", any_value_of())
    return raw.groupBy("point_id", "bucket").agg(
        *hourly_aggregates(F.col("v"), F.col("event_time"), F.col("data_quality"))
    )


def rollup_1d(hourly: DataFrame) -> DataFrame:
    """Daily statistics from the hourly table; the average is exact, from its parts."""
    hour = F.col("bucket")
    days = hourly.withColumn("day", bucket_of(hour, DAY))
    return days.groupBy("point_id", F.col("day").alias("bucket")).agg(
        F.sum("n").alias("n"),
        F.sum("sum_value").alias("sum_value"),
        safe_divide(F.sum("sum_value"), F.sum("n")).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.min_by("first_value", hour).alias("first_value"),
        F.max_by("last_value", hour).alias("last_value"),
        F.sum("not_online_n").alias("not_online_n"),
    )


def realtime(rollup: DataFrame, live: DataFrame, mark: dt.datetime | None) -> DataFrame:
    """Stored buckets before `mark`, and live buckets from `mark` on.

    `live` is the rollup of source rows at or after `mark`.
    """
    if mark is None:
        return live.select(*ROLLUP_COLUMNS)
    stored = in_range(rollup, "bucket", end=mark)
    return stored.select(*ROLLUP_COLUMNS).unionByName(live.select(*ROLLUP_COLUMNS))


def create_rollup(spark: SparkSession, table: str, sample: DataFrame) -> None:
    """An empty, date-partitioned rollup table with the columns of `sample`."""
    empty = with_partition(sample.limit(0), "bucket")
    empty.write.partitionBy(PARTITION_COLUMN).format("parquet").option("compression", "zstd").saveAsTable(table)


def watermark(spark: SparkSession, table: str) -> dt.datetime | None:
    """End of the materialised range of a rollup table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == WATERMARK).collect()
    return dt.datetime.fromisoformat(rows[0]["value"]) if rows else None


def refresh(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    start: dt.datetime | None,
    end: dt.datetime,
    level: str = "1h",
) -> None:
    """Recompute the whole buckets inside `[start, end)`; no start means from the beginning.

    Touched dates are rewritten as (stored buckets outside the range) plus
    (recomputed buckets); other dates are not read. A bucket cut by either bound
    is left alone. Dates of the range that end up empty are dropped.
    """
    width, build, time_col = (HOUR, rollup_1h, "event_time") if level == "1h" else (DAY, rollup_1d, "bucket")
    low = ceil_to(start, width) if start is not None else None
    high = floor_to(end, width)
    if low is not None and low >= high:
        return
    stored = spark.table(table)
    day, bucket = F.col(PARTITION_COLUMN), F.col("bucket")
    last_day = (high - dt.timedelta(microseconds=1)).date()
    # Only the first and the last date can hold stored buckets outside the range.
    outside = bucket >= instant(high)
    edges = [F.lit(last_day)]
    if low is not None:
        outside = outside | (bucket < instant(low))
        edges.append(F.lit(low.date()))
    kept = stored.filter(day.isin(*edges) & outside)

    fresh = with_partition(build(in_range(source, time_col, low, high)), "bucket")
    inside = [d for d in partitions(spark, table) if (low is None or d >= low.date()) and d <= last_day]
    found = partition_files(spark, table, inside) if inside else {}
    rows = clustered(fresh.select(*stored.columns).unionByName(kept), "point_id", "bucket")
    done, left = replace_partitions(spark, table, rows, found)
    if left:
        raise RuntimeError(f"{table} was written to while it was refreshed; not replaced: {left}")
    for part in set(inside) - set(done):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PARTITION_COLUMN}='{part}')")
    spark.catalog.refreshTable(table)
    before = watermark(spark, table)
    mark = high if before is None else max(high, before)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{WATERMARK}'='{mark.isoformat()}')")


def refresh_due(
    spark: SparkSession, table: str, source: DataFrame, now: dt.datetime, level: str, retention_days: int | None = None
) -> None:
    """The refresh a caller schedules: a trailing window that leaves the newest bucket alone.

    With the days that the source is kept, a window that reaches past them is an error.
    """
    check_refresh_within_retention(level, retention_days)
    back, ahead = REFRESH_WINDOWS[level]
    refresh(spark, table, source, now - back, now - ahead, level)


def partitions(spark: SparkSession, table: str) -> list[dt.date]:
    """Partition dates of a table, oldest first."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(dt.date.fromisoformat(r[0].split("=", 1)[1]) for r in rows)


def _later(a: dt.datetime | None, b: dt.datetime | None) -> dt.datetime | None:
    return max((t for t in (a, b) if t is not None), default=None)


def _whole(start: dt.datetime | None, end: dt.datetime | None, width: Bucket) -> tuple:
    """Bounds of the source rows of the buckets that start in `[start, end)`."""
    return tuple(None if t is None else ceil_to(t, width) for t in (start, end))


def read_1h(
    spark: SparkSession,
    table: str,
    readings: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Real-time hourly read: the table, plus readings past its watermark.

    Only hours that start in `[start, end)`; both sides skip other partitions.
    """
    mark = watermark(spark, table)
    low, high = _whole(start, end, HOUR)
    live = rollup_1h(in_range(readings, "event_time", _later(mark, low), high))
    return realtime(in_range(spark.table(table), "bucket", low, high), live, mark)


def read_1d(
    spark: SparkSession,
    table: str,
    hourly_table: str,
    readings: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Real-time daily read; its live side reads the real-time hourly rows."""
    mark = watermark(spark, table)
    low, high = _whole(start, end, DAY)
    live = rollup_1d(read_1h(spark, hourly_table, readings, _later(mark, low), high))
    return realtime(in_range(spark.table(table), "bucket", low, high), live, mark)


def check_refresh_within_retention(level: str, retention_days: int | None) -> None:
    """A refresh window that reaches past retention would recompute from missing rows."""
    back, _ = REFRESH_WINDOWS[level]
    if retention_days is not None and back > dt.timedelta(days=retention_days):
        raise ValueError(f"the {level} refresh looks back {back}, past {retention_days} retained days")
