"""Silence during outages, boundary markers, and gaps in the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.buckets import Bucket, bucket_of, date_bin, instant
from gridpulse.operators.merge import upsert

_DAY = "INTERVAL '1' DAY"


def daily_intervals(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Intervals cut at midnight, overlapping ones of a key and day merged.

    Afterwards a key has few, disjoint intervals on any one day, so a lookup by
    (key, day) compares an instant with those only.
    """
    tick = F.expr("INTERVAL '0.000001' SECOND")
    days = F.sequence(F.to_date(start), F.to_date(F.col(end) - tick), F.expr("INTERVAL '1' DAY"))
    cut = intervals.filter(F.col(end) > F.col(start)).withColumn("_day", F.explode(days))
    midnight = F.col("_day").cast("timestamp_ntz")
    cut = cut.select(
        *keys,
        "_day",
        F.greatest(F.col(start), midnight).alias("_from"),
        F.least(F.col(end), midnight + F.expr(_DAY)).alias("_to"),
    )
    cut = cut.groupBy(*keys, "_day", "_from").agg(F.max("_to").alias("_to"))
    ordered = Window.partitionBy(*keys, "_day").orderBy("_from")
    reach = F.max("_to").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = cut.withColumn("_new", (reach.isNull() | (F.col("_from") > reach)).cast("int"))
    island = F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_island", island)
        .groupBy(*keys, "_day", "_island")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .drop("_island")
    )


def not_covered(rows: DataFrame, time: str, intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows whose time lies in no half-open interval of the same key.

    An anti join on (key, day) with a range condition. The planner broadcasts
    the intervals while they are small; beyond that both sides are shuffled by
    key and day, and a hot day is split at run time.
    """
    spans = daily_intervals(intervals, keys, start, end)
    spans = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], "_day", "_from", "_to")
    t = F.col(time)
    match = (F.to_date(t) == F.col("_day")) & (t >= F.col("_from")) & (t < F.col("_to"))
    for k in keys:
        match = match & (F.col(k) == F.col(f"_{k}"))
    return rows.join(spans, match, "left_anti")


def silence(readings: DataFrame, outages: DataFrame, device_points: DataFrame | None = None) -> DataFrame:
    """Readings outside every outage of their device.

    The device mapping is joined to the outages, never to the readings.
    """
    if device_points is None:
        spans = outages.withColumnRenamed("device_id", "point_id")
    else:
        spans = outages.join(device_points.select("device_id", "point_id"), "device_id")
    return not_covered(readings, "event_time", spans, ["point_id"], "start_at", "end_at")


def outage_markers(
    outages: DataFrame,
    power_points: DataFrame,
    status_points: DataFrame,
    width: Bucket | str = "5 minutes",
    after: dt.datetime | None = None,
) -> DataFrame:
    """One last reading where an outage begins: power 0 and status 2, offline.

    `power_points` and `status_points` map device_id to point_id. Outages that
    fall into one bin give one marker.
    """
    binned = outages.withColumn("event_time", date_bin(F.col("start_at"), width))
    if after is not None:
        binned = binned.filter(F.col("event_time") > instant(after))
    at = binned.select("device_id", "event_time").distinct()
    power = power_points.select("device_id", "point_id", F.lit(0.0).alias("value_double"), F.lit(None).cast("bigint").alias("value_bigint"))
    status = status_points.select("device_id", "point_id", F.lit(None).cast("double").alias("value_double"), F.lit(2).cast("bigint").alias("value_bigint"))
    marks = at.join(power.unionByName(status), "device_id")
    return marks.select("event_time", "point_id", "value_double", "value_bigint", F.lit("offline").alias("data_quality")).dropDuplicates(
        ["event_time", "point_id"]
    )


def apply_markers(readings: DataFrame, markers: DataFrame) -> DataFrame:
    """Readings with the markers written over any reading at the same instant."""
    rows = markers.withColumn("reading_type", F.lit("raw"))
    return upsert(readings, rows, ["event_time", "point_id"], ["value_double", "value_bigint", "data_quality"])


def data_gaps(readings: DataFrame, limit_s: int = 300, now: dt.datetime | None = None) -> DataFrame:
    """Stretches of more than `limit_s` seconds without a reading, per point.

    Readings are first reduced to the first and last time per point and
    `limit_s`-wide bin: a longer gap cannot lie inside one bin, so comparing
    neighbouring bins is exact and no point's readings are ever sorted. With
    `now`, the silence after the last reading is reported with an open end.
    """
    t = F.col("event_time")
    bins = (
        readings.withColumn("_bin", bucket_of(t, Bucket(seconds=limit_s)))
        .groupBy("point_id", "_bin")
        .agg(F.min(t).alias("first_time"), F.max(t).alias("last_time"))
    )
    following = F.lead("first_time").over(Window.partitionBy("point_id").orderBy("_bin"))
    pairs = bins.select("point_id", F.col("last_time").alias("gap_start"), following.alias("gap_end"))
    until = F.col("gap_end")
    if now is not None:
        until = F.coalesce(until, instant(now))
    long_gap = until > F.col("gap_start") + F.expr(f"INTERVAL '{limit_s}' SECOND")
    return pairs.filter(long_gap)
