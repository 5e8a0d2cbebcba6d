"""A regular time grid per point with the last value carried forward."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.buckets import Bucket, bucket_of, instant, is_utc, to_local, to_utc
from gridpulse.functions.values import quality_code, quality_label, reading_value
from gridpulse.operators.rollup import TYPED, choose_points, raw_readings


def _last_per_bucket(raw: DataFrame, points: DataFrame, width: Bucket, tz: str) -> DataFrame:
    """Newest value and quality of every point and bucket that has a sample.

    Readings are grouped before the join, so it moves a row per point and bucket.
    """
    t = F.col("event_time")
    raw = raw.withColumn("bucket", bucket_of(to_local(t, tz), width))
    grouped = raw.groupBy("point_id", "bucket").agg(
        *[F.max_by(F.col(c), t).alias(c) for c in TYPED], F.max_by(quality_code(), t).alias("q")
    )
    wide = grouped.join(points.select("point_id", "value_type"), "point_id")
    return wide.select("point_id", "bucket", reading_value().alias("value"), "q")


def readings_gapfilled(
    readings: DataFrame,
    points: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    bucket: Bucket | str,
    tz: str = "UTC",
    point_ids: list | DataFrame | None = None,
) -> DataFrame:
    """Every bucket from the one holding `start` up to `end`, for points seen in
    the range. Buckets without a sample repeat the last one and are flagged.

    Readings are reduced to one row per bucket before the window, and each such
    row then emits its own run of grid rows: no grid join, and a point's window
    never holds more rows than the grid has buckets.
    """
    width = Bucket.of(bucket)
    points, listed = choose_points(points, point_ids)
    seen = _last_per_bucket(raw_readings(readings, start, end, listed), points, width, tz)

    in_order = Window.partitionBy("point_id").orderBy("bucket")
    bounds = bucket_of(to_local(instant(start), tz), width)
    stop = to_local(instant(end), tz)
    run = (
        seen.withColumn("grid_start", bounds)
        .withColumn("is_first", F.lag("bucket").over(in_order).isNull())
        .withColumn("next", F.coalesce(F.lead("bucket").over(in_order), stop))
    )
    first = F.when(F.col("is_first"), F.col("grid_start")).otherwise(F.col("bucket"))
    last = F.col("next") - F.expr("INTERVAL '0.000001' SECOND")
    grid = run.withColumn("slot", F.explode(F.sequence(first, last, width.step)))

    slot, own = F.col("slot"), F.col("bucket")
    carried = slot >= own
    out = grid.select(
        to_utc(slot, tz).alias("bucket_time"),
        "point_id",
        F.when(carried, F.col("value")).alias("value"),
        F.when(carried, quality_label("q")).alias("data_quality"),
        (slot != own).alias("is_generated"),
        "slot",
    )
    if not is_utc(tz):
        # A wall clock skipped by daylight saving is not a bucket of its own.
        out = out.filter(to_local(F.col("bucket_time"), tz) == slot)
    return out.drop("slot")
