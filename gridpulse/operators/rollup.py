"""Bucketed statistics per point, energy, and the point history entry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.buckets import Bucket, bucket_of, sample_bucket, to_local, to_utc
from gridpulse.functions.scalars import safe_divide
from gridpulse.functions.values import (
    collapse_quality,
    pick_value,
    quality_code,
    reading_value,
    uom_conversion_factor,
)
from gridpulse.sources.tables import in_range

TYPED = ("value_bigint", "value_double", "value_numeric")


def raw_readings(
    readings: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    point_ids: list | None = None,
) -> DataFrame:
    """Raw rows in `[start, end)`, heartbeats left out, optionally of some points."""
    out = in_range(readings.filter(F.col("reading_type") == "raw"), "event_time", start, end)
    return out if point_ids is None else out.filter(F.col("point_id").isin(list(point_ids)))


def choose_points(points: DataFrame, point_ids: list | DataFrame | None) -> tuple[DataFrame, list | None]:
    """Point ids given as a table cut the catalog, whose join then selects the
    readings; a list is pushed down to the scan."""
    if isinstance(point_ids, DataFrame):
        return points.join(point_ids.select("point_id"), "point_id", "left_semi"), None
    return points, point_ids


def _stats(value: Column, t: Column, prefix: str = "") -> list[Column]:
    return [
        F.count(value).alias(f"{prefix}n_value"),
        F.sum(value).alias(f"{prefix}sum_value"),
        F.min(value).alias(f"{prefix}min_value"),
        F.max(value).alias(f"{prefix}max_value"),
        F.min_by(value, t).alias(f"{prefix}first_value"),
        F.max_by(value, t).alias(f"{prefix}last_value"),
    ]


_STATS = ("n_value", "sum_value", "min_value", "max_value", "first_value", "last_value")


def _shared() -> list[Column]:
    q = quality_code()
    return [F.count(F.lit(1)).alias("sample_count"), F.min(q).alias("q_low"), F.max(q).alias("q_high")]


def _by_site_clock(raw: DataFrame, catalog: DataFrame, width: Bucket, carry: list[str]) -> DataFrame:
    """Readings meet their point's type and zone, then are grouped on that clock.

    The planner broadcasts the catalog while it is small; beyond that readings are
    shuffled by point, which the grouping then needs no second shuffle for.
    """
    typed = raw.join(catalog, "point_id").withColumn("value", reading_value())
    local = typed.withColumn("bucket", bucket_of(to_local(F.col("event_time"), F.col("timezone")), width))
    return local.groupBy("point_id", "bucket", *carry).agg(*_shared(), *_stats(F.col("value"), F.col("event_time")))


def _by_one_clock(raw: DataFrame, catalog: DataFrame, width: Bucket, tz: str, carry: list[str]) -> DataFrame:
    """Each typed column is grouped, the point's type picks one afterwards, so the
    join moves one row per point and bucket and never a reading."""
    t = F.col("event_time")
    stats = [s for c in TYPED for s in _stats(F.col(c).cast("double"), t, f"{c}_")]
    local = raw.withColumn("bucket", bucket_of(to_local(t, tz), width))
    wide = local.groupBy("point_id", "bucket").agg(*_shared(), *stats)
    picked = [reading_value("value_type", *[f"{c}_{n}" for c in TYPED]).alias(n) for n in _STATS]
    return wide.join(catalog, "point_id").select("point_id", *carry, "bucket", "sample_count", "q_low", "q_high", *picked)


def readings_rollup(
    readings: DataFrame,
    points: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    bucket: Bucket | str = "1 hour",
    tz: str | None = "UTC",
    point_ids: list | DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Count, avg, min, max, sum, first, last and quality per point and bucket.

    Buckets follow the clock of `tz`; with `tz=None` each point's own `timezone`
    column is used. `bucket_end` is the next boundary on that clock. `carry` names
    columns of `points` that the result keeps, so that they need no second join.
    (event_time, point_id) is the key of readings: of rows that repeat it, first and
    last value are either one's.
    """
    width = Bucket.of(bucket)
    points, listed = choose_points(points, point_ids)
    raw = raw_readings(readings, start, end, listed)
    extra = list(dict.fromkeys([*carry, *(["timezone"] if tz is None else [])]))
    catalog = points.select("point_id", "value_type", *extra)
    grouped = _by_site_clock(raw, catalog, width, extra) if tz is None else _by_one_clock(raw, catalog, width, tz, extra)
    zone = F.col("timezone") if tz is None else tz
    b = F.col("bucket")
    return grouped.select(
        "point_id",
        to_utc(b, zone).alias("bucket_start"),
        to_utc(b + width.step, zone).alias("bucket_end"),
        "sample_count",
        safe_divide("sum_value", "n_value").alias("avg_value"),
        "min_value", "max_value", "sum_value", "first_value", "last_value",
        collapse_quality("q_low", "q_high").alias("data_quality"),
        *carry,
    )


def power_to_energy(
    readings: DataFrame,
    points: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    bucket: Bucket | str = "1 hour",
    tz: str | None = "UTC",
    point_ids: list | DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Average power times the bucket's nominal hours, in the rollup unit.

    A bucket cut by `start` or `end` still counts its full nominal length.
    """
    width = Bucket.of(bucket)
    rolled = readings_rollup(readings, points, start, end, width, tz, point_ids, ("uom", "rollup_uom", *carry))
    energy = F.col("avg_value") * F.lit(width.nominal_hours) * uom_conversion_factor("uom", "rollup_uom")
    return rolled.select(
        "point_id", "bucket_start", "bucket_end", "sample_count",
        F.col("avg_value").alias("avg_power"),
        energy.alias("energy"),
        F.col("rollup_uom").alias("energy_uom"),
        "data_quality",
        *carry,
    )


def point_history(
    readings: DataFrame,
    points: DataFrame,
    sites: DataFrame,
    sample_time: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    value_kind: str = "avg",
    site_id: object = None,
    point_ids: list | DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One value column per point and bucket, bucketed on the site's clock.

    With `site_id` that site's zone serves every requested point. Without it all
    sites are answered in one plan, each point on the clock of its own site, and
    `carry` may name `site_id`, `timezone` and further columns of the points.
    """
    width = sample_bucket(sample_time)
    kind = value_kind.lower()
    if site_id is not None:
        zone = sites.filter(F.col("site_id") == site_id).select("timezone").first()
        if zone is None or zone[0] is None:
            raise ValueError(f"unknown site {site_id!r}")
        tz, catalog = zone[0], points
    else:
        tz, catalog = None, points.join(sites.select("site_id", "timezone"), "site_id")
    args = (readings, catalog, start, end, width, tz, point_ids, carry)
    if kind == "energy":
        rows, value = power_to_energy(*args), F.col("energy")
    else:
        rows, value = readings_rollup(*args), pick_value(kind)
    return rows.select(
        "point_id", "bucket_start", "bucket_end", value.alias("value"), F.lit(kind).alias("value_kind"),
        "data_quality", *carry,
    )
