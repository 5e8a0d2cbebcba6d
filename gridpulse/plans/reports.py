"""The reporting queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.buckets import bucket_of, instant, local_day
from gridpulse.functions.scalars import element, round_half_away, safe_divide
from gridpulse.functions.values import any_over, any_value_of, open_rank
from gridpulse.operators.alarms import STORM_LIMIT
from gridpulse.operators.gapfill import readings_gapfilled
from gridpulse.operators.rollup import point_history, raw_readings, readings_rollup
from gridpulse.operators.rollups import DAY
from gridpulse.session import checkpointed


def power_curve(
    readings: DataFrame, points: DataFrame, start: dt.datetime, end: dt.datetime, bucket: str = "15 minutes",
    point_ids: list | DataFrame | None = None,
) -> DataFrame:
    """Gap-filled curve, rounded for display."""
    filled = readings_gapfilled(readings, points, start, end, bucket, point_ids=point_ids)
    return filled.select(
        "bucket_time", "point_id", round_half_away("value", 1).alias("kw"), "data_quality", "is_generated"
    )


def first_point(points: DataFrame, order: str = "name") -> DataFrame:
    """The point whose name sorts first, as a one-row point list."""
    return points.orderBy(order, "point_id").limit(1).select("point_id")


def daily_energy(
    readings: DataFrame, points: DataFrame, sites: DataFrame,
    start: dt.datetime | None = None, end: dt.datetime | None = None,
) -> DataFrame:
    """Energy per site and local day."""
    named = sites.select("site_id", F.col("name").alias("site"))
    catalog = points.join(named, "site_id")
    history = point_history(
        readings, catalog, sites, "day", start, end, "energy", carry=("site_id", "site", "timezone")
    )
    day = local_day(F.col("bucket_start"), F.col("timezone"))
    summed = history.groupBy("site_id", "site", day.alias("local_day")).agg(F.sum("value").alias("kwh"))
    return summed.select("site_id", "site", "local_day", round_half_away("kwh", 0).alias("kwh"))


def weather_and_energy(energy: DataFrame, day_factors: DataFrame) -> DataFrame:
    """The day's factor next to its energy, with a storm note.

    Both sides are local days, so a day's energy is that of the whole local day.
    """
    note = F.when(F.col("factor") < STORM_LIMIT, "** storm **").otherwise("")
    return energy.join(day_factors.select("site_id", "local_day", "factor"), ["site_id", "local_day"]).select(
        "site", "local_day", "factor", note.alias("note"), "kwh"
    )


def alarm_board(history: DataFrame, limit: int = 25) -> DataFrame:
    """Active alarms first, then the newest."""
    rows = history.orderBy(F.col("is_active").desc(), F.col("raised_at").desc(), "alarm_history_id").limit(limit)
    return rows.select(
        "alarm_name",
        F.col("source").alias("device"),
        "severity",
        "is_active",
        "raised_at",
        "cleared_at",
        F.col("acknowledged_at").isNotNull().alias("acked"),
        F.left("message", F.lit(60)).alias("message"),
    )


def open_requests(queue: DataFrame, devices: DataFrame, limit: int = 20, site_id: object = None) -> DataFrame:
    """Newest requests still in flight, with their first setpoint."""
    if site_id is not None:
        queue = queue.filter(F.col("site_id") == site_id)
    newest = (
        queue.filter(open_rank() == 1)
        .orderBy(F.col("created_at").desc(), F.col("control_request_id").desc())
        .limit(limit)
    )
    return newest.join(devices.select("device_id", F.col("name").alias("device")), "device_id", "left").select(
        "created_at",
        "control_request_id",
        "status",
        "source",
        "device",
        element("value", 1).alias("setpoint_kw"),
        F.left("description", F.lit(40)).alias("description"),
    )


def audit_trail(audit: DataFrame, order: str = "updated_at", at_least: int = 4) -> DataFrame:
    """All transitions of the newest request that has at least `at_least` of them."""
    pick = (
        audit.groupBy("control_request_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("newest"))
        .filter(F.col("n") >= at_least)
        .orderBy(F.col("newest").desc(), F.col("control_request_id").desc())
        .limit(1)
        .select("control_request_id")
    )
    return audit.join(pick, "control_request_id")


def hourly_averages(readings: DataFrame, points: DataFrame, start: dt.datetime | None, end: dt.datetime | None) -> DataFrame:
    """Hourly average of every given point, with its name."""
    rolled = readings_rollup(readings, points, start, end, "1 hour", carry=("name",))
    return rolled.select(
        "bucket_start", "point_id", "name", round_half_away("avg_value", 1).alias("avg_value")
    )


def quality_sweep(readings: DataFrame) -> DataFrame:
    """Count and time span of every quality other than online."""
    bad = readings.filter(F.col("data_quality") != "online")
    return bad.groupBy("data_quality").agg(
        F.count(F.lit(1)).alias("readings"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def plant_tree(tree: DataFrame) -> DataFrame:
    """Tree names indented by depth."""
    indent = F.repeat(F.lit("  "), F.col("depth") - 1)
    return tree.withColumn("plant", F.concat(indent, "name"))


def point_day_stats(readings: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Count and average per point and day."""
    raw = raw_readings(readings, start, end).withColumn("day", bucket_of(F.col("event_time"), DAY))
    return raw.groupBy("point_id", "day").agg(F.count(F.lit(1)).alias("n"), F.avg(any_value_of()).alias("avg_value"))


def count_over(readings: DataFrame, limit: float, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """How many raw readings exceed a value."""
    return raw_readings(readings, start, end).filter(any_over(limit)).agg(F.count(F.lit(1)).alias("n"))


def daily_report_raw(readings: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Daily average and maximum per point from raw readings."""
    raw = raw_readings(readings, start, end).withColumn("day", bucket_of(F.col("event_time"), DAY))
    value = any_value_of()
    return raw.groupBy("day", "point_id").agg(F.avg(value).alias("avg_value"), F.max(value).alias("max_value"))


def daily_report_rollup(daily: DataFrame) -> DataFrame:
    """The same report from the daily table."""
    return daily.select(F.col("bucket").alias("day"), "point_id", "avg_value", "max_value")


def hourly_report_rollup(hourly: DataFrame) -> DataFrame:
    """The report at hourly grain."""
    return hourly.select("bucket", "point_id", "avg_value", "max_value")


def daily_report_hourly(hourly: DataFrame) -> DataFrame:
    """The daily report from the hourly table."""
    days = hourly.groupBy(bucket_of(F.col("bucket"), DAY).alias("day"), "point_id")
    return days.agg(safe_divide(F.sum("sum_value"), F.sum("n")).alias("avg_value"), F.max("max_value").alias("max_value"))


def raw_vs_rollup(raw_daily: DataFrame, daily: DataFrame, digits: int = 2) -> DataFrame:
    """Both daily averages side by side."""
    stored = daily.select(F.col("bucket").alias("day"), "point_id", F.col("avg_value").alias("_stored"))
    return raw_daily.join(stored, ["day", "point_id"]).select(
        "day",
        "point_id",
        round_half_away("avg_value", digits).alias("raw_avg"),
        round_half_away("_stored", digits).alias("rollup_avg"),
    )


def rows_available(named: dict[str, tuple[DataFrame, str]], start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows per table in a closed time range."""
    parts = []
    for name, (df, time_col) in named.items():
        low, high = (instant(v) for v in (start, end))
        kept = df.filter(F.col(time_col).between(low, high))
        parts.append(kept.agg(F.count(F.lit(1)).alias("rows_available")).select(F.lit(name).alias("source"), "rows_available"))
    return _stack(parts)


def time_spans(named: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest time per table."""
    parts = [
        df.agg(F.min(c).alias("earliest"), F.max(c).alias("latest")).select(F.lit(name).alias("source"), "earliest", "latest")
        for name, (df, c) in named.items()
    ]
    return _stack(parts)


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return _stack([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in named.items()
    ])


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_points(totals: DataFrame, measure: str, limit: int) -> DataFrame:
    """Points with the largest measure, numbered; ranks are given after the cut,
    so numbering sees at most `limit` rows."""
    top = totals.orderBy(F.col(measure).desc_nulls_last(), "point_id").limit(limit)
    order = Window.orderBy(F.col(measure).desc_nulls_last(), "point_id")
    return top.select(F.row_number().over(order).alias("rank"), "point_id", measure)


def share_of_total(groups: DataFrame, measure: str) -> DataFrame:
    """Percent of the total per group, 0 when the total is 0.

    The groups are checkpointed: they are needed for the total and for the shares,
    and a window over all of them would run in one task.
    """
    groups = checkpointed(groups)
    total = groups.agg(F.sum(measure)).scalar()
    share = F.when(total > 0, safe_divide(100.0 * F.col(measure), total)).otherwise(F.lit(0.0))
    return groups.withColumn("percent", F.round(share, 2))
