"""Points computed from other points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.scalars import round_half_away
from gridpulse.functions.values import any_value_of

# Fixed value: share of the summed power that reaches the site meter.
COLLECTION_FACTOR = 0.985


def site_meter(readings: DataFrame, source_points: DataFrame, meter_points: DataFrame) -> DataFrame:
    """Per instant and site: the sum of the source points less collection losses.

    `source_points` has point_id and site_id, `meter_points` the meter's point_id
    per site. The meter is attached after the sum, on one row per instant and site.
    """
    sources = source_points.select("point_id", "site_id")
    power = readings.withColumn("_v", any_value_of()).join(sources, "point_id")
    total = power.groupBy("event_time", "site_id").agg(F.sum("_v").alias("_total"))
    meters = meter_points.select("site_id", "point_id")
    return total.join(meters, "site_id").select(
        "event_time",
        "point_id",
        round_half_away(F.col("_total") * COLLECTION_FACTOR, 1).alias("value_double"),
        F.lit("online").alias("data_quality"),
    )


def derived_sum(readings: DataFrame, derived: DataFrame, sources: DataFrame) -> DataFrame:
    """Derived points as the sum of their sources at each instant.

    With `require_all_sources` an instant counts only when every source reports.
    """
    wanted = sources.groupBy("point_id").agg(F.countDistinct("source_point_id").alias("_wanted"))
    rules = derived.select("point_id", "require_all_sources").join(wanted, "point_id")
    rows = readings.select("event_time", F.col("point_id").alias("source_point_id"), any_value_of().alias("_v"))
    joined = rows.join(sources.select("point_id", "source_point_id"), "source_point_id")
    summed = joined.groupBy("point_id", "event_time").agg(F.sum("_v").alias("value"), F.count("_v").alias("n_sources"))
    complete = ~F.col("require_all_sources") | (F.col("n_sources") >= F.col("_wanted"))
    return summed.join(rules, "point_id").filter(complete).select("point_id", "event_time", "value", "n_sources")
