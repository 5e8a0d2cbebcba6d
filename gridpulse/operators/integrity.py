"""Declared constraints checked over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _violation(rows: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def check(rows: DataFrame, rule: str, ok: Column, key: Column, detail: Column) -> DataFrame:
    """Rows for which a CHECK is false; as in SQL, an unknown result passes."""
    return _violation(rows.filter(~ok), rule, key, detail)


def unique(rows: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _violation(counts, rule, F.concat_ws("|", *keys), F.col("_n"))


def references(rows: DataFrame, rule: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct values without a parent row, with the number of rows that hold them.

    Children are counted per value first, so the join sees each value once.
    """
    used = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_key).alias("_k"))
    return _violation(used.join(known, "_k", "left_anti"), rule, F.col("_k"), F.col("_n"))


def audit_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of the model's constraints in the tables given, as one table."""
    found: list[DataFrame] = []
    get = tables.get

    if (t := get("value_maps")) is not None:
        sizes = F.size("display_values"), F.size("int_values")
        found.append(
            check(t, "value_maps_parallel_arrays", sizes[0] == sizes[1], F.col("value_map_id"),
                  F.concat_ws("<>", *[s.cast("string") for s in sizes]))
        )
    if (t := get("points")) is not None:
        found.append(unique(t, "points_key", ["point_id"]))
        if "eng_low" in t.columns:
            found.append(
                check(t, "points_eng_range", F.col("eng_high") >= F.col("eng_low"), F.col("point_id"),
                      F.concat_ws("..", F.col("eng_low").cast("string"), F.col("eng_high").cast("string")))
            )
        if (sites := get("sites")) is not None:
            found.append(references(t, "points_site", "site_id", sites, "site_id"))
    if (t := get("device_hierarchy")) is not None:
        found.append(
            check(t, "hierarchy_no_self", F.col("parent_device_id") != F.col("child_device_id"),
                  F.col("child_device_id"), F.col("parent_device_id"))
        )
        if (devices := get("devices")) is not None:
            found.append(references(t, "hierarchy_parent", "parent_device_id", devices, "device_id"))
            found.append(references(t, "hierarchy_child", "child_device_id", devices, "device_id"))
    if (t := get("outages")) is not None:
        found.append(
            check(t, "outages_order", F.col("end_at") > F.col("start_at"), F.col("outage_id"), F.col("end_at"))
        )
    if (t := get("retention_settings")) is not None:
        found.append(
            check(t, "retention_not_negative", F.col("retention_days") >= 0, F.col("table_name"), F.col("retention_days"))
        )
        found.append(unique(t, "retention_table", ["table_name"]))
    if (t := get("settings")) is not None:
        found.append(unique(t, "settings_site_name", ["site_id", "setting_name"]))
    if (t := get("point_readings")) is not None:
        found.append(unique(t, "readings_key", ["event_time", "point_id"]))
        if (points := get("points")) is not None:
            found.append(references(t, "readings_point", "point_id", points, "point_id"))
    if (t := get("control_requests")) is not None:
        found.append(unique(t, "requests_key", ["created_at", "control_request_id"]))
    if (t := get("device_points")) is not None:
        found.append(unique(t, "device_points_key", ["device_id", "point_id"]))
        if (points := get("points")) is not None:
            found.append(references(t, "device_points_point", "point_id", points, "point_id"))
        if (devices := get("devices")) is not None:
            found.append(references(t, "device_points_device", "device_id", devices, "device_id"))
    if not found:
        raise ValueError("no table with constraints was given")
    return reduce(DataFrame.unionByName, found)
