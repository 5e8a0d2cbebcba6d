"""The driver's TPC-H-like tables seen as the telemetry model.

Each view covers its whole base table; see FIXTURES.md for the definitions.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _case(col: Column, mapping: dict, default: object) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out.otherwise(default)


class Plant:
    """Lazy views over one folder of base tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.base("events")

    @cached_property
    def sites(self) -> DataFrame:
        zone = _case(
            F.col("n_regionkey"),
            {0: "UTC", 1: "America/Chicago", 2: "Asia/Kolkata", 3: "America/Phoenix"},
            "America/Denver",
        )
        return self.base("nation").select(
            F.col("n_nationkey").alias("site_id"), F.col("n_name").alias("name"), zone.alias("timezone")
        )

    @cached_property
    def points(self) -> DataFrame:
        key = F.col("c_custkey")
        segment = F.col("c_mktsegment")
        return self.base("customer").select(
            key.alias("point_id"),
            F.col("c_nationkey").alias("site_id"),
            F.col("c_name").alias("name"),
            _case(key % 3, {0: "int64", 1: "float64"}, "numeric").alias("value_type"),
            _case(
                segment, {"AUTOMOBILE": "W", "BUILDING": "kW", "MACHINERY": "MW", "HOUSEHOLD": "Wh"}, "degC"
            ).alias("uom"),
            F.when(segment != "FURNITURE", "kWh").alias("rollup_uom"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        user, value = F.col("user_id"), F.col("value")
        return self.events.select(
            F.col("ts").alias("event_time"),
            user.alias("point_id"),
            F.when(F.col("event_id") % 20 == 0, "heartbeat").otherwise("raw").alias("reading_type"),
            F.when(user % 3 == 0, F.floor(value).cast("bigint")).alias("value_bigint"),
            F.when(user % 3 == 1, value).alias("value_double"),
            F.when(user % 3 == 2, value.cast("decimal(38,9)")).alias("value_numeric"),
            _case(
                F.col("event_type"),
                {"view": "online", "click": "online", "purchase": "estimated", "signup": "over_range"},
                "offline",
            ).alias("data_quality"),
        )

    @cached_property
    def control_log(self) -> DataFrame:
        """One row per control submission. `arrival` is a sortable struct rather
        than a row number, so no request's rows are gathered to number them."""
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("control_request_id"),
            F.col("l_suppkey").alias("device_id"),
            F.col("l_partkey").alias("point_id"),
            F.col("l_quantity").cast("decimal(18,9)").alias("setpoint"),
            _case(
                F.col("l_linenumber"), {1: "queued", 2: "accepted", 3: "active", 4: "completed"}, "failed"
            ).alias("status"),
            (F.col("l_returnflag") == "R").alias("is_internal"),
            F.col("l_shipdate").alias("updated_at"),
            F.col("l_linenumber").alias("line"),
            F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("arrival"),
        )

    @cached_property
    def day_factors(self) -> DataFrame:
        counts = self.readings.groupBy("point_id", F.to_date("event_time").alias("utc_day")).agg(
            F.count("*").alias("n")
        )
        per_site = (
            counts.join(self.points.select("point_id", "site_id"), "point_id")
            .groupBy("site_id", "utc_day")
            .agg(F.sum("n").alias("n"))
        )
        return per_site.select("site_id", "utc_day", ((F.col("n") % 10).cast("double") / 10).alias("factor"))

    @cached_property
    def outages(self) -> DataFrame:
        minutes = F.floor(F.col("value")).cast("int")
        zero = F.lit(0)
        return self.events.filter(F.col("event_type") == "error").select(
            F.col("event_id").alias("outage_id"),
            F.col("user_id").alias("device_id"),
            F.col("ts").alias("start_at"),
            (F.col("ts") + F.make_dt_interval(zero, zero, minutes, F.lit(0).cast("decimal(18,6)"))).alias("end_at"),
        )

    @cached_property
    def devices(self) -> DataFrame:
        """Regions, nations and suppliers as one equipment list; a region is a site."""
        region, nation, supplier = self.base("region"), self.base("nation"), self.base("supplier")
        n = nation.select("n_nationkey", "n_regionkey")
        top = region.select(
            F.concat(F.lit("R"), "r_regionkey").alias("device_id"),
            F.col("r_regionkey").alias("site_id"),
            F.col("r_name").alias("name"),
            F.lit(1).alias("device_type_id"),
        )
        middle = nation.select(
            F.concat(F.lit("N"), "n_nationkey").alias("device_id"),
            F.col("n_regionkey").alias("site_id"),
            F.col("n_name").alias("name"),
            F.lit(2).alias("device_type_id"),
        )
        bottom = supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit("S"), "s_suppkey").alias("device_id"),
            F.col("n_regionkey").alias("site_id"),
            F.col("s_name").alias("name"),
            F.lit(3).alias("device_type_id"),
        )
        return top.unionByName(middle).unionByName(bottom)

    @cached_property
    def device_types(self) -> DataFrame:
        """The equipment classes that occur."""
        label = _case(F.col("device_type_id"), {1: "plant_controller", 2: "meter"}, "inverter")
        return self.devices.select("device_type_id").distinct().select("device_type_id", label.alias("name"))

    @cached_property
    def hierarchy(self) -> DataFrame:
        nation, supplier = self.base("nation"), self.base("supplier")
        upper = nation.select(
            F.concat(F.lit("R"), "n_regionkey").alias("parent_device_id"),
            F.concat(F.lit("N"), "n_nationkey").alias("child_device_id"),
        )
        lower = supplier.select(
            F.concat(F.lit("N"), "s_nationkey").alias("parent_device_id"),
            F.concat(F.lit("S"), "s_suppkey").alias("child_device_id"),
        )
        return upper.unionByName(lower)

    @cached_property
    def device_points(self) -> DataFrame:
        """Customers hang below their nation."""
        return self.base("customer").select(
            F.concat(F.lit("N"), "c_nationkey").alias("device_id"), F.col("c_custkey").alias("point_id")
        )

    @cached_property
    def span(self) -> tuple[dt.datetime, dt.datetime]:
        from gridpulse.sources.tables import time_span

        return time_span(self.readings, "event_time")

    @cached_property
    def now(self) -> dt.datetime:
        """The clock of the reports: noon of the last day with readings."""
        return self.span[1] - dt.timedelta(hours=12)
