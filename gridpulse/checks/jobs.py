"""Partition jobs run over a written copy of the readings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.registry import query
from gridpulse.checks.views import r
from gridpulse.functions.scalars import round_half_away
from gridpulse.functions.values import any_value_of
from gridpulse.operators.merge import set_retention_days
from gridpulse.plans import lifecycle as lc
from gridpulse.schemas import SCHEMAS
from gridpulse.session import run_database
from gridpulse.sources.adapters import Plant
from gridpulse.sources.tables import PARTITION_COLUMN, append, create_partitioned, with_partition

_WEEK = dt.timedelta(days=7)


def stored_readings(p: Plant, label: str) -> tuple[str, str, str]:
    """(database, readings table, compaction log) with all readings written."""
    db = run_database(p.spark, label)
    table, log = f"{db}.point_readings", f"{db}.compaction_logs"
    create_partitioned(p.spark, table, with_partition(p.readings, "event_time"), ("event_time",))
    lc.create_log(p.spark, log, "compaction_logs")
    return db, table, log


#: Written copies by application, folder and label, shared by the queries that only read them.
_SHARED: dict[tuple, tuple] = {}


def shared(p: Plant, label: str, build: Callable[[Plant, str], tuple]) -> tuple:
    key = (p.spark.sparkContext.applicationId, p.sf_dir, label)
    if key not in _SHARED:
        _SHARED[key] = build(p, label)
    return _SHARED[key]


def _compact(p: Plant, label: str) -> tuple[str, str, str]:
    db, table, log = stored_readings(p, label)
    lc.compact_eligible(p.spark, [table], log, p.now)
    return db, table, log


def _compacted(p: Plant) -> tuple[str, str, str]:
    return shared(p, "compact", _compact)


@query("compacted_readings", f"""
    SELECT CAST(event_time AS DATE) AS event_date, event_time, point_id, data_quality, {r('v')} AS v FROM valued""")
def compacted_readings(p: Plant) -> DataFrame:
    """Compaction changes the layout of a table, never its rows."""
    _, table, _ = _compacted(p)
    return p.spark.table(table).select(
        PARTITION_COLUMN, "event_time", "point_id", "data_quality", round_half_away(any_value_of(), 4).alias("v")
    )


_STATES = """
    SELECT CAST(event_time AS DATE) AS partition_date, count(*) AS n,
           CASE WHEN CAST(event_time AS DATE) + INTERVAL 1 DAY < now_at - INTERVAL 7 DAY THEN 'Compacted' ELSE 'Hot' END AS state
    FROM readings, span GROUP BY 1, 3"""


@query("partition_inventory", f"""
    SELECT 'point_readings' AS parent_object, 'fact' AS parent_type, partition_date, state, n AS rows,
           CAST(partition_date AS TIMESTAMP) AS range_start, CAST(partition_date AS TIMESTAMP) + INTERVAL 1 DAY AS range_end,
           1 AS width_days
    FROM ({_STATES})""")
def inventory(p: Plant) -> DataFrame:
    """One row per partition after compaction, with the rows it holds."""
    _, table, log = _compacted(p)
    return lc.partition_inventory(p.spark, table, log).drop("files", "bytes", "gib")


@query("compaction_progress", f"""
    SELECT 'point_readings' AS parent_object, count(*) AS partitions, count(*) FILTER (WHERE state = 'Compacted') AS compacted,
           count(*) FILTER (WHERE state = 'Hot') AS hot,
           round(100.0 * count(*) FILTER (WHERE state = 'Compacted') / count(*), 1)::DOUBLE AS pct_compacted,
           CAST(min(partition_date) AS TIMESTAMP) AS oldest, CAST(max(partition_date) AS TIMESTAMP) + INTERVAL 1 DAY AS newest
    FROM ({_STATES})""")
def progress(p: Plant) -> DataFrame:
    _, table, log = _compacted(p)
    return lc.compaction_progress(lc.partition_inventory(p.spark, table, log))


@query("table_sizes", f"""
    SELECT 'point_readings' AS parent_object, 'fact' AS parent_type, CAST(sum(n) AS BIGINT) AS rows,
           CAST(sum(CASE WHEN state = 'Hot' THEN n ELSE 0 END) AS BIGINT) AS hot_rows,
           CAST(sum(CASE WHEN state = 'Hot' THEN 0 ELSE n END) AS BIGINT) AS compacted_rows,
           count(*) FILTER (WHERE state = 'Hot') AS hot_partitions,
           count(*) FILTER (WHERE state = 'Compacted') AS compacted_partitions
    FROM ({_STATES})""")
def table_sizes(p: Plant) -> DataFrame:
    _, table, log = _compacted(p)
    sizes = lc.table_sizes(lc.partition_inventory(p.spark, table, log))
    return sizes.drop("total_bytes", "total_gib", "hot_bytes", "compacted_bytes")


@query("compaction_savings", f"""
    SELECT partition_date, n AS rows, 'compact' AS action FROM ({_STATES}) WHERE state = 'Compacted'""")
def savings(p: Plant) -> DataFrame:
    """The logged compactions next to the rows that the partitions hold now."""
    _, table, log = _compacted(p)
    held = p.spark.table(table).groupBy(F.col(PARTITION_COLUMN).alias("partition_date")).agg(F.count(F.lit(1)).alias("rows"))
    return p.spark.table(log).select("partition_date", "action").join(held, "partition_date")


@query("uncompacted_readings", f"""
    SELECT CAST(event_time AS DATE) AS event_date, event_time, point_id, data_quality, {r('v')} AS v, false AS compacted FROM valued""")
def uncompacted(p: Plant) -> DataFrame:
    """Compacted partitions put back: the same rows, and none stays compacted."""
    _, table, log = _compact(p, "uncompact")
    lc.uncompact_partitions(p.spark, table, log, p.now + dt.timedelta(minutes=1))
    state = lc.compacted_dates(p.spark, log, table).withColumn("state", F.lit(True))
    rows = p.spark.table(table).join(state, PARTITION_COLUMN, "left")
    return rows.select(
        PARTITION_COLUMN, "event_time", "point_id", "data_quality", round_half_away(any_value_of(), 4).alias("v"),
        F.coalesce("state", F.lit(False)).alias("compacted"),
    )


def _retained(p: Plant, label: str) -> tuple[str, str]:
    """Readings kept 20 days; one configured table does not exist, one keeps all."""
    db, table, _ = stored_readings(p, label)
    log = f"{db}.retention_logs"
    lc.create_log(p.spark, log, "retention_logs")
    empty = p.spark.createDataFrame([], SCHEMAS["retention_settings"])
    settings = set_retention_days(lc.seed_retention(p.spark, empty, p.now), " Point_Readings ", 20, p.now)
    create_partitioned(
        p.spark, f"{db}.alarm_events",
        with_partition(p.outages.select(F.col("start_at").alias("created_at"), "device_id"), "created_at", 7),
    )
    kept = settings.filter(F.col("table_name") != "control_requests")
    lc.enforce_retention(p.spark, db, kept, log, p.now)
    return table, log


_EXPIRED = """
    SELECT count(*) FROM (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM readings), span
    WHERE d + INTERVAL 1 DAY <= now_at - INTERVAL 20 DAY"""


@query("retention_log", f"""
    WITH x AS (SELECT CAST(({_EXPIRED}) AS INTEGER) AS n)
    SELECT 'point_readings' AS table_name, n AS deleted_chunks, CASE WHEN n > 0 THEN 'success' ELSE 'no_chunks_eligible' END AS status FROM x
    UNION ALL SELECT 'alarm_events', 0, 'no_chunks_eligible'
    UNION ALL SELECT 'control_requests_history', 0, 'failed'
    UNION ALL SELECT 'ALL', n, 'completed (1 failures)' FROM x""")
def retention_log(p: Plant) -> DataFrame:
    _, log = shared(p, "retention", _retained)
    return p.spark.table(log).select("table_name", "deleted_chunks", "status")


@query("retained_readings", f"""
    SELECT event_time, point_id, {r('v')} AS v FROM valued, span
    WHERE CAST(event_time AS DATE) + INTERVAL 1 DAY > now_at - INTERVAL 20 DAY""")
def retained(p: Plant) -> DataFrame:
    """What is left after retention: whole partitions go, nothing else does."""
    table, _ = shared(p, "retention", _retained)
    return p.spark.table(table).select("event_time", "point_id", round_half_away(any_value_of(), 4).alias("v"))


# -- job runs: the events taken as a log ------------------------------------

_RUNS = """
    SELECT 'job ' || user_id AS table_name, ts AS executed_at, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN event_type = 'error' THEN 'event ' || event_id END AS error_message
    FROM events"""


def runs(p: Plant) -> DataFrame:
    failed = F.col("event_type") == "error"
    return p.events.select(
        F.concat(F.lit("job "), F.col("user_id").cast("string")).alias("table_name"), F.col("ts").alias("executed_at"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("error_message"),
    )


@query("run_statistics", f"""
    SELECT table_name, count(*) AS total_runs, count(*) FILTER (WHERE status <> 'failed') AS total_successes,
           count(*) FILTER (WHERE status = 'failed') AS total_failures, max(executed_at) AS last_run,
           arg_max(status, executed_at) AS last_status, max(executed_at) FILTER (WHERE status <> 'failed') AS last_success
    FROM ({_RUNS}) GROUP BY 1""")
def run_statistics(p: Plant) -> DataFrame:
    return lc.run_statistics(runs(p))


@query("recent_errors", f"""
    SELECT table_name, status, executed_at, error_message FROM ({_RUNS}) WHERE error_message IS NOT NULL
    ORDER BY executed_at DESC, table_name LIMIT 50""")
def recent_errors(p: Plant) -> DataFrame:
    return lc.recent_errors(runs(p), limit=50).select("table_name", "status", "executed_at", "error_message")


@query("latest_runs", f"""
    SELECT table_name, max(executed_at) AS executed_at, arg_max(status, executed_at) AS status FROM ({_RUNS}) GROUP BY 1""")
def latest_runs(p: Plant) -> DataFrame:
    return lc.latest_runs(runs(p)).select("table_name", "executed_at", "status")


@query("appended_readings", """
    SELECT CAST(event_time AS DATE) AS event_date, reading_type, count(*) AS n FROM readings GROUP BY 1, 2""")
def appended(p: Plant) -> DataFrame:
    """Raw readings written first, heartbeats appended to the same partitions."""
    db = run_database(p.spark, "append")
    rows = with_partition(p.readings, "event_time")
    create_partitioned(p.spark, f"{db}.point_readings", rows.filter(F.col("reading_type") == "raw"))
    append(p.spark, f"{db}.point_readings", rows.filter(F.col("reading_type") != "raw"))
    return p.spark.table(f"{db}.point_readings").groupBy(PARTITION_COLUMN, "reading_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("analyzed_tables", """
    SELECT 'point_readings' AS table_name, count(*) AS rows, count(DISTINCT point_id) AS points,
           count(*) FILTER (WHERE value_double IS NULL) AS null_doubles, min(event_time) AS oldest, max(event_time) AS newest FROM readings
    UNION ALL
    SELECT 'outages', count(*), count(DISTINCT device_id), 0, min(start_at), max(end_at) FROM outages""")
def analyzed(p: Plant) -> DataFrame:
    """Counts and bounds of two tables, as a planner would want them."""
    def facts(df: DataFrame, name: str, key: str, nullable: Column, low: str, high: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("points"), F.count_if(nullable).alias("null_doubles"),
            F.min(low).alias("oldest"), F.max(high).alias("newest"),
        ).withColumn("table_name", F.lit(name))

    readings = facts(p.readings, "point_readings", "point_id", F.col("value_double").isNull(), "event_time", "event_time")
    return readings.unionByName(facts(p.outages, "outages", "device_id", F.lit(False), "start_at", "end_at"))
