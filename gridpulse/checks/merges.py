"""Folds, upserts, constraint audit and the equipment tree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.registry import query
from gridpulse.checks.views import r
from gridpulse.functions.buckets import instant
from gridpulse.functions.scalars import round_half_away
from gridpulse.operators.hierarchy import device_point_tree
from gridpulse.operators.integrity import audit_constraints
from gridpulse.operators.merge import (
    advance_queue,
    control_queue,
    first_per_key,
    insert_if_absent,
    latest_per_key,
    lww_merge,
    replace_latest,
    submit_control_requests,
    upsert,
    upsert_devices,
    upsert_points,
)
from gridpulse.plans.reports import plant_tree
from gridpulse.session import run_dir
from gridpulse.sources.adapters import Plant
from gridpulse.checks.rollups import streamed
from gridpulse.streaming.ingest import start_log
from gridpulse.streaming.sources import parquet_stream

_STORED = dt.datetime(1997, 6, 1)


def _customers_and_orders(p: Plant) -> tuple[DataFrame, DataFrame]:
    """Customers as stored rows, orders as updates in order-key sequence; some have no key or no place."""
    target = p.base("customer").select(
        F.col("c_custkey").alias("key"),
        F.lit("A").alias("status"),
        F.col("c_acctbal").alias("amount"),
        instant(_STORED).alias("updated_at"),
    )
    updates = p.base("orders").select(
        F.when(F.col("o_orderkey") % 31 > 0, F.col("o_custkey")).alias("key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderkey") % 97 > 0, F.col("o_orderkey")).alias("arrival"),
    )
    return target, updates


_UPDATES = """
    SELECT CASE WHEN o_orderkey % 31 > 0 THEN o_custkey END AS key, o_orderstatus AS status, o_totalprice AS amount,
           o_orderdate AS updated_at, CASE WHEN o_orderkey % 97 > 0 THEN o_orderkey END AS arrival
    FROM orders"""


@query("lww_customer", f"""
    SELECT key, status, {r('amount', 2)} AS amount, updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated_at DESC, new, arrival NULLS FIRST, status, amount) AS place
          FROM (SELECT c_custkey AS key, 'A' AS status, c_acctbal AS amount,
                       TIMESTAMP '1997-06-01' AS updated_at, -1 AS arrival, 0 AS new FROM customer
                UNION ALL
                SELECT *, 1 FROM ({_UPDATES})))
    WHERE place = 1""")
def lww_customer(p: Plant) -> DataFrame:
    target, updates = _customers_and_orders(p)
    merged, _ = lww_merge(target, updates, ["key"], "updated_at", ["status", "amount"])
    return merged.select("key", "status", round_half_away("amount", 2).alias("amount"), "updated_at")


@query("lww_outcome", f"""
    SELECT arrival, key,
           CASE WHEN c.c_custkey IS NULL THEN
                coalesce(updated_at > max(updated_at) OVER w, true)
           ELSE updated_at > greatest(TIMESTAMP '1997-06-01',
                coalesce(max(updated_at) OVER w, TIMESTAMP '1997-06-01')) END AS accepted
    FROM ({_UPDATES}) o LEFT JOIN customer c ON c.c_custkey = o.key
    WINDOW w AS (PARTITION BY key ORDER BY arrival NULLS FIRST, updated_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def lww_outcome(p: Plant) -> DataFrame:
    target, updates = _customers_and_orders(p)
    _, outcome = lww_merge(target, updates, ["key"], "updated_at", ["status", "amount"])
    return outcome.select("arrival", "key", "accepted")


_CATALOG_SQL = """
    SELECT CAST(key AS VARCHAR) AS {id}, CAST(site AS VARCHAR) AS site_id, name, {label}, updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated_at DESC, arrival) AS place
          FROM (SELECT c_custkey AS key, c_nationkey AS site, c_name AS name, '{stored}' AS {label},
                       TIMESTAMP '1997-06-01' AS updated_at, -1 AS arrival FROM customer
                UNION ALL
                SELECT o_custkey, NULL, o_orderpriority, {new}, o_orderdate, o_orderkey FROM orders))
    WHERE place = 1"""


def _catalog(p: Plant, key: str, label: str, stored: str, new: Column) -> tuple[DataFrame, DataFrame]:
    """Customers as catalog rows, orders as their updates (which name no site)."""
    rows = p.base("customer").select(
        F.col("c_custkey").cast("string").alias(key), F.col("c_nationkey").cast("string").alias("site_id"),
        F.col("c_name").alias("name"), F.lit(stored).alias(label), instant(_STORED).alias("updated_at"),
    )
    updates = p.base("orders").select(
        F.col("o_custkey").cast("string").alias(key), F.lit(None).cast("string").alias("site_id"),
        F.col("o_orderpriority").alias("name"), new.alias(label), F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("arrival"),
    )
    return rows, updates


@query("upsert_devices", _CATALOG_SQL.format(
    id="device_id", label="status", stored="active", new="CASE WHEN o_orderstatus = 'F' THEN 'disabled' ELSE 'active' END"))
def device_updates(p: Plant) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "disabled").otherwise("active")
    merged, _ = upsert_devices(*_catalog(p, "device_id", "status", "active", status), now=dt.datetime(2024, 1, 1))
    return merged


@query("upsert_points", _CATALOG_SQL.format(
    id="point_id", label="uom", stored="kW", new="CASE WHEN o_totalprice > 200000 THEN 'MW' ELSE 'W' END"))
def point_updates(p: Plant) -> DataFrame:
    uom = F.when(F.col("o_totalprice") > 200000, "MW").otherwise("W")
    merged, _ = upsert_points(*_catalog(p, "point_id", "uom", "kW", uom), now=dt.datetime(2024, 1, 1))
    return merged


_QUEUE_COLUMNS = ("control_request_id", "device_id", "point_id", "setpoint", "status", "updated_at", "created_by")


def _queue(p: Plant) -> DataFrame:
    log = p.control_log.drop("line").withColumn("created_by", F.col("device_id"))
    return control_queue(log, keys=["control_request_id"])


@query("control_queue", f"SELECT {', '.join(_QUEUE_COLUMNS)} FROM queue")
def queue(p: Plant) -> DataFrame:
    return _queue(p).select(*_QUEUE_COLUMNS).withColumn("setpoint", F.col("setpoint").cast("double"))


@query("control_queue_advanced", f"SELECT {', '.join(_QUEUE_COLUMNS)} FROM queue")
def advanced(p: Plant) -> DataFrame:
    """The queue of lines 1 to 3, brought forward by the later lines."""
    log = p.control_log.withColumn("created_by", F.col("device_id"))
    before = control_queue(log.filter("line <= 3").drop("line"), keys=["control_request_id"])
    after = advance_queue(before, log.filter("line > 3").drop("line"), keys=["control_request_id"])
    return after.select(*_QUEUE_COLUMNS).withColumn("setpoint", F.col("setpoint").cast("double"))


@query("control_audit", """
    SELECT control_request_id, status, count(*) AS submissions,
           CAST(sum(CASE WHEN is_internal THEN 1 ELSE 0 END) AS BIGINT) AS internal,
           min(updated_at) AS first_at, max(updated_at) AS last_at
    FROM control_log GROUP BY 1, 2""")
def control_audit(p: Plant) -> DataFrame:
    """The audit keeps every call, internal ones included."""
    return p.control_log.groupBy("control_request_id", "status").agg(
        F.count(F.lit(1)).alias("submissions"),
        F.count_if("is_internal").alias("internal"),
        F.min("updated_at").alias("first_at"),
        F.max("updated_at").alias("last_at"),
    )


@query("control_submit", """
    WITH calls AS (
        SELECT line AS n, updated_at AS called, is_internal, point_id % 97 > 0 AS placed,
               CASE WHEN control_request_id % 31 > 0 THEN control_request_id END AS control_request_id,
               CASE WHEN placed THEN line END AS line, CASE WHEN placed THEN point_id END AS point_id,
               CASE WHEN placed THEN device_id END AS device_id, CASE WHEN placed THEN price END AS price,
               CASE WHEN placed THEN updated_at END AS updated_at
        FROM control_log),
    judged AS (
        SELECT *, max(CASE WHEN NOT is_internal THEN called END) OVER (
                   PARTITION BY control_request_id
                   ORDER BY placed, line, point_id, device_id, price, updated_at,
                            CASE WHEN NOT is_internal THEN called END NULLS FIRST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
        FROM calls)
    SELECT control_request_id, line, point_id, device_id, updated_at,
           CASE WHEN NOT is_internal AND (seen IS NULL OR called > seen) THEN control_request_id END AS returned_id
    FROM judged WHERE n > 3""")
def control_submit(p: Plant) -> DataFrame:
    """Lines 1 to 3 are the audit so far, later lines are submitted to it; some have no request id or no place."""
    log = p.control_log.withColumn("created_at", instant(_STORED))
    log = log.withColumn("control_request_id", F.when(F.col("control_request_id") % 31 > 0, F.col("control_request_id")))
    log = log.withColumn("arrival", F.when(F.col("point_id") % 97 > 0, F.col("arrival")))
    now = dt.datetime(2024, 1, 1)
    _, _, outcome = submit_control_requests(log.filter("line <= 3"), log.filter("line > 3"), now)
    at = F.col("arrival")
    return outcome.select(
        "control_request_id",
        at["l_linenumber"].alias("line"),
        at["l_partkey"].alias("point_id"),
        at["l_suppkey"].alias("device_id"),
        at["l_shipdate"].alias("updated_at"),
        "returned_id",
    )


@query("stream_control_queue", f"SELECT {', '.join(_QUEUE_COLUMNS)} FROM queue")
def stream_control_queue(p: Plant) -> DataFrame:
    """Submissions streamed into the audit; the queue is the fold of what landed."""
    path = run_dir(p.spark, "stream-audit")
    lines = p.base("lineitem")
    live = Plant(p.spark, p.sf_dir)
    live.base = lambda name: parquet_stream(p.spark, f"{p.sf_dir}/{name}.parquet", lines.schema)
    start_log(live.control_log.drop("line"), f"{path}/audit", f"{path}/checkpoint", once=True).awaitTermination()
    audit = p.spark.read.parquet(f"{path}/audit").withColumn("created_by", F.col("device_id")).drop("batch_id")
    folded = control_queue(audit, keys=["control_request_id"])
    return folded.select(*_QUEUE_COLUMNS).withColumn("setpoint", F.col("setpoint").cast("double"))


@query("stream_readings", """
    SELECT CAST(event_time AS DATE) AS event_date, point_id, count(*) AS n, min(event_time) AS first_time,
           max(event_time) AS last_time
    FROM (SELECT DISTINCT event_time, point_id FROM readings) GROUP BY 1, 2""")
def stream_readings(p: Plant) -> DataFrame:
    """Readings streamed into the managed table, newest first, without duplicate keys."""
    table, _ = streamed(p, "stream-readings")
    return p.spark.table(table).groupBy("event_date", "point_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time")
    )


@query("insert_if_absent", """
    SELECT point_id, CAST(sum(n) AS BIGINT) AS n, bool_or(seen) AS seen
    FROM (SELECT point_id, count(*) AS n, true AS seen FROM readings GROUP BY 1
          UNION ALL SELECT c_custkey, 0, false FROM customer)
    GROUP BY 1""")
def absent(p: Plant) -> DataFrame:
    """Points with readings, completed by catalog points without any."""
    seen = p.readings.groupBy("point_id").agg(F.count(F.lit(1)).alias("n")).withColumn("seen", F.lit(True))
    rows = p.points.select("point_id", F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("seen"))
    return insert_if_absent(seen, rows, ["point_id"])


@query("unconditional_upsert", """
    WITH newest AS (
        SELECT o_custkey AS point_id, arg_max(o_orderpriority, o_orderdate + to_microseconds(o_orderkey)) AS uom
        FROM orders GROUP BY 1)
    SELECT coalesce(p.point_id, n.point_id) AS point_id, p.name AS name, coalesce(n.uom, p.uom) AS uom
    FROM points p FULL JOIN newest n ON n.point_id = p.point_id""")
def unconditional(p: Plant) -> DataFrame:
    """The newest order replaces the unit column, other columns stay."""
    orders = p.base("orders").select(
        F.col("o_custkey").alias("point_id"), F.col("o_orderpriority").alias("uom"),
        F.struct("o_orderdate", "o_orderkey").alias("at"),
    )
    rows = latest_per_key(orders, ["point_id"], F.col("at")).drop("at")
    return upsert(p.points.select("point_id", "name", "uom"), rows, ["point_id"], ["uom"])


@query("latest_per_key", f"""
    SELECT point_id, event_time, data_quality, {r('v')} AS v
    FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY event_time DESC) AS place FROM valued)
    WHERE place = 1""")
def latest(p: Plant) -> DataFrame:
    from gridpulse.functions.values import any_value_of

    rows = p.readings.select("point_id", "event_time", "data_quality", round_half_away(any_value_of(), 4).alias("v"))
    return latest_per_key(rows, ["point_id"], F.col("event_time"))


@query("first_per_key", """
    SELECT control_request_id, status, point_id, updated_at FROM control_log WHERE arrival = 1""")
def first(p: Plant) -> DataFrame:
    rows = p.control_log.select("control_request_id", "status", "point_id", "updated_at", "arrival")
    return first_per_key(rows, ["control_request_id"], F.col("arrival")).drop("arrival")


@query("replace_latest", """
    SELECT outage_id, device_id, start_at,
           CASE WHEN outage_id = (SELECT outage_id FROM outages ORDER BY start_at DESC, outage_id DESC LIMIT 1)
                THEN (SELECT hi FROM span) ELSE end_at END AS end_at
    FROM outages""")
def open_ended(p: Plant) -> DataFrame:
    """The latest outage is stretched to the end of the data."""
    end = instant(p.span[1])
    return replace_latest(p.outages, "outage_id", "start_at", "end_at", end)


@query("constraint_audit", """
    SELECT 'points_eng_range' AS rule, CAST(c_custkey AS VARCHAR) AS key,
           printf('%.7f', 0.0) || '..' || CAST(CAST(c_acctbal AS DECIMAL(24,7)) AS VARCHAR) AS detail
    FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT 'requests_key', CAST(l_shipdate AS VARCHAR) || '|' || CAST(l_orderkey AS VARCHAR), CAST(count(*) AS VARCHAR)
    FROM lineitem GROUP BY l_shipdate, l_orderkey HAVING count(*) > 1
    UNION ALL
    SELECT 'readings_key', CAST(event_time AS VARCHAR) || '|' || CAST(point_id AS VARCHAR), CAST(count(*) AS VARCHAR)
    FROM readings GROUP BY event_time, point_id HAVING count(*) > 1
    UNION ALL
    SELECT 'readings_point', CAST(point_id AS VARCHAR), CAST(count(*) AS VARCHAR)
    FROM readings WHERE point_id NOT IN (SELECT point_id FROM points) GROUP BY point_id
    UNION ALL
    SELECT 'outages_order', CAST(outage_id AS VARCHAR), CAST(end_at AS VARCHAR) FROM outages WHERE end_at <= start_at""")
def constraint_audit(p: Plant) -> DataFrame:
    """All constraints the test tables can break, over the whole tables."""
    ranged = p.base("customer").select(
        F.col("c_custkey").alias("point_id"),
        F.col("c_nationkey").alias("site_id"),
        F.lit(0).cast("decimal(24,7)").alias("eng_low"),
        F.col("c_acctbal").cast("decimal(24,7)").alias("eng_high"),
    )
    requests = p.base("lineitem").select(
        F.col("l_shipdate").alias("created_at"), F.col("l_orderkey").alias("control_request_id")
    )
    return audit_constraints({
        "points": ranged, "sites": p.sites, "point_readings": p.readings, "control_requests": requests,
        "outages": p.outages, "device_hierarchy": p.hierarchy, "devices": p.devices, "device_points": p.device_points,
    })


_TREE_SQL = """
    WITH RECURSIVE walk AS (
        SELECT site_id, device_id, CAST(NULL AS VARCHAR) AS parent_device_id, name, kind, 1 AS depth
        FROM devices WHERE device_id NOT IN (SELECT child_device_id FROM hierarchy)
        UNION ALL
        SELECT w.site_id, d.device_id, h.parent_device_id, d.name, d.kind, w.depth + 1
        FROM walk w JOIN hierarchy h ON h.parent_device_id = w.device_id JOIN devices d ON d.device_id = h.child_device_id),
    nodes AS (
        SELECT site_id, 'device' AS node_type, depth, device_id, parent_device_id, name,
               CASE kind WHEN 1 THEN 'plant_controller' WHEN 2 THEN 'meter' ELSE 'inverter' END AS device_type,
               CAST(NULL AS BIGINT) AS point_id, CAST(NULL AS VARCHAR) AS uom, CAST(NULL AS BOOLEAN) AS is_analog
        FROM walk
        UNION ALL
        SELECT w.site_id, 'point', w.depth + 1, NULL, w.device_id, p.name, NULL, p.point_id, p.uom, true
        FROM walk w JOIN points p ON w.device_id = concat('N', p.site_id))"""


@query("device_tree", f"{_TREE_SQL} SELECT * FROM nodes")
def device_tree(p: Plant) -> DataFrame:
    return device_point_tree(p.devices, p.hierarchy, p.device_types, p.device_points, p.points)


@query("plant_tree", f"{_TREE_SQL} SELECT repeat('  ', depth - 1) || name AS plant, node_type, device_type, uom FROM nodes")
def indented(p: Plant) -> DataFrame:
    tree = device_point_tree(p.devices, p.hierarchy, p.device_types, p.device_points, p.points)
    return plant_tree(tree).select("plant", "node_type", "device_type", "uom")
