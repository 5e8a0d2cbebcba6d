"""Writes as folds: union old and new rows, pick the winner per key.

Winners are picked by aggregation, not by a row number over each key, so rows
are combined before the shuffle and a key with very many rows costs no more
than any other. The winner is the minimum of (order, row): it is the same on
every run, even where two rows tie.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.buckets import instant
from gridpulse.functions.scalars import is_not_true
from gridpulse.operators.scans import Running, in_stretches, running
from gridpulse.schemas import PARTITIONED, SCHEMAS

_FAR = dt.datetime(9999, 12, 31)

# Columns a newer submission replaces. Site and creator stay as first submitted.
QUEUE_KEYS = ["created_at", "control_request_id"]
QUEUE_UPDATES = [
    "parent_control_request_id", "cancel_control_request_id", "function_code", "value",
    "executed_at", "scheduled_at", "device_id", "point_id", "mode", "status", "source",
    "dispatch_id", "description", "updated_by", "updated_at",
]
QUEUE_FIRST = ["site_id", "created_by"]
DEVICE_UPDATES = [c for c in SCHEMAS["devices"].names if c != "device_id"]
POINT_UPDATES = [c for c in SCHEMAS["points"].names if c != "point_id"]


def _age(ts: Column) -> Column:
    """Sorts newest first: its minimum belongs to the latest time."""
    return (instant(_FAR) - ts).alias("age")


def lww_fold(
    rows: DataFrame,
    keys: list[str],
    ts_col: str,
    update_cols: list[str],
    first_cols: list[str] | None = None,
    arrival: str = "arrival",
) -> DataFrame:
    """Replay of `rows` in arrival order under "a strictly newer time replaces".

    `update_cols` come from the first arrival of the newest time, `first_cols`
    from the first arrival of all. `arrival` is any sortable column.
    """
    first_cols = first_cols or []
    at = F.col(arrival).alias("at")
    newest = F.struct(_age(F.col(ts_col)), at, F.struct(*update_cols).alias("row"))
    picks = [F.min(newest).alias("_new")]
    if first_cols:
        picks.append(F.min(F.struct(at, F.struct(*first_cols).alias("row"))).alias("_first"))
    folded = rows.groupBy(*keys).agg(*picks)
    return folded.select(
        *keys,
        *[F.col(f"_first.row.{c}").alias(c) for c in first_cols],
        *[F.col(f"_new.row.{c}").alias(c) for c in update_cols],
    )


def _judged(rows: DataFrame, keys: list[str], ts: Column, arrival: str, block: str | None) -> DataFrame:
    """Add `_seen`: the newest time among earlier arrivals of the key. Rows of one
    arrival are taken in the order of their times."""
    rows = rows.withColumn("_order", F.struct(F.col(arrival), ts.alias("_ts")))
    if block is None:
        rows, block = in_stretches(rows, keys, "_order", "_stretch"), "_stretch"
    seen = running(rows, keys, block, "_order", [Running("_seen", F.col("_order._ts"), "max", inclusive=False)])
    return seen.drop("_order", "_stretch")


def lww_outcome(
    rows: DataFrame,
    keys: list[str],
    ts_col: str,
    arrival: str = "arrival",
    block: str | None = None,
    counts: Column | None = None,
) -> DataFrame:
    """Add `accepted`: whether each row replaced what was stored when it arrived.

    A row is stale when an earlier arrival of its key is as new or newer. Rows
    where `counts` is not true neither change the state nor are accepted. Every row is
    judged: NULL is a key like any other, and NULL arrivals come first. `block` may name
    a bounded stretch of arrivals that never decreases along `arrival`; without it
    stretches of about equal size are made, whatever the type of `arrival`.
    """
    ts = F.col(ts_col) if counts is None else F.when(counts, F.col(ts_col))
    seen = _judged(rows, keys, ts, arrival, block)
    fresh = F.col("_seen").isNull() | (F.col(ts_col) > F.col("_seen"))
    accepted = fresh if counts is None else F.coalesce(counts, F.lit(False)) & fresh
    return seen.withColumn("accepted", accepted).drop("_seen")


def lww_merge(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    ts_col: str,
    update_cols: list[str],
    arrival: str = "arrival",
    block: str | None = None,
    now: dt.datetime | None = None,
    first_cols: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge `updates` into `target` unless stale; returns (merged, outcome).

    A missing update time means `now`. `first_cols` keep what was stored first.
    The outcome holds every update with `accepted`; for `block` see `lww_outcome`.
    """
    ts = F.col(ts_col)
    if now is not None:
        updates = updates.withColumn(ts_col, F.coalesce(ts, instant(now)))
    first_cols = first_cols or []
    payload = list(dict.fromkeys([*update_cols, ts_col]))
    kept = [*payload, *first_cols]
    kind = updates.schema[arrival].dataType
    place = F.struct(F.col("_update"), F.col(arrival)).alias("_place")
    old = target.select(*keys, *kept).withColumn("_update", F.lit(0)).withColumn(arrival, F.lit(None).cast(kind))
    new = updates.select(*keys, *kept, arrival).withColumn("_update", F.lit(1))
    both = old.unionByName(new).select(*keys, *kept, place)
    merged = lww_fold(both, keys, ts_col, payload, first_cols, arrival="_place")

    state = updates.join(target.select(*keys, ts.alias("_stored")), keys, "left")
    seen = _judged(state, keys, ts, arrival, block)
    newest = F.greatest(F.col("_seen"), F.col("_stored"))
    outcome = seen.withColumn("accepted", newest.isNull() | (ts > newest)).drop("_stored", "_seen")
    return merged, outcome


def upsert_devices(devices: DataFrame, updates: DataFrame, now: dt.datetime | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Merge device rows; every column follows the newest update."""
    cols = [c for c in DEVICE_UPDATES if c in devices.columns]
    return lww_merge(devices, updates, ["device_id"], "updated_at", cols, now=now, **kw)


def upsert_points(points: DataFrame, updates: DataFrame, now: dt.datetime | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """Merge point rows; every column follows the newest update."""
    cols = [c for c in POINT_UPDATES if c in points.columns]
    return lww_merge(points, updates, ["point_id"], "updated_at", cols, now=now, **kw)


def control_queue(audit: DataFrame, arrival: str = "arrival", keys: list[str] | None = None) -> DataFrame:
    """The live queue, derived from the audit: internal rows never reach it.

    Only columns the audit carries take part, so narrow logs fold as well.
    """
    keys = keys or QUEUE_KEYS
    cols = [c for c in audit.columns if c not in (*keys, *QUEUE_FIRST, arrival, "is_internal", "block")]
    first = [c for c in QUEUE_FIRST if c in audit.columns]
    external = audit.filter(is_not_true("is_internal"))
    return lww_fold(external, keys, "updated_at", cols, first, arrival)


def advance_queue(queue: DataFrame, calls: DataFrame, arrival: str = "arrival", keys: list[str] | None = None) -> DataFrame:
    """The queue after more calls, from a stored queue instead of the whole audit.

    Equal to `control_queue` of the audit that led to `queue` followed by `calls`.
    """
    keys = keys or QUEUE_KEYS
    first = [c for c in QUEUE_FIRST if c in queue.columns]
    cols = [c for c in queue.columns if c not in (*keys, *first)]
    external = calls.filter(is_not_true("is_internal"))
    merged, _ = lww_merge(queue, external, keys, "updated_at", cols, arrival, first_cols=first)
    return merged.select(*queue.columns)


def submit_control_requests(
    audit: DataFrame, calls: DataFrame, now: dt.datetime, arrival: str = "arrival", block: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Append every call to the audit; returns (audit, queue, outcome).

    The queue is the fold of the audit, so the two cannot disagree. The outcome
    gives each call the request id, or NULL when it was stale or internal.
    """
    moment = instant(now)
    for c in ("created_at", "updated_at"):
        calls = calls.withColumn(c, F.coalesce(F.col(c), moment))
    grown = audit.withColumn("_call", F.lit(False)).unionByName(calls.withColumn("_call", F.lit(True)))
    judged = lww_outcome(grown, QUEUE_KEYS, "updated_at", arrival, block, is_not_true("is_internal"))
    returned = F.when(F.col("accepted"), F.col("control_request_id"))
    outcome = judged.filter("_call").select(*QUEUE_KEYS, arrival, returned.alias("returned_id"))
    grown = grown.drop("_call")
    return grown, control_queue(grown, arrival), outcome


def _extreme_per_key(rows: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(pick(F.struct(order.alias("at"), F.struct(*rest).alias("row"))).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.row.{c}").alias(c) for c in rest]).select(*rows.columns)


def first_per_key(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The first row of every key; rows that tie in `order` are told apart by content."""
    return _extreme_per_key(rows, keys, order, F.min)


def latest_per_key(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of every key; rows that tie in `order` are told apart by content."""
    return _extreme_per_key(rows, keys, order, F.max)


def _present(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `rows` that `target` holds; never more rows than `rows` has."""
    return target.select(*keys).join(rows.select(*keys), keys, "left_semi").distinct()


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """Add rows whose key is new; the stored row wins, then the first arrival."""
    unique = rows.dropDuplicates(keys) if order is None else first_per_key(rows, keys, order)
    added = unique.join(_present(target, unique, keys), keys, "left_anti")
    return target.unionByName(added.select(*target.columns))


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Insert rows, or replace `update_cols` of the stored row with the same key.

    `rows` holds one row per key. Both joins use `rows` (or a subset of it) as the
    small side, so a large target is neither sorted nor moved when they are few.
    """
    new = rows.select(*keys, F.struct(*update_cols).alias("_new"))
    kept = target.join(new, keys, "left")
    hit = F.col("_new").isNotNull()
    changed = kept.select(
        *[
            F.when(hit, F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
            for c in target.columns
        ]
    )
    added = rows.join(_present(target, rows, keys), keys, "left_anti")
    return changed.unionByName(added, allowMissingColumns=True).select(*target.columns)


def replace_latest(rows: DataFrame, id_col: str, order: str, column: str, value: Column) -> DataFrame:
    """Set `column` on the one row that is newest by `order` (ties: largest id)."""
    newest = rows.agg(F.max_by(F.col(id_col), F.struct(order, id_col)).alias("k")).scalar()
    return rows.withColumn(column, F.when(F.col(id_col) == newest, value).otherwise(F.col(column)))


def set_retention_days(settings: DataFrame, table: str, days: int | None, now: dt.datetime) -> DataFrame:
    """Settings with the retention of one range-partitioned table set."""
    name = table.strip().lower()
    if days is None or isinstance(days, bool) or days < 0:
        raise ValueError("retention days must be a non-negative integer")
    if name not in PARTITIONED:
        raise ValueError(f"{name!r} is not a range-partitioned table")
    row = settings.sparkSession.createDataFrame(
        [(name, int(days), now)], "table_name string, retention_days int, updated_at timestamp_ntz"
    )
    return upsert(settings, row, ["table_name"], ["retention_days", "updated_at"])
