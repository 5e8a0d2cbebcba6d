"""Partition jobs: compaction, logged retention, inventory and run statistics.

Jobs loop over partition dates and configured tables on the driver, never over
rows. They work on managed tables of the session catalog.
"""

from __future__ import annotations

import datetime as dt
import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.scalars import gib, percent, percent_saved, ratio
from gridpulse.operators.merge import insert_if_absent, latest_per_key
from gridpulse.operators.rollups import partitions
from gridpulse.schemas import CLUSTERING, COMPACT_AFTER_DAYS, PARTITIONED, RETENTION_DAYS, SCHEMAS
from gridpulse.sources.tables import PARTITION_COLUMN, clustered, files, partition_files, replace_partitions, table_days

DEFAULT_AGE = dt.timedelta(days=7)
# Size of a compacted file, which also bounds what one task sorts.
TARGET_FILE_BYTES = 256 * 1024 * 1024
#: What one compaction job takes at most, so that a failure repeats little.
GROUP_BYTES, GROUP_DATES = 64 * 1024**3, 32
_DROP_BATCH = 500


def short_name(table: str) -> str:
    return table.split(".")[-1]


def create_log(spark: SparkSession, table: str, kind: str) -> None:
    """An empty log table (`retention_logs` or `compaction_logs`)."""
    spark.createDataFrame([], SCHEMAS[kind]).write.format("parquet").saveAsTable(table)


def _log(spark: SparkSession, table: str, kind: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, SCHEMAS[kind]).coalesce(1).write.mode("append").insertInto(table)


def range_end(table: str, start: dt.date) -> dt.datetime:
    """Exclusive end of the partition that starts on `start`."""
    days = table_days(table)[1]
    return dt.datetime.combine(start, dt.time()) + dt.timedelta(days=days)


# -- inventory ---------------------------------------------------------------


def compacted_dates(spark: SparkSession, log_table: str, table: str) -> DataFrame:
    """Partition dates whose latest logged action is a compaction."""
    log = spark.table(log_table).filter(F.col("table_name") == short_name(table))
    last = log.groupBy("partition_date").agg(F.max_by("action", "executed_at").alias("action"))
    return last.filter(F.col("action") == "compact").select(F.col("partition_date").alias(PARTITION_COLUMN))


def partition_inventory(spark: SparkSession, table: str, log_table: str) -> DataFrame:
    """One row per partition: files, size, layout state and the range it covers."""
    name = short_name(table)
    days = table_days(table)[1]
    kind = "rollup" if name.startswith("readings_1") else "fact"
    state = compacted_dates(spark, log_table, table).withColumn("_c", F.lit(True))
    start = F.col(PARTITION_COLUMN).cast("timestamp_ntz")
    sized = files(spark, table).groupBy(PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    held = spark.table(table).groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("rows"))
    return sized.join(held, PARTITION_COLUMN).join(state, PARTITION_COLUMN, "left").select(
        F.lit(name).alias("parent_object"),
        F.lit(kind).alias("parent_type"),
        F.col(PARTITION_COLUMN).alias("partition_date"),
        "files",
        "bytes",
        "rows",
        gib("bytes").alias("gib"),
        F.when(F.col("_c"), "Compacted").otherwise("Hot").alias("state"),
        start.alias("range_start"),
        (start + F.expr(f"INTERVAL '{days}' DAY")).alias("range_end"),
        F.lit(days).alias("width_days"),
    )


def table_sizes(inventory: DataFrame) -> DataFrame:
    """Partitions, bytes and rows per table, split into hot and compacted."""
    hot = F.col("state") == "Hot"
    return inventory.groupBy("parent_object", "parent_type").agg(
        F.sum("bytes").alias("total_bytes"),
        gib(F.sum("bytes")).alias("total_gib"),
        F.sum(F.when(hot, F.col("bytes")).otherwise(0)).alias("hot_bytes"),
        F.sum(F.when(hot, 0).otherwise(F.col("bytes"))).alias("compacted_bytes"),
        F.sum("rows").alias("rows"),
        F.sum(F.when(hot, F.col("rows")).otherwise(0)).alias("hot_rows"),
        F.sum(F.when(hot, 0).otherwise(F.col("rows"))).alias("compacted_rows"),
        F.count_if(hot).alias("hot_partitions"),
        F.count_if(~hot).alias("compacted_partitions"),
    )


def compaction_progress(inventory: DataFrame) -> DataFrame:
    """Partition counts per table: compacted, hot, percent, oldest and newest range."""
    done = F.col("state") == "Compacted"
    total = F.count(F.lit(1))
    return inventory.groupBy("parent_object").agg(
        total.alias("partitions"),
        F.count_if(done).alias("compacted"),
        F.count_if(~done).alias("hot"),
        percent(F.count_if(done), total).alias("pct_compacted"),
        F.min("range_start").alias("oldest"),
        F.max("range_end").alias("newest"),
    )


def compaction_savings(log: DataFrame) -> DataFrame:
    """Bytes before and after, percent saved and ratio, over compacted partitions."""
    newest = latest_per_key(log, ["table_name", "partition_date"], F.col("executed_at"))
    sums = newest.filter(F.col("action") == "compact").groupBy("table_name").agg(
        F.count(F.lit(1)).alias("compacted"),
        F.sum("bytes_before").alias("before_bytes"),
        F.sum("bytes_after").alias("after_bytes"),
    )
    return sums.select(
        "*",
        percent_saved("before_bytes", "after_bytes").alias("saved_pct"),
        ratio("before_bytes", "after_bytes").alias("ratio"),
    )


def clustering_settings(spark: SparkSession) -> DataFrame:
    """Segment and order key of every clustered table."""
    rows = [(t, i, c, i == 1) for t, keys in CLUSTERING.items() for i, c in enumerate(keys)]
    columns = spark.createDataFrame(rows, "table_name string, position int, name string, is_order boolean")
    return columns.groupBy("table_name").agg(
        F.expr("listagg(name, ', ') WITHIN GROUP (ORDER BY position) FILTER (WHERE NOT is_order)").alias("segment_by"),
        F.expr("listagg(concat(name, ' DESC'), ', ') WITHIN GROUP (ORDER BY position) FILTER (WHERE is_order)").alias("order_by"),
    )


# -- compaction --------------------------------------------------------------


def _rewrite(
    spark: SparkSession, table: str, dates: list[dt.date], action: str, log_table: str, now: dt.datetime
) -> list[dt.date]:
    """Rewrite the partitions in small groups, each logged when done; returns those rewritten.

    A partition that is appended to meanwhile is left for the next run, and one
    without files has nothing to rewrite.
    """
    segment, order = CLUSTERING[short_name(table)]
    newest_first = F.col(order).desc()
    done: list[dt.date] = []
    for group in _groups(partition_files(spark, table, dates) if dates else {}):
        chosen = list(group)
        rows = spark.table(table).filter(F.col(PARTITION_COLUMN).isin(chosen))
        size = {d: sum(f.values()) for d, f in group.items()}
        if action == "compact":
            # Ranges over date, segment and time: a hot segment is cut into several
            # files, and every file covers a narrow range that readers can skip.
            parts = max(len(chosen), math.ceil(sum(size.values()) / TARGET_FILE_BYTES))
            laid = rows.repartitionByRange(parts, PARTITION_COLUMN, segment, newest_first)
            laid = laid.sortWithinPartitions(PARTITION_COLUMN, segment, newest_first)
        else:
            laid = clustered(rows, order)
        replaced, _ = replace_partitions(spark, table, laid, group)
        after = partition_files(spark, table, replaced) if replaced else {}
        name = short_name(table)
        logged = [(now, name, d, action, size[d], sum(after.get(d, {}).values())) for d in replaced]
        if logged:
            _log(spark, log_table, "compaction_logs", logged)
        done += replaced
    return done


def _groups(found: dict[dt.date, dict[str, int]]) -> list[dict[dt.date, dict[str, int]]]:
    """Partitions in order, drawn together up to GROUP_BYTES or GROUP_DATES a job."""
    out: list[dict] = []
    size = 0
    for day in sorted(found):
        own = sum(found[day].values())
        if not out or size + own > GROUP_BYTES or len(out[-1]) == GROUP_DATES:
            out.append({})
            size = 0
        out[-1][day] = found[day]
        size += own
    return out


def compact_partitions(
    spark: SparkSession, table: str, dates: list[dt.date], log_table: str, now: dt.datetime
) -> list[dt.date]:
    """Rewrite the given partitions clustered by segment and sorted newest first; returns those done."""
    return _rewrite(spark, table, dates, "compact", log_table, now)


def uncompact_partitions(
    spark: SparkSession, table: str, log_table: str, now: dt.datetime, dates: list[dt.date] | None = None
) -> list[dt.date]:
    """Put compacted partitions (all, or the given ones) back into time order."""
    done = [r[0] for r in compacted_dates(spark, log_table, table).collect()]
    chosen = sorted(d for d in done if dates is None or d in dates)
    return _rewrite(spark, table, chosen, "uncompact", log_table, now)


def compact_eligible(
    spark: SparkSession,
    tables: list[str],
    log_table: str,
    now: dt.datetime,
    older_than: dt.timedelta | None = None,
) -> dict[str, list[dt.date]]:
    """Compact every hot partition whose range ended before now minus the age.

    The age is `older_than`, else the table's policy, else seven days. A job takes a
    small group of partitions; those already compacted are skipped. Returns what was done.
    """
    done: dict[str, list[dt.date]] = {}
    for table in tables:
        name = short_name(table)
        policy = COMPACT_AFTER_DAYS.get(name)
        age = older_than or (dt.timedelta(days=policy) if policy is not None else DEFAULT_AGE)
        already = {r[0] for r in compacted_dates(spark, log_table, table).collect()}
        due = [d for d in partitions(spark, table) if d not in already and range_end(table, d) < now - age]
        done[table] = compact_partitions(spark, table, due, log_table, now)
    return done


# -- retention ---------------------------------------------------------------

# Statuses of a retention run, and the name of its closing row.
SUCCESS, NOTHING_DUE, FAILED, COMPLETED, EVERY_TABLE = "success", "no_chunks_eligible", "failed", "completed ({} failures)", "ALL"


def seed_retention(spark: SparkSession, settings: DataFrame, now: dt.datetime) -> DataFrame:
    """Settings with the default days for tables that have none yet."""
    rows = [(t, d, now) for t, d in RETENTION_DAYS.items()]
    return insert_if_absent(settings, spark.createDataFrame(rows, SCHEMAS["retention_settings"]), ["table_name"])


def _drop_expired(spark: SparkSession, table: str, days: int, now: dt.datetime) -> int:
    if not spark.catalog.tableExists(table) or short_name(table) not in PARTITIONED:
        raise ValueError("not a range-partitioned table")
    cutoff = now - dt.timedelta(days=days)
    expired = [d for d in partitions(spark, table) if range_end(table, d) <= cutoff]
    for i in range(0, len(expired), _DROP_BATCH):
        parts = ", ".join(f"PARTITION ({PARTITION_COLUMN}='{d}')" for d in expired[i : i + _DROP_BATCH])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    if expired:
        spark.catalog.refreshTable(table)
    return len(expired)


def enforce_retention(
    spark: SparkSession, database: str, settings: DataFrame, log_table: str, now: dt.datetime
) -> tuple[int, int]:
    """Drop whole expired partitions of every configured table.

    One log row per table, and a closing `ALL` row. A failing table is logged and
    the sweep goes on. Returns (dropped partitions, failed tables).
    """
    total, failures, rows = 0, 0, []
    run_start = time.monotonic()
    for name, days in settings.select("table_name", "retention_days").orderBy("table_name").collect():
        started = time.monotonic()
        dropped, status, error = 0, FAILED, None
        try:
            dropped = _drop_expired(spark, f"{database}.{name}", days, now)
            status = SUCCESS if dropped else NOTHING_DUE
        except Exception as exc:  # any failure of one table is recorded, not raised
            failures += 1
            error = str(exc)
        total += dropped
        rows.append((now, name, dropped, time.monotonic() - started, status, error))
    rows.append((now, EVERY_TABLE, total, time.monotonic() - run_start, COMPLETED.format(failures), None))
    _log(spark, log_table, "retention_logs", rows)
    return total, failures


# -- run statistics ----------------------------------------------------------


def run_statistics(log: DataFrame) -> DataFrame:
    """Per job: runs, failures, last run and status, last success."""
    failed = F.col("status") == FAILED
    at = F.col("executed_at")
    return log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(~failed).alias("total_successes"),
        F.count_if(failed).alias("total_failures"),
        F.max(at).alias("last_run"),
        F.max_by("status", at).alias("last_status"),
        F.max(F.when(~failed, at)).alias("last_success"),
    )


def recent_errors(log: DataFrame, limit: int) -> DataFrame:
    """Newest failures first."""
    bad = log.filter(F.col("error_message").isNotNull())
    return bad.orderBy(F.col("executed_at").desc_nulls_last(), "table_name").limit(limit)


def latest_runs(log: DataFrame) -> DataFrame:
    """The most recent run of every job."""
    return latest_per_key(log, ["table_name"], F.col("executed_at"))


def analyze_all(spark: SparkSession, database: str, scan: bool = False) -> list[str]:
    """Refresh planner statistics of every table; sizes only unless `scan`."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    mode = "" if scan else " NOSCAN"
    for name in names:
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS{mode}")
    return names


def retention_job(spark: SparkSession, job_id: int, config: dict) -> tuple[int, int]:
    """Entry for an external scheduler: `config` names the database and its tables."""
    return enforce_retention(
        spark,
        config["database"],
        spark.table(config["settings_table"]),
        config["log_table"],
        dt.datetime.fromisoformat(config["now"]),
    )
