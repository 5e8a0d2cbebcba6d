"""The hourly rollup kept up to date by a stream, and the daily one by its changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.buckets import bucket_of
from gridpulse.operators.merge import latest_per_key
from gridpulse.operators.rollups import DAY, ROLLUP_COLUMNS, rollup_1d
from gridpulse.sources.tables import PARTITION_COLUMN, clustered, partition_files, replace_partitions, with_partition
from gridpulse.streaming.ingest import BATCH

PUBLISHED = "gridpulse.published_batch"
KEYS = ["point_id", "bucket"]


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The current rollup from the log alone: the newest version of every group.

    This folds the whole log; `read_published` folds only what is not yet published.
    """
    return latest_per_key(spark.read.parquet(path), KEYS, F.col(BATCH)).select(*ROLLUP_COLUMNS)


def published_batch(spark: SparkSession, table: str) -> int:
    """The last batch of the log that the rollup table contains, -1 for none."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == PUBLISHED).collect()
    return int(found[0]["value"]) if found else -1


def publish(spark: SparkSession, path: str, table: str) -> int:
    """Fold the batches not yet in the rollup table into it; returns the last one.

    Only dates with changes are rewritten. Running it again changes nothing.
    """
    done = published_batch(spark, table)
    log = spark.read.parquet(path).filter(F.col(BATCH) > done)
    last = log.agg(F.max(BATCH)).first()[0]
    if last is None:
        return done
    newest = latest_per_key(log.filter(F.col(BATCH) <= last), KEYS, F.col(BATCH))
    changed = with_partition(newest.select(*ROLLUP_COLUMNS), "bucket")
    dates = [r[0] for r in changed.select(PARTITION_COLUMN).distinct().collect()]
    stored = spark.table(table).filter(F.col(PARTITION_COLUMN).isin(dates))
    before = partition_files(spark, table, dates)
    kept = stored.join(changed.select(*KEYS), KEYS, "left_anti").select(*changed.columns)
    _, left = replace_partitions(spark, table, clustered(changed.unionByName(kept), *KEYS), before)
    if left:
        raise RuntimeError(f"{table} was written to while it was published to; not replaced: {left}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PUBLISHED}'='{last}')")
    return last


def changed_days(spark: SparkSession, path: str, after: int, last: int) -> list:
    """Dates with hours that the batches after `after`, up to `last`, changed."""
    log = spark.read.parquet(path).filter((F.col(BATCH) > after) & (F.col(BATCH) <= last))
    return [r[0] for r in log.select(F.to_date(bucket_of(F.col("bucket"), DAY))).distinct().collect()]


def publish_days(spark: SparkSession, path: str, hourly: str, daily: str) -> list:
    """Build those days anew whose hours were published since the daily table was; returns their dates.

    Only these dates of the hourly table are read and only these of the daily one are
    rewritten. Running it again changes nothing, and a failed run is made up for by the next.
    """
    done, last = published_batch(spark, daily), published_batch(spark, hourly)
    days = changed_days(spark, path, done, last) if last > done else []
    if days:
        before = partition_files(spark, daily, days)
        hours = spark.table(hourly).filter(F.col(PARTITION_COLUMN).isin(days))
        rows = with_partition(rollup_1d(hours).select(*ROLLUP_COLUMNS), "bucket")
        _, left = replace_partitions(spark, daily, clustered(rows, *KEYS), before)
        if left:
            raise RuntimeError(f"{daily} was written to while it was published to; not replaced: {left}")
    if last > done:
        spark.sql(f"ALTER TABLE {daily} SET TBLPROPERTIES ('{PUBLISHED}'='{last}')")
    return sorted(days)


def read_published(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The current rollup: the table without the groups that later batches changed, and those.

    Only the later batches are folded; stored rows meet their keys and nothing else.
    """
    recent = spark.read.parquet(path).filter(F.col(BATCH) > published_batch(spark, table))
    newest = latest_per_key(recent, KEYS, F.col(BATCH)).select(*ROLLUP_COLUMNS)
    kept = spark.table(table).select(*ROLLUP_COLUMNS).join(newest.select(*KEYS), KEYS, "left_anti")
    return kept.unionByName(newest)
