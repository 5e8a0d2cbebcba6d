"""Replay-safe ingest of readings, control submissions and catalog updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridpulse.functions.buckets import bucket_of
from gridpulse.functions.values import any_value_of
from gridpulse.operators.rollups import HOUR, ROLLUP_COLUMNS, hourly_aggregates
from gridpulse.sources.tables import PARTITION_COLUMN, append, with_partition

BATCH = "batch_id"
KEY = ["event_time", "point_id"]
HOURLY = ["point_id", "bucket"]


def _dates(rows: DataFrame) -> list:
    """The partition dates that one micro-batch holds."""
    return [r[0] for r in rows.select(PARTITION_COLUMN).distinct().collect()]


def new_readings(spark: SparkSession, table: str, batch: DataFrame) -> DataFrame:
    """Rows of the batch, of any age, whose key the table does not hold; any one of the rows with a key.

    Rows without a time or a point have no key and are not taken. Only the dates that the batch touches are read.
    """
    keyed = batch.filter(F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull())
    rows = with_partition(keyed, "event_time")
    stored = spark.table(table).filter(F.col(PARTITION_COLUMN).isin(_dates(rows)))
    return rows.dropDuplicates(KEY).join(stored.select(PARTITION_COLUMN, *KEY), [PARTITION_COLUMN, *KEY], "left_anti")


def touched_hours(batch: DataFrame) -> DataFrame:
    """Date, point and hour of the raw rows of a batch."""
    raw = with_partition(batch.filter(F.col("reading_type") == "raw"), "event_time")
    return raw.select(PARTITION_COLUMN, "point_id", bucket_of(F.col("event_time"), HOUR).alias("bucket")).distinct()


def recomputed(spark: SparkSession, table: str, touched: DataFrame) -> DataFrame:
    """The hourly rollup of the touched points and hours, from all their stored readings.

    What is joined is dealt by point and hour, as the rollup needs it.
    """
    readings = spark.table(table).filter(F.col(PARTITION_COLUMN).isin(_dates(touched)) & (F.col("reading_type") == "raw"))
    timed = readings.withColumn("bucket", bucket_of(F.col("event_time"), HOUR)).withColumn("v", any_value_of())
    kept = timed.join(touched.select(*HOURLY), HOURLY, "left_semi")
    hours = kept.groupBy(*HOURLY).agg(*hourly_aggregates(F.col("v"), F.col("event_time"), F.col("data_quality")))
    return hours.select(*ROLLUP_COLUMNS)


def start_readings(
    readings: DataFrame, table: str, checkpoint: str, once: bool = False, log: str | None = None
) -> StreamingQuery:
    """Append a stream of readings to a managed table; of equal keys the row of the earliest batch is kept.

    Readings of any age are taken, as only the key decides. With `log`, the hours
    that a micro-batch touches, old ones as well, are rolled up anew from the table
    and written to a change log with a folder per batch. A batch that runs again
    finds its rows stored, appends none, and writes its folder again.
    """
    spark = readings.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            append(spark, table, new_readings(spark, table, batch))
            if log is not None:
                spark.catalog.refreshTable(table)
                batch_writer(log)(recomputed(spark, table, touched_hours(batch)), batch_id)
        finally:
            batch.unpersist()

    writer = readings.writeStream.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).foreachBatch(write).start()


def batch_writer(path: str):
    """A sink with one folder per micro-batch: a replayed batch overwrites its own
    folder, so it never counts twice. `batch_id` is a column when read back."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def start_log(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append rows to a log, one folder per micro-batch.

    Control submissions make the audit this way, and catalog updates their log.
    The live queue or catalog is never written by the stream: it is a fold of the
    log (`control_queue`, `advance_queue`, `lww_merge`), so replays are harmless.
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(batch_writer(path)).start()
