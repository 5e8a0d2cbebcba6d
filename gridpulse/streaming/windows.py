"""The hourly rollup as a stateful stream with a lateness bound, and the repair of hours that are later.

Two streams share a folder. Ingest appends what is new to the readings table, keeps it as
one folder per micro-batch, and rolls up anew, from the table, the hours that are past the
bound. The window stream reads those folders and keeps the hours within the bound as state,
which the watermark drops, so a micro-batch costs what it holds and no table is read for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridpulse.functions.buckets import floor_to, instant, utc_timestamp
from gridpulse.functions.values import any_value_of
from gridpulse.operators.rollups import HOUR, REFRESH_WINDOWS, ROLLUP_COLUMNS, hourly_aggregates
from gridpulse.sources.tables import PARTITION_COLUMN, append
from gridpulse.streaming.ingest import BATCH, batch_writer, new_readings, recomputed, touched_hours
from gridpulse.streaming.rollups import KEYS

#: How late a reading may be for the hourly and for the daily level: as far as their refresh looks back.
LATENESS = {level: back for level, (back, _) in REFRESH_WINDOWS.items()}
ACCEPTED, REPAIRS, WINDOWS = "accepted", "repairs", "windows"
#: Files that a micro-batch of the windows takes at least, and readings of it that a partition of their state takes at least.
BATCH_FILES, STATE_ROWS = 4, 50_000
_PARTITIONS = "spark.sql.shuffle.partitions"
#: More than any number of a micro-batch.
_REPAIRED = 1 << 62


def _written(spark: SparkSession, folder: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def newest_time(spark: SparkSession, table: str) -> dt.datetime | None:
    """The newest event time of a readings table; only its last date is read."""
    last = spark.table(table).agg(F.max(PARTITION_COLUMN)).first()[0]
    return spark.table(table).filter(F.col(PARTITION_COLUMN) == F.lit(last)).agg(F.max("event_time")).first()[0] if last else None


def ingest_batch(spark: SparkSession, table: str, folder: str, lateness: dt.timedelta) -> Callable[[DataFrame, int], None]:
    """What ingest does with a micro-batch; doing it again changes nothing.

    The rows that are new are chosen once and kept; only then are they appended, and by key if an
    earlier run has kept them, which may have appended them as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{folder}/{ACCEPTED}/part={batch_id}"
        kept = _written(spark, place)
        if not kept:
            new_readings(spark, table, batch).write.mode("overwrite").parquet(place)
        rows = spark.read.schema(spark.table(table).schema).parquet(place)
        append(spark, table, new_readings(spark, table, rows) if kept else rows)
        spark.catalog.refreshTable(table)
        newest = newest_time(spark, table)
        late = rows if newest is None else rows.filter(F.col("event_time") < instant(floor_to(newest - lateness, HOUR)))
        batch_writer(f"{folder}/{REPAIRS}")(recomputed(spark, table, touched_hours(late)), batch_id)

    return write


def start_ingest(
    readings: DataFrame, table: str, folder: str, lateness: dt.timedelta = LATENESS["1h"], once: bool = False
) -> StreamingQuery:
    """Append a stream of readings of any age to a managed table, and repair the hours past the bound."""
    write = ingest_batch(readings.sparkSession, table, folder, lateness)
    writer = readings.writeStream.option("checkpointLocation", f"{folder}/checkpoint-ingest")
    return (writer.trigger(availableNow=True) if once else writer).foreachBatch(write).start()


def window_sizes(spark: SparkSession, folder: str, batches: int) -> dict[str, int]:
    """`files` and `partitions` of a window stream that goes through what ingest has kept in about so many micro-batches.

    A micro-batch has costs of its own for every partition of the state, so neither their number nor
    that of the micro-batches follows the files or the session. Only the list of the files and their footers are read.
    """
    kept = spark.read.parquet(f"{folder}/{ACCEPTED}")
    files, rows = -(-len(kept.inputFiles()) // batches), -(-kept.count() // batches)
    return {"files": max(BATCH_FILES, files), "partitions": max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))}


def start_windows(
    spark: SparkSession, table: str, folder: str, lateness: dt.timedelta = LATENESS["1h"], once: bool = False,
    files: int | None = None, partitions: int | None = None,
) -> StreamingQuery:
    """Keep the hours within the bound as streaming state, and log every change of them.

    Readings come in the order in which ingest took them, so what the watermark has
    closed here was past the bound there. The last closed hours leave the state with the
    next micro-batch. `files` bounds the files of a micro-batch. The state has `partitions`, or as many
    as the session shuffles to, from the first start on.
    """
    reader = spark.readStream.schema(spark.table(table).schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    raw = reader.parquet(f"{folder}/{ACCEPTED}/*").filter(F.col("reading_type") == "raw")
    timed = raw.select(
        "point_id", "event_time", "data_quality", any_value_of().alias("v"), utc_timestamp(F.col("event_time")).alias("at")
    ).withWatermark("at", f"{int(lateness.total_seconds())} seconds")
    hours = timed.groupBy(F.window("at", f"{HOUR.seconds} seconds").alias("hour"), "point_id").agg(
        *hourly_aggregates(F.col("v"), F.col("event_time"), F.col("data_quality"))
    )
    bucket = F.expr("timestampadd(MICROSECOND, unix_micros(hour.start), TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    rows = hours.withColumn("bucket", bucket).select(*ROLLUP_COLUMNS)
    writer = rows.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint-windows")
    writer = writer.trigger(availableNow=True) if once else writer
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, partitions or before)  # a query keeps what was set when it started
    try:
        return writer.foreachBatch(batch_writer(f"{folder}/{WINDOWS}")).start()
    finally:
        spark.conf.set(_PARTITIONS, before)


def read_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly rollup that both streams have so far: repaired hours, and the last version of the others.

    Once an hour is past the bound all its later readings are, too, so its repair is newer than its window.
    A micro-batch has an hour once, so versions do not tie, and single columns keep to hash aggregation.
    """
    batch = F.col(BATCH).cast("bigint")
    live = spark.read.parquet(f"{folder}/{WINDOWS}").withColumn("version", batch - _REPAIRED)
    versions = live.unionByName(spark.read.parquet(f"{folder}/{REPAIRS}").withColumn("version", batch))
    newest = [F.max_by(c, "version").alias(c) for c in ROLLUP_COLUMNS if c not in KEYS]
    return versions.groupBy(*KEYS).agg(*newest).select(*ROLLUP_COLUMNS)
