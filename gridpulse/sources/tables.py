"""Table sources and sinks: declared-schema scans, partitioned appends, config."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.buckets import Bucket, bucket_of, floor_to, instant
from gridpulse.schemas import DEFAULTS, PARTITIONED, SCHEMAS
from gridpulse.session import checkpointed

PARTITION_COLUMN = "event_date"
#: Units of interval settings.
INTERVAL_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Parquet scan with the table's declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def values(spark: SparkSession, schema: T.StructType | str, rows: list[tuple]) -> DataFrame:
    """An inline source of a few literal rows."""
    return spark.createDataFrame(rows, schema)


def with_defaults(df: DataFrame, name: str, now: dt.datetime | None = None) -> DataFrame:
    """Fill columns the writer left out, then fill NULLs with the column defaults.

    `updated_at` and `created_at` default to `now` when one is given.
    """
    schema = SCHEMAS[name]
    defaults = dict(DEFAULTS.get(name, {}))
    if now is not None:
        defaults.update({c: now for c in ("updated_at", "created_at") if c in schema.names})
    out = []
    for field in schema:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            default = defaults[field.name]
            default = instant(default) if isinstance(default, dt.datetime) else F.lit(default)
            value = F.coalesce(value.cast(field.dataType), default.cast(field.dataType))
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def partition_date(t: Column, days: int) -> Column:
    """Start date of the day or multi-day partition that holds `t`."""
    return F.to_date(bucket_of(t, Bucket(seconds=days * 86400)))


def with_partition(df: DataFrame, time_col: str, days: int = 1) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, partition_date(F.col(time_col), days))


def in_range(
    df: DataFrame,
    time_col: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    days: int = 1,
) -> DataFrame:
    """Half-open time filter. When the table carries the partition column the
    same bounds are put on it, so whole partitions are skipped."""
    t = F.col(time_col)
    partitioned = PARTITION_COLUMN in df.columns
    width = Bucket(seconds=days * 86400)
    if start is not None:
        df = df.filter(t >= instant(start))
        if partitioned:
            df = df.filter(F.col(PARTITION_COLUMN) >= F.lit(floor_to(start, width).date()))
    if end is not None:
        df = df.filter(t < instant(end))
        if partitioned:
            last = end - dt.timedelta(microseconds=1)
            df = df.filter(F.col(PARTITION_COLUMN) <= F.lit(last.date()))
    return df


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """One shuffle that gathers each partition date, with oversized dates split
    and small ones merged by adaptive execution; rows sorted by `keys`."""
    return df.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, *keys)


def create_partitioned(spark: SparkSession, table: str, df: DataFrame, sort: tuple[str, ...] = ()) -> None:
    """Create a managed table partitioned by date and fill it (truncate and rebuild)."""
    (
        clustered(df, *sort)
        .write.mode("overwrite")
        .partitionBy(PARTITION_COLUMN)
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(table)
    )


def append(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Insert-from-select: add rows, columns matched by name."""
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def table_days(name: str) -> tuple[str, int]:
    """Time column and partition width in days of a range-partitioned table."""
    return PARTITIONED[name.split(".")[-1]]


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def files(spark: SparkSession, table: str) -> DataFrame:
    """(event_date, path, length) of the table's data files; no column is read."""
    meta = F.col("_metadata")
    return spark.table(table).select(
        PARTITION_COLUMN, meta["file_path"].alias("path"), meta["file_size"].alias("length")
    ).distinct()


def partition_files(spark: SparkSession, table: str, dates: list[dt.date]) -> dict[dt.date, dict[str, int]]:
    """Files and their sizes of the given partitions, as they are now."""
    spark.catalog.refreshTable(table)
    found: dict[dt.date, dict[str, int]] = {}
    for day, path, length in files(spark, table).filter(F.col(PARTITION_COLUMN).isin(dates)).collect():
        found.setdefault(day, {})[path] = length
    return found


def replace_partitions(
    spark: SparkSession, table: str, df: DataFrame, before: dict[dt.date, dict[str, int]]
) -> tuple[list[dt.date], list[dt.date]]:
    """Replace the partitions present in `df`, one by one; returns those replaced and those left alone.

    The rows are written beside the table, under a name of their own, and each partition is then
    pointed at its new files, so readers see the old or the new ones and a failed job
    changes nothing. `before` lists the files that `df` was made from; a partition
    whose files have changed since is left alone, so rows appended meanwhile are not
    lost, and the caller may run again. What still arrives in the old folder until the
    switch is found there afterwards and appended. Old files stay where they are, for
    readers that still use them, until `remove_versions`.
    """
    root = f"{table_location(spark, table)}/_versions/{uuid.uuid4().hex}"
    written = Observation()
    rows = df.select(*spark.table(table).columns).observe(written, F.collect_set(PARTITION_COLUMN).alias("days"))
    rows.write.partitionBy(PARTITION_COLUMN).option("compression", "zstd").parquet(root)
    days = sorted(written.get["days"] or [])
    now = partition_files(spark, table, days) if days else {}
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    done, left = [], []
    for day in days:
        if now.get(day, {}) != before.get(day, {}):
            left.append(day)
            continue
        part, place = f"PARTITION ({PARTITION_COLUMN}='{day}')", f"{root}/{PARTITION_COLUMN}={day}"
        if str(day) in known:
            spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION '{place}'")
        done.append(day)
        _append_stragglers(spark, table, day, before.get(day, {}))
    spark.catalog.refreshTable(table)
    return done, left


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _append_stragglers(spark: SparkSession, table: str, day: dt.date, known: dict[str, int]) -> None:
    """Append the rows of files that a partition's former folders hold beside the known ones."""
    names = {path.rsplit("/", 1)[1] for path in known}
    more = []
    for folder in {path.rsplit("/", 1)[0] for path in known}:
        system, place = _folder(spark, folder)
        found = [status.getPath() for status in system.listStatus(place)] if system.exists(place) else []
        more += [str(p.toString()) for p in found if p.getName() not in names and not p.getName().startswith(("_", "."))]
    if more:
        kept = [f for f in spark.table(table).schema if f.name != PARTITION_COLUMN]
        rows = spark.read.schema(T.StructType(kept)).parquet(*more)
        append(spark, table, rows.withColumn(PARTITION_COLUMN, F.lit(day)))


def remove_versions(spark: SparkSession, table: str, before: dt.datetime) -> int:
    """Delete folders of old partition versions that no partition points at, last written before `before`.

    Returns how many went. `before` leaves readers and writers that began on an old
    version the time to end; it is UTC. Folders in use are never touched.
    """
    spark.catalog.refreshTable(table)
    live = {r[0] for r in files(spark, table).select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()}
    names = {folder.split("/", 1)[1].lstrip("/") for folder in live}
    limit, gone = before.replace(tzinfo=dt.timezone.utc).timestamp() * 1000, 0
    system, root = _folder(spark, table_location(spark, table))
    versions = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_versions")
    groups = [g.getPath() for g in system.listStatus(versions)] if system.exists(versions) else []
    for group in [root, *groups]:
        for status in system.listStatus(group):
            place = status.getPath()
            if not status.isDirectory() or not place.getName().startswith(f"{PARTITION_COLUMN}="):
                continue
            newest = max([status.getModificationTime(), *(f.getModificationTime() for f in system.listStatus(place))])
            if place.toString().split("/", 1)[1].lstrip("/") not in names and newest < limit:
                gone += bool(system.delete(place, True))
    return gone



def staged(df: DataFrame, view: str) -> DataFrame:
    """An intermediate result written once, for several readers, and named as a view."""
    kept = checkpointed(df)
    kept.createOrReplaceTempView(view)
    return kept


def discard(df: DataFrame, *observed: Column) -> dict[str, object]:
    """Run the whole plan and throw the rows away (for timing); what aggregates, each with a name, have seen of them."""
    seen = Observation()
    watched = df.observe(seen, *observed) if observed else df
    watched.write.format("noop").mode("overwrite").save()
    return dict(seen.get) if observed else {}


def config_value(config: DataFrame, key: str, kind: str = "text") -> object:
    """Typed value of one config key; an unknown key gives None.

    `interval` values come back as a `Bucket`.
    """
    rows = config.filter(F.col("key") == key).select("value").limit(1).collect()
    if not rows or rows[0][0] is None:
        return None
    text = rows[0][0]
    if kind == "interval":
        return Bucket.of(text)
    return {"text": str, "int": int, "float": float}[kind](text)


def config_columns(config: DataFrame) -> DataFrame:
    """Every config row read as text, integer, float and seconds of an interval at once."""
    return config.select(
        "key",
        F.col("value").alias("as_text"),
        F.expr("try_cast(value AS INT)").alias("as_int"),
        F.expr("try_cast(value AS DOUBLE)").alias("as_float"),
        _interval_seconds(F.col("value")).alias("as_interval_s"),
    )


def _interval_seconds(text: Column) -> Column:
    """Seconds of a width like `15 minutes`; NULL for other texts."""
    number = F.regexp_extract(F.lower(text), r"^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$", 1)
    unit = F.regexp_extract(F.lower(text), r"^\s*(\d+)\s*(second|minute|hour|day|week)s?\s*$", 2)
    seconds = F.create_map(*[F.lit(x) for pair in INTERVAL_SECONDS.items() for x in pair])
    return F.when(number != "", number.cast("bigint") * seconds[unit])


def time_series(df: DataFrame, start: Column, stop: Column, step: Column, name: str) -> DataFrame:
    """One row per step from `start` to `stop`, both included, for every input row."""
    return df.withColumn(name, F.explode(F.sequence(start, stop, step)))


def time_span(df: DataFrame, time_col: str) -> tuple[dt.datetime, dt.datetime]:
    """First day and the day after the last one, from the two extreme times."""
    low, high = df.agg(F.min(time_col), F.max(time_col)).first()
    day = dt.timedelta(days=1)
    return floor_to(low, Bucket(seconds=86400)), floor_to(high, Bucket(seconds=86400)) + day
