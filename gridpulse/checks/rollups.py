"""Rollups, energy, history, gap filling and rollup tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.registry import query
from gridpulse.checks.views import r
from gridpulse.functions import sql
from gridpulse.functions.scalars import round_half_away
from gridpulse.operators import rollups as tables
from gridpulse.operators.gapfill import readings_gapfilled
from gridpulse.operators.rollup import point_history, power_to_energy, readings_rollup
from gridpulse.session import run_database, run_dir
from gridpulse.sources.adapters import Plant
from gridpulse.sources.tables import create_partitioned, read_table, table_location, with_partition
from gridpulse.streaming.ingest import start_readings
from gridpulse.streaming.rollups import publish, publish_days, read_published, read_rollup
from gridpulse.streaming.sources import files_per_batch, parquet_stream, write_batch
from gridpulse.streaming.windows import read_windows, start_ingest, start_windows, window_sizes

_VALUES = ("avg_value", "min_value", "max_value", "sum_value", "first_value", "last_value")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.select(
        *[round_half_away(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


_STATS = f"""
    count(*) AS sample_count, {r('avg(v)')} AS avg_value, {r('min(v)')} AS min_value, {r('max(v)')} AS max_value,
    {r('sum(v)')} AS sum_value, {r('arg_min_null(v, event_time)')} AS first_value,
    {r('arg_max_null(v, event_time)')} AS last_value,
    CASE WHEN count(DISTINCT q) = 1 THEN min(q) ELSE 'mixed' END AS data_quality"""

_LOCAL = """
    SELECT t.*, s.timezone, date_trunc('{unit}', (t.event_time AT TIME ZONE 'UTC') AT TIME ZONE s.timezone)::TIMESTAMP AS b
    FROM typed t JOIN sites s ON s.site_id = t.site_id"""


def _utc(expr: str) -> str:
    return f"(({expr}) AT TIME ZONE timezone) AT TIME ZONE 'UTC'"


@query("rollup_hour", f"""
    SELECT point_id, time_bucket(INTERVAL 1 HOUR, event_time) AS bucket_start,
           time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS bucket_end, {_STATS}
    FROM typed GROUP BY point_id, time_bucket(INTERVAL 1 HOUR, event_time)""")
def rollup_hour(p: Plant) -> DataFrame:
    return rounded(readings_rollup(p.readings, p.points, bucket="1 hour"), *_VALUES)


@query("rollup_local_day", f"""
    SELECT point_id, {_utc('b')} AS bucket_start, {_utc('b + INTERVAL 1 DAY')} AS bucket_end, {_STATS}
    FROM ({_LOCAL.format(unit='day')}) GROUP BY point_id, b, timezone""")
def rollup_local_day(p: Plant) -> DataFrame:
    located = p.points.join(p.sites.select("site_id", "timezone"), "site_id")
    return rounded(readings_rollup(p.readings, located, *p.span, bucket="1 day", tz=None), *_VALUES)


@query("rollup_week", f"""
    SELECT point_id, time_bucket(INTERVAL 7 DAY, event_time) AS bucket_start,
           time_bucket(INTERVAL 7 DAY, event_time) + INTERVAL 7 DAY AS bucket_end, {_STATS}
    FROM typed GROUP BY point_id, time_bucket(INTERVAL 7 DAY, event_time)""")
def rollup_week(p: Plant) -> DataFrame:
    return rounded(readings_rollup(p.readings, p.points, bucket="1 week"), *_VALUES)


@query("rollup_filtered_points", f"""
    SELECT point_id, time_bucket(INTERVAL 1 DAY, event_time) AS bucket_start,
           time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS bucket_end, {_STATS}
    FROM typed WHERE point_id IN (SELECT point_id FROM points WHERE rollup_uom IS NOT NULL)
    GROUP BY point_id, time_bucket(INTERVAL 1 DAY, event_time)""")
def rollup_filtered_points(p: Plant) -> DataFrame:
    """Membership given as a table: a semi join instead of an array."""
    wanted = p.points.filter(F.col("rollup_uom").isNotNull())
    return rounded(readings_rollup(p.readings, p.points, bucket="1 day", point_ids=wanted), *_VALUES)


@query("energy_day", f"""
    SELECT t.point_id, b AS bucket_start, b + INTERVAL 1 DAY AS bucket_end, n AS sample_count,
           {r('a')} AS avg_power, {r('a * 24 * u.factor')} AS energy, u.rollup_uom AS energy_uom, data_quality
    FROM (SELECT point_id, time_bucket(INTERVAL 1 DAY, event_time) AS b, count(*) AS n, avg(v) AS a,
                 CASE WHEN count(DISTINCT q) = 1 THEN min(q) ELSE 'mixed' END AS data_quality
          FROM typed GROUP BY 1, 2) t
    JOIN units u ON u.point_id = t.point_id""")
def energy_day(p: Plant) -> DataFrame:
    return rounded(power_to_energy(p.readings, p.points, bucket="1 day"), "avg_power", "energy")


def _history_sql(kind: str, value: str, unit: str = "day", hours: int = 24) -> str:
    return f"""
    SELECT x.point_id, {_utc('b')} AS bucket_start, {_utc(f"b + INTERVAL 1 {unit}")} AS bucket_end,
           {r(value)} AS value, '{kind}' AS value_kind, data_quality
    FROM (SELECT point_id, b, timezone, avg(v) AS a, min(v) AS lo, max(v) AS hi, sum(v) AS s,
                 arg_max_null(v, event_time) AS newest,
                 CASE WHEN count(DISTINCT q) = 1 THEN min(q) ELSE 'mixed' END AS data_quality
          FROM ({_LOCAL.format(unit=unit)}) GROUP BY 1, 2, 3) x
    JOIN units u ON u.point_id = x.point_id"""


def _register_history(kind: str, value: str, sample: str = "day", name: str | None = None, hours: int = 24) -> None:
    @query(name or f"history_{kind}", _history_sql(kind, value, sample, hours))
    def history(p: Plant) -> DataFrame:
        return rounded(point_history(p.readings, p.points, p.sites, sample, *p.span, value_kind=kind), "value")


for _kind, _value in {
    "avg": "a", "min": "lo", "max": "hi", "sum": "s", "last": "newest", "energy": "a * 24 * u.factor", "median": "a",
}.items():
    _register_history(_kind, _value)
_register_history("energy", "a * 720 * u.factor", "month", "history_energy_month")
_register_history("avg", "a", "hour", "history_avg_hour")


def _gapfill_sql(width: str) -> str:
    return f"""
    WITH seen AS (
        SELECT point_id, time_bucket(INTERVAL {width}, event_time) AS b, arg_max_null(v, event_time) AS v,
               arg_max_null(q, event_time) AS q
        FROM typed GROUP BY 1, 2),
    grid AS (
        SELECT i.point_id, unnest(generate_series(s.lo, s.hi - INTERVAL {width}, INTERVAL {width})) AS b
        FROM (SELECT DISTINCT point_id FROM seen) i CROSS JOIN span s)
    SELECT g.b AS bucket_time, g.point_id, {r('last_value(seen.v IGNORE NULLS) OVER w')} AS value,
           last_value(seen.q IGNORE NULLS) OVER w AS data_quality, seen.point_id IS NULL AS is_generated
    FROM grid g LEFT JOIN seen ON seen.point_id = g.point_id AND seen.b = g.b
    WINDOW w AS (PARTITION BY g.point_id ORDER BY g.b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("gapfill_hour", _gapfill_sql("1 HOUR"))
def gapfill_hour(p: Plant) -> DataFrame:
    start, end = p.span
    return rounded(readings_gapfilled(p.readings, p.points, start, end, "1 hour"), "value")


@query("gapfill_day", _gapfill_sql("1 DAY"))
def gapfill_day(p: Plant) -> DataFrame:
    start, end = p.span
    return rounded(readings_gapfilled(p.readings, p.points, start, end, "1 day"), "value")


# -- rollup tables -----------------------------------------------------------

_ROLLUP_VALUES = ("sum_value", "avg_value", "min_value", "max_value", "first_value", "last_value")


def _rollup_select(source: str, bucket: str, where: str = "") -> str:
    cols = ", ".join(f"{r(c)} AS {c}" for c in _ROLLUP_VALUES)
    return f"SELECT point_id, {bucket} AS bucket, n, not_online_n, {cols} FROM {source} {where}"


@query("rollup_1h", _rollup_select("hours", "bucket"))
def rollup_1h(p: Plant) -> DataFrame:
    return rounded(tables.rollup_1h(p.readings), *_ROLLUP_VALUES)


@query("rollup_1d", _rollup_select("days", "day"))
def rollup_1d(p: Plant) -> DataFrame:
    return rounded(tables.rollup_1d(tables.rollup_1h(p.readings)), *_ROLLUP_VALUES)


def materialised(p: Plant, until: dt.datetime, daily: bool = False) -> tuple[str, str]:
    """A fresh database with the rollup tables refreshed up to `until`."""
    db = run_database(p.spark, "rollup")
    hourly, day = f"{db}.readings_1h", f"{db}.readings_1d"
    tables.create_rollup(p.spark, hourly, tables.rollup_1h(p.readings))
    tables.refresh(p.spark, hourly, p.readings, None, until, "1h")
    if daily:
        tables.create_rollup(p.spark, day, tables.rollup_1d(tables.rollup_1h(p.readings)))
        tables.refresh(p.spark, day, p.spark.table(hourly), None, until, "1d")
    return hourly, day


@query("realtime_1h", _rollup_select("hours", "bucket"))
def realtime_1h(p: Plant) -> DataFrame:
    """Stored hours up to an hour before now, live hours after: equal to a full rollup."""
    hourly, _ = materialised(p, p.now - dt.timedelta(hours=1))
    return rounded(tables.read_1h(p.spark, hourly, p.readings), *_ROLLUP_VALUES)


@query("realtime_1d", _rollup_select("days", "day"))
def realtime_1d(p: Plant) -> DataFrame:
    hourly, daily = materialised(p, p.now - dt.timedelta(days=1), daily=True)
    return rounded(tables.read_1d(p.spark, daily, hourly, p.readings), *_ROLLUP_VALUES)


@query("refresh_window", _rollup_select(
    "hours", "bucket",
    "WHERE bucket < date_trunc('hour', (SELECT now_at FROM span) - INTERVAL 1 HOUR) "
    "AND (bucket >= date_trunc('hour', (SELECT now_at FROM span) - INTERVAL 3 DAY) "
    "OR bucket < date_trunc('hour', (SELECT now_at FROM span) - INTERVAL 5 DAY))",
))
def refresh_window(p: Plant) -> DataFrame:
    """History up to five days ago, then the scheduled trailing window: the stretch
    between the two stays empty until an explicit refresh covers it."""
    hourly, _ = materialised(p, p.now - dt.timedelta(days=5))
    tables.refresh_due(p.spark, hourly, p.readings, p.now, "1h", retention_days=45)
    stored = p.spark.table(hourly).select(*tables.ROLLUP_COLUMNS)
    return rounded(stored, *_ROLLUP_VALUES)


def in_files(p: Plant, label: str, order: tuple[int, ...] = (4, 3, 2, 1, 0)) -> DataFrame:
    """The events as a stream of files, as many per micro-batch as fit its size: stretches of time in the given order."""
    path = f"{run_dir(p.spark, label)}/events"
    cuts = p.events.agg(F.percentile_approx("ts", [i / len(order) for i in range(1, len(order))])).first()[0]
    stretches = list(zip([None, *cuts], [*cuts, None]))
    inside = []
    for low, high in [stretches[i] for i in order]:
        after = F.lit(True) if low is None else F.col("ts") > F.lit(low)
        inside.append(after if high is None else after & (F.col("ts") <= F.lit(high)))
    files = files_per_batch(list(p.events.agg(*[F.count_if(part).alias(f"n{i}") for i, part in enumerate(inside)]).first()))
    for part in inside:
        write_batch(p.events.filter(part), path, files)
    live = Plant(p.spark, p.sf_dir)
    live.__dict__["events"] = parquet_stream(p.spark, path, p.events.schema, max_files_per_trigger=files)
    return live.readings


def streamed(p: Plant, label: str) -> tuple[str, str]:
    """The readings table and the change log left by a stream over the events."""
    table = f"{run_database(p.spark, 'stream')}.point_readings"
    create_partitioned(p.spark, table, with_partition(p.readings.limit(0), "event_time"))
    path = run_dir(p.spark, label)
    query = start_readings(in_files(p, label), table, f"{path}/checkpoint", once=True, log=f"{path}/log")
    query.awaitTermination()
    p.spark.catalog.refreshTable(table)
    return table, f"{path}/log"


def _streamed(p: Plant, label: str) -> str:
    return streamed(p, label)[1]


@query("stream_rollup_1h", _rollup_select("hours", "bucket"))
def stream_rollup(p: Plant) -> DataFrame:
    """The hourly rollup computed by a stream."""
    return rounded(read_rollup(p.spark, _streamed(p, "stream-rollup")), *_ROLLUP_VALUES)


@query("stream_rollup_published", _rollup_select("hours", "bucket"))
def stream_published(p: Plant) -> DataFrame:
    """The stream's change log folded into the partitioned rollup table."""
    log = _streamed(p, "stream-published")
    table = f"{run_database(p.spark, 'published')}.readings_1h"
    tables.create_rollup(p.spark, table, tables.rollup_1h(p.readings))
    publish(p.spark, log, table)
    return rounded(read_published(p.spark, log, table), *_ROLLUP_VALUES)


@query("stream_rollup_1d", _rollup_select("days", "day"))
def stream_daily(p: Plant) -> DataFrame:
    """Days kept from the stream's change log: only those with changed hours are built."""
    log = _streamed(p, "stream-daily")
    database = run_database(p.spark, "daily")
    hourly, daily = f"{database}.readings_1h", f"{database}.readings_1d"
    tables.create_rollup(p.spark, hourly, tables.rollup_1h(p.readings))
    tables.create_rollup(p.spark, daily, tables.rollup_1d(p.spark.table(hourly)).select(*tables.ROLLUP_COLUMNS))
    publish(p.spark, log, hourly)
    publish_days(p.spark, log, hourly, daily)
    return rounded(p.spark.table(daily).select(*tables.ROLLUP_COLUMNS), *_ROLLUP_VALUES)


@query("stream_windows_1h", _rollup_select("hours", "bucket"))
def stream_windows(p: Plant) -> DataFrame:
    """Hours from streaming state within three days, and repaired hours beyond, over unordered micro-batches."""
    table = f"{run_database(p.spark, 'windows')}.point_readings"
    create_partitioned(p.spark, table, with_partition(p.readings.limit(0), "event_time"))
    folder = run_dir(p.spark, "stream-windows")
    order = (1, 0, 2, 4, 3)
    start_ingest(in_files(p, "stream-windows-in", order), table, folder, once=True).awaitTermination()
    start_windows(p.spark, table, folder, once=True, **window_sizes(p.spark, folder, len(order))).awaitTermination()
    return rounded(read_windows(p.spark, folder), *_ROLLUP_VALUES)


# -- the same reports asked in SQL ---------------------------------------------


def _in_sql(p: Plant, text: str) -> DataFrame:
    sql.register(p.spark, p.readings, p.points, p.sites, "gp_")
    return p.spark.sql(text)


@query("sql_rollup_hour", f"""
    SELECT point_id, time_bucket(INTERVAL 1 HOUR, event_time) AS bucket_start,
           time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS bucket_end, {_STATS}
    FROM typed GROUP BY point_id, time_bucket(INTERVAL 1 HOUR, event_time)""")
def sql_rollup(p: Plant) -> DataFrame:
    """The rollup as a SQL table function."""
    return rounded(_in_sql(p, "SELECT * FROM gp_readings_rollup(NULL, NULL, 'hour', 'UTC')"), *_VALUES)


@query("sql_history_energy", _history_sql("energy", "a * 24 * u.factor"))
def sql_history(p: Plant) -> DataFrame:
    """Every site's daily energy on its own clock: the table function called once per site, laterally."""
    rows = _in_sql(p, """
        SELECT h.* FROM gp_function_sites s, LATERAL gp_point_history(s.site_id, NULL, NULL, 'Day', 'Energy') h""")
    return rounded(rows, "value")


@query("sql_typed_values", f"""
    SELECT site_id, q, count(*) AS n, count(v) AS filled, {r('sum(v * factor)')} AS total
    FROM typed JOIN units USING (point_id) GROUP BY 1, 2""")
def sql_typed_values(p: Plant) -> DataFrame:
    """Value, quality and unit functions called in SQL."""
    rows = _in_sql(p, """
        SELECT site_id, q, count(*) AS n, count(v) AS filled, sum(v * factor) AS total
        FROM (SELECT p.site_id, gp_quality_to_aggregate(r.data_quality) AS q, gp_uom_conversion_factor(p.uom, p.rollup_uom) AS factor,
                     gp_reading_value(p.value_type, r.value_bigint, r.value_double, r.value_numeric) AS v
              FROM gp_function_readings r JOIN gp_function_points p ON p.point_id = r.point_id WHERE r.reading_type = 'raw')
        GROUP BY 1, 2""")
    return rounded(rows, "total")


# -- clocks that change, and ranges that cut ---------------------------------

_ORDER_READINGS = """
    SELECT o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)) AS event_time, o_custkey % 40 AS point_id,
           CASE o_custkey % 3 WHEN 0 THEN 'America/Chicago' WHEN 1 THEN 'Europe/Berlin' ELSE 'Australia/Sydney' END AS order_zone,
           o_totalprice AS v, o_orderkey
    FROM orders"""


def order_readings(p: Plant) -> tuple[DataFrame, DataFrame]:
    """Orders of seven years as readings of a few points, each with a zone that changes its clock."""
    minutes = (F.col("o_orderkey") * 37 % 1440).cast("int")
    zero = F.lit(0)
    shift = F.make_dt_interval(zero, zero, minutes, F.lit(0).cast("decimal(18,6)"))
    zone = F.when(F.col("o_custkey") % 3 == 0, "America/Chicago").when(F.col("o_custkey") % 3 == 1, "Europe/Berlin")
    rows = p.base("orders").select(
        (F.col("o_orderdate") + shift).alias("event_time"),
        F.concat_ws(" ", zone.otherwise("Australia/Sydney"), (F.col("o_custkey") % 40).cast("string")).alias("point_id"),
        F.lit("raw").alias("reading_type"), F.lit(None).cast("bigint").alias("value_bigint"),
        F.col("o_totalprice").cast("double").alias("value_double"), F.lit(None).cast("decimal(38,9)").alias("value_numeric"),
        F.lit("online").alias("data_quality"),
    )
    points = rows.select("point_id").distinct().select(
        "point_id", F.lit("float64").alias("value_type"), F.split_part("point_id", F.lit(" "), F.lit(1)).alias("timezone")
    )
    return rows, points


def _order_rollup_sql(unit: str) -> str:
    return f"""
    SELECT order_zone || ' ' || point_id AS point_id, {_utc('b').replace('timezone', 'order_zone')} AS bucket_start, n AS sample_count,
           {r('hi')} AS max_value, {r('lo')} AS min_value
    FROM (SELECT order_zone, point_id, date_trunc('{unit}', (event_time AT TIME ZONE 'UTC') AT TIME ZONE order_zone)::TIMESTAMP AS b,
                 count(*) AS n, max(v) AS hi, min(v) AS lo
          FROM ({_ORDER_READINGS}) GROUP BY 1, 2, 3)"""


def _order_rollup(p: Plant, width: str) -> DataFrame:
    readings, points = order_readings(p)
    rolled = rounded(readings_rollup(readings, points, bucket=width, tz=None), "max_value", "min_value")
    return rolled.select("point_id", "bucket_start", "sample_count", "max_value", "min_value")


@query("changing_clock_day", _order_rollup_sql("day"))
def changing_clock_day(p: Plant) -> DataFrame:
    return _order_rollup(p, "1 day")


@query("changing_clock_hour", _order_rollup_sql("hour"))
def changing_clock_hour(p: Plant) -> DataFrame:
    """Hours that occur twice are one bucket, which starts at the later of the two."""
    return _order_rollup(p, "1 hour")


@query("changing_clock_gapfill", f"""
    WITH o AS ({_ORDER_READINGS}),
    seen AS (SELECT point_id, date_trunc('day', (event_time AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago')::TIMESTAMP AS b,
                    arg_max(o_orderkey, event_time) AS newest, count(*) AS n
             FROM o WHERE event_time >= TIMESTAMP '1995-03-02 06:00:00' AND event_time < TIMESTAMP '1995-11-20 06:00:00' GROUP BY 1, 2),
    grid AS (SELECT point_id, unnest(generate_series(TIMESTAMP '1995-03-02', TIMESTAMP '1995-11-19', INTERVAL 1 DAY)) AS b
             FROM (SELECT DISTINCT point_id FROM seen))
    SELECT (g.b AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' AS bucket_time, CAST(g.point_id AS VARCHAR) AS point_id,
           seen.n IS NULL AS is_generated, last_value(seen.b IGNORE NULLS) OVER w IS NOT NULL AS filled
    FROM grid g LEFT JOIN seen USING (point_id, b)
    WINDOW w AS (PARTITION BY g.point_id ORDER BY g.b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def changing_clock_gapfill(p: Plant) -> DataFrame:
    """Local days across both changes of the clock."""
    readings, points = order_readings(p)
    number = F.split_part("point_id", F.lit(" "), F.lit(2))
    rows, catalog = readings.withColumn("point_id", number), points.select(number.alias("point_id"), "value_type").distinct()
    filled = readings_gapfilled(
        rows, catalog, dt.datetime(1995, 3, 2, 6), dt.datetime(1995, 11, 20, 6), "1 day", "America/Chicago"
    )
    return filled.select("bucket_time", "point_id", "is_generated", F.col("value").isNotNull().alias("filled"))


_CUT = "event_time >= lo + INTERVAL '3 days 01:07:00' AND event_time < hi - INTERVAL '2 days 05:00:13'"


def _cut(p: Plant) -> tuple[dt.datetime, dt.datetime]:
    low, high = p.span
    return low + dt.timedelta(days=3, hours=1, minutes=7), high - dt.timedelta(days=2, hours=5, seconds=13)


@query("history_15min_of_a_site", f"""
    SELECT point_id, (b AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' AS bucket_start,
           ((b + INTERVAL 15 MINUTE) AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' AS bucket_end, {r('a')} AS value, 'avg' AS value_kind, data_quality
    FROM (SELECT point_id, time_bucket(INTERVAL 15 MINUTE, (event_time AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago') AS b, avg(v) AS a,
                 CASE WHEN count(DISTINCT q) = 1 THEN min(q) ELSE 'mixed' END AS data_quality
          FROM typed, span WHERE {_CUT} GROUP BY 1, 2)""")
def history_of_a_site(p: Plant) -> DataFrame:
    """A range that cuts buckets, on the clock of one site."""
    site = p.sites.filter(F.col("timezone") == "America/Chicago").agg(F.min("site_id")).first()[0]
    history = point_history(p.readings, p.points, p.sites, "15min", *_cut(p), site_id=site)
    return rounded(history, "value")


@query("rollup_5min_range", f"""
    SELECT point_id, time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket_start,
           time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS bucket_end, {_STATS}
    FROM typed, span WHERE {_CUT} GROUP BY point_id, time_bucket(INTERVAL 5 MINUTE, event_time)""")
def rollup_5min_range(p: Plant) -> DataFrame:
    return rounded(readings_rollup(p.readings, p.points, *_cut(p), bucket="5 minutes"), *_VALUES)


@query("rebuilt_readings", """
    SELECT CAST(event_time AS DATE) AS event_date, reading_type, count(*) AS n FROM readings GROUP BY 1, 2""")
def rebuilt(p: Plant) -> DataFrame:
    """A table built twice holds the rows once; it is read with its declared schema."""
    table = f"{run_database(p.spark, 'rebuild')}.point_readings"
    rows = with_partition(p.readings, "event_time")
    create_partitioned(p.spark, table, rows.filter(F.col("reading_type") == "raw"))
    create_partitioned(p.spark, table, rows)
    declared = read_table(p.spark, "point_readings", table_location(p.spark, table))
    return declared.groupBy(F.to_date("event_time").alias("event_date"), "reading_type").agg(F.count(F.lit(1)).alias("n"))
