"""The value, clock and report functions as SQL functions of a session.

`register` makes them temporary functions whose bodies are SQL, so a call is inlined
into the query and planned with it, without Python. Table functions read the
three tables they are registered with, and can be called laterally, per site for example.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridpulse.functions.buckets import SAMPLE_TIMES, WEEK_ORIGIN, Bucket
from gridpulse.functions.values import UNIT_FACTORS

_NTZ = "TIMESTAMP_NTZ"
_DAY = "INTERVAL '1' DAY"


def _literal(t) -> str:
    return f"{_NTZ} '{t.isoformat(sep=' ')}'"


def _factor() -> str:
    pairs = ", ".join(f"'{a}>{b}', {factor!r}D" for (a, b), factor in UNIT_FACTORS.items())
    return f"coalesce(try_element_at(map({pairs}), concat(uom, '>', rollup_uom)), 1.0D)"


def _to_local(t: str, tz: str) -> str:
    return f"convert_timezone('UTC', {tz}, {t})"


def _from_local(wall: str, tz: str) -> str:
    """A wall clock that occurs twice means the later time, one that is skipped moves forward."""
    first = f"convert_timezone({tz}, 'UTC', {wall})"
    later = f"({wall} - ({_to_local(f'{first} + {_DAY}', tz)} - ({first} + {_DAY})))"
    return f"CASE WHEN {later} > {first} AND {_to_local(later, tz)} = {wall} THEN {later} ELSE {first} END"


def _fixed(width: str, t: str) -> str:
    since = f"({t} - {_literal(WEEK_ORIGIN)})"
    steps = f"({since} div {width})"
    return f"{_literal(WEEK_ORIGIN)} + {width} * ({steps} - CASE WHEN {width} * {steps} > {since} THEN 1 ELSE 0 END)"


def _by_sample(of_fixed: Callable[[int], str], of_month: str, kind: str) -> str:
    """A value by the sample keyword; `of_fixed` takes the seconds of a width."""
    whens = []
    for word, width in SAMPLE_TIMES.items():
        bucket = Bucket.of(width)
        whens.append(f"WHEN '{word}' THEN {of_month if bucket.months else of_fixed(bucket.seconds)}")
    unknown = f"CAST(raise_error(concat('unknown sample time ', sample)) AS {kind})"
    return f"CASE lower(sample) {' '.join(whens)} ELSE {unknown} END"


def _bucket(t: str) -> str:
    return _by_sample(lambda n: _fixed(f"INTERVAL '{n}' SECOND", t), f"CAST(trunc(CAST({t} AS DATE), 'MONTH') AS {_NTZ})", _NTZ)


def _next(bucket: str) -> str:
    return _by_sample(lambda n: f"{bucket} + INTERVAL '{n}' SECOND", f"{bucket} + INTERVAL '1' MONTH", _NTZ)


def _value(point: str = "", reading: str = "") -> str:
    return (
        f"CASE {point}value_type WHEN 'int64' THEN CAST({reading}value_bigint AS DOUBLE) WHEN 'float64' THEN {reading}value_double"
        f" WHEN 'numeric' THEN CAST({reading}value_numeric AS DOUBLE) END"
    )


def _quality(quality: str) -> str:
    return f"CASE WHEN {quality} IN ('online', 'estimated') THEN {quality} ELSE 'offline' END"


#: Quality as a small integer, which keeps the plan on hash aggregation.
_CODE = "CASE r.data_quality WHEN 'online' THEN 0 WHEN 'estimated' THEN 1 ELSE 2 END"
_HOURS = _by_sample(lambda n: f"{n}D / 3600", "720D", "DOUBLE")

#: Head, type and body of the scalar functions.
SCALARS = [
    ("reading_value(value_type STRING, value_bigint BIGINT, value_double DOUBLE, value_numeric DECIMAL(38,9))", "DOUBLE", _value()),
    ("quality_to_aggregate(quality STRING)", "STRING", _quality("quality")),
    ("uom_conversion_factor(uom STRING, rollup_uom STRING)", "DOUBLE", _factor()),
    (f"to_local_clock(t {_NTZ}, tz STRING)", _NTZ, _to_local("t", "tz")),
    (f"from_local_clock(wall {_NTZ}, tz STRING)", _NTZ, _from_local("wall", "tz")),
    (f"fixed_bucket(width INTERVAL DAY TO SECOND, t {_NTZ})", _NTZ, _fixed("width", "t")),
    (f"sample_bucket(sample STRING, t {_NTZ})", _NTZ, _bucket("t")),
    (f"next_bucket(sample STRING, bucket {_NTZ})", _NTZ, _next("bucket")),
    ("sample_hours(sample STRING)", "DOUBLE", _HOURS),
]

_STATS = (
    "sample_count BIGINT, avg_value DOUBLE, min_value DOUBLE, max_value DOUBLE, sum_value DOUBLE, "
    "first_value DOUBLE, last_value DOUBLE, data_quality STRING"
)
#: A range with an open end where its bound is NULL; heartbeats are left out.
_IN_RANGE = "r.reading_type = 'raw' AND (from_time IS NULL OR r.event_time >= from_time) AND (to_time IS NULL OR r.event_time < to_time)"


def _grouped(tables: dict[str, str], zone: str, keys: str, more: str = "", condition: str = "") -> str:
    """Statistics per point and bucket on a clock. Bodies stand as text, and no argument is used where rows are
    aggregated: in a lateral function Spark allows neither calls nor arguments there."""
    return f"""
        SELECT {keys}, {_from_local('b', 'zone')} AS bucket_start, {_from_local('b_end', 'zone')} AS bucket_end, stats.*
        FROM (SELECT *, {_next('b')} AS b_end FROM (
            SELECT {keys}, b, zone, struct(
                count(*) AS sample_count, avg(v) AS avg_value, min(v) AS min_value, max(v) AS max_value, sum(v) AS sum_value,
                min_by(v, event_time) AS first_value, max_by(v, event_time) AS last_value,
                CASE WHEN min(q) <> max(q) THEN 'mixed' WHEN min(q) = 0 THEN 'online' WHEN min(q) = 1 THEN 'estimated' ELSE 'offline' END
                    AS data_quality) AS stats
            FROM (SELECT *, {_bucket('clock')} AS b FROM (
                SELECT p.*, r.event_time, {_value('p.', 'r.')} AS v, {_CODE} AS q, {zone} AS zone,
                    {_to_local('r.event_time', zone)} AS clock
                FROM {tables['readings']} r JOIN {tables['points']} p ON p.point_id = r.point_id {more}
                WHERE {condition}{_IN_RANGE}))
            GROUP BY {keys}, b, zone))"""


def register(spark: SparkSession, readings: DataFrame, points: DataFrame, sites: DataFrame, prefix: str = "") -> None:
    """Make the functions known to the session, over these tables; `prefix` goes before all their names.

    Table functions: `readings_rollup(from_time, to_time, sample, tz)` on one clock, and
    `point_history(site, from_time, to_time, sample, value_kind)` on the clock of the site. Samples are the
    keywords of `buckets.SAMPLE_TIMES`; a bound that is NULL is open, and an unknown value kind means the average.
    In a lateral call the site is joined by its key; each distinct tuple of the other arguments meets the
    readings on its own, so give them as literals.
    """
    catalog = points.select("point_id", "site_id", "value_type", "uom", "rollup_uom")
    tables = {name: f"{prefix}function_{name}" for name in ("readings", "points", "sites")}
    for name, df in (("readings", readings), ("points", catalog), ("sites", sites)):
        df.createOrReplaceTempView(tables[name])
    for head, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{head} RETURNS {kind} RETURN {body}")
    point, site = points.schema["point_id"].dataType.simpleString(), sites.schema["site_id"].dataType.simpleString()
    spans = f"from_time {_NTZ}, to_time {_NTZ}, sample STRING"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}readings_rollup({spans}, tz STRING)
        RETURNS TABLE (point_id {point}, bucket_start {_NTZ}, bucket_end {_NTZ}, {_STATS})
        RETURN {_grouped(tables, 'tz', 'point_id')}""")
    own_clock = f"JOIN {tables['sites']} s ON s.site_id = p.site_id"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}point_history(site {site}, {spans}, value_kind STRING)
        RETURNS TABLE (point_id {point}, bucket_start {_NTZ}, bucket_end {_NTZ}, value DOUBLE, value_kind STRING, data_quality STRING)
        RETURN SELECT point_id, bucket_start, bucket_end,
            CASE lower(value_kind) WHEN 'min' THEN min_value WHEN 'max' THEN max_value WHEN 'sum' THEN sum_value
                WHEN 'last' THEN last_value WHEN 'energy' THEN avg_value * ({_HOURS}) * {_factor()} ELSE avg_value END,
            lower(value_kind), data_quality
        FROM ({_grouped(tables, 's.timezone', 'point_id, uom, rollup_uom', own_clock, 's.site_id = site AND ')})""")
