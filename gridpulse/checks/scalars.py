"""Scalar functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.registry import query
from gridpulse.checks.views import r
from gridpulse.functions import scalars as sc
from gridpulse.functions import values as v
from gridpulse.functions.buckets import Bucket, bucket_of, date_bin, instant, local_day, local_hours, to_local, to_utc
from gridpulse.sources.adapters import Plant
from gridpulse.sources.tables import config_columns, time_series, with_defaults


@query("reading_value", f"""
    SELECT event_time, r.point_id,
           {r("CASE p.value_type WHEN 'int64' THEN CAST(value_bigint AS DOUBLE) WHEN 'float64' THEN value_double WHEN 'numeric' THEN CAST(value_numeric AS DOUBLE) END")} AS value
    FROM readings r JOIN points p ON p.point_id = r.point_id""")
def reading_value(p: Plant) -> DataFrame:
    rows = p.readings.join(p.points.select("point_id", "value_type"), "point_id")
    return rows.select("event_time", "point_id", sc.round_half_away(v.reading_value(), 4).alias("value"))


@query("typed_coalesce", f"SELECT event_time, point_id, {r('v')} AS value FROM valued")
def typed_coalesce(p: Plant) -> DataFrame:
    return p.readings.select("event_time", "point_id", sc.round_half_away(v.any_value_of(), 4).alias("value"))


@query("quality_to_aggregate", """
    SELECT data_quality, CASE data_quality WHEN 'online' THEN 'online' WHEN 'estimated' THEN 'estimated' ELSE 'offline' END AS agg_quality,
           count(*) AS n FROM readings GROUP BY 1, 2""")
def quality(p: Plant) -> DataFrame:
    return p.readings.groupBy("data_quality", v.quality_to_aggregate().alias("agg_quality")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("uom_factor", "SELECT p.point_id, p.uom, p.rollup_uom, u.factor FROM points p JOIN units u USING (point_id)")
def uom_factor(p: Plant) -> DataFrame:
    return p.points.select("point_id", "uom", "rollup_uom", v.uom_conversion_factor("uom", "rollup_uom").alias("factor"))


#: All units, so that every pair of them occurs.
_UNITS = ("W", "kW", "MW", "Wh", "kWh", "MWh", "Wh/m2", "kWh/m2", "degC")


@query("uom_factor_all_pairs", f"""
    WITH u AS (SELECT o_orderkey, ({list(_UNITS)})[CAST(o_orderkey % 9 AS INTEGER) + 1] AS uom,
                      ({list(_UNITS)})[CAST(o_custkey % 9 AS INTEGER) + 1] AS rollup_uom FROM orders)
    SELECT o_orderkey, uom, rollup_uom, CASE uom || '>' || rollup_uom
        WHEN 'W>kWh' THEN 0.001 WHEN 'W>MWh' THEN 0.000001 WHEN 'kW>Wh' THEN 1000 WHEN 'kW>MWh' THEN 0.001
        WHEN 'MW>Wh' THEN 1000000 WHEN 'MW>kWh' THEN 1000 WHEN 'Wh>kWh' THEN 0.001 WHEN 'Wh>MWh' THEN 0.000001
        WHEN 'kWh>Wh' THEN 1000 WHEN 'kWh>MWh' THEN 0.001 WHEN 'MWh>kWh' THEN 1000 WHEN 'Wh/m2>kWh/m2' THEN 0.001
        ELSE 1 END::DOUBLE AS factor
    FROM u""")
def uom_factor_all_pairs(p: Plant) -> DataFrame:
    units = F.array(*map(F.lit, _UNITS))
    rows = p.base("orders").select(
        "o_orderkey", F.get(units, (F.col("o_orderkey") % 9).cast("int")).alias("uom"),
        F.get(units, (F.col("o_custkey") % 9).cast("int")).alias("rollup_uom"),
    )
    return rows.withColumn("factor", v.uom_conversion_factor("uom", "rollup_uom"))


@query("open_rank", """
    SELECT status, CASE WHEN status IN ('queued', 'accepted', 'scheduled', 'active') THEN 1 ELSE 9 END AS open_rank,
           count(*) AS n FROM control_log GROUP BY 1, 2""")
def open_rank(p: Plant) -> DataFrame:
    return p.control_log.groupBy("status", v.open_rank().alias("open_rank")).agg(F.count(F.lit(1)).alias("n"))


def _bucket_query(name: str, width: str, interval: str) -> None:
    @query(name, f"""
        SELECT event_time, point_id, time_bucket({interval}, event_time)::TIMESTAMP AS bucket FROM readings""")
    def bucketed(p: Plant) -> DataFrame:
        return p.readings.select("event_time", "point_id", bucket_of(F.col("event_time"), width).alias("bucket"))


for _name, _width, _interval in (
    ("bucket_5min", "5 minutes", "INTERVAL 5 MINUTE"),
    ("bucket_15min", "15 minutes", "INTERVAL 15 MINUTE"),
    ("bucket_hour", "1 hour", "INTERVAL 1 HOUR"),
    ("bucket_day", "1 day", "INTERVAL 1 DAY"),
    ("bucket_week", "1 week", "INTERVAL 7 DAY"),
    ("bucket_month", "1 month", "INTERVAL 1 MONTH"),
):
    _bucket_query(_name, _width, _interval)


@query("bucket_quarter", """
    SELECT o_orderkey, time_bucket(INTERVAL 3 MONTH, o_orderdate)::TIMESTAMP AS bucket FROM orders""")
def bucket_quarter(p: Plant) -> DataFrame:
    return p.base("orders").select("o_orderkey", bucket_of(F.col("o_orderdate"), "3 months").alias("bucket"))


@query("date_bin_5min", """
    SELECT event_time, point_id, time_bucket(INTERVAL 5 MINUTE, event_time, TIMESTAMP '2000-01-01') AS bin FROM readings""")
def date_bin_5min(p: Plant) -> DataFrame:
    return p.readings.select("event_time", "point_id", date_bin(F.col("event_time"), "5 minutes").alias("bin"))


@query("date_bin_before_origin", """
    SELECT o_orderkey, time_bucket(INTERVAL 7 HOUR, o_orderdate, TIMESTAMP '2030-05-05 01:30:00') AS bin FROM orders""")
def before_origin(p: Plant) -> DataFrame:
    origin = dt.datetime(2030, 5, 5, 1, 30)
    return p.base("orders").select("o_orderkey", date_bin(F.col("o_orderdate"), Bucket(seconds=25200), origin).alias("bin"))


_AT_SITE = """(SELECT r.event_time, r.point_id, s.timezone,
    (r.event_time AT TIME ZONE 'UTC') AT TIME ZONE s.timezone AS local_time
    FROM readings r JOIN points p ON p.point_id = r.point_id JOIN sites s ON s.site_id = p.site_id)"""


@query("bucket_local_day", f"""
    SELECT event_time, point_id, local_time, CAST(local_time AS DATE) AS local_day,
           {r('hour(local_time) + minute(local_time) / 60.0 + (second(local_time) + (microsecond(local_time) % 1000000) / 1000000.0) / 3600.0', 6)} AS local_hours,
           dayofyear(local_time) AS day_of_year,
           (date_trunc('day', local_time)::TIMESTAMP AT TIME ZONE timezone) AT TIME ZONE 'UTC' AS day_start
    FROM {_AT_SITE}""")
def bucket_local_day(p: Plant) -> DataFrame:
    catalog = p.points.join(p.sites.select("site_id", "timezone"), "site_id").select("point_id", "timezone")
    t, zone = F.col("event_time"), F.col("timezone")
    rows = p.readings.join(catalog, "point_id").withColumn("local_time", to_local(t, zone))
    rows = rows.withColumn("day", bucket_of(F.col("local_time"), "1 day"))
    return rows.select(
        "event_time", "point_id", "local_time",
        local_day(t, zone).alias("local_day"),
        sc.round_half_away(local_hours(t, zone), 6).alias("local_hours"),
        F.dayofyear("local_time").cast("bigint").alias("day_of_year"),
        to_utc(F.col("day"), zone).alias("day_start"),
    )


@query("hour_bands", f"""
    WITH h AS (SELECT event_time, point_id, hour(local_time) + minute(local_time) / 60.0
                      + (second(local_time) + (microsecond(local_time) % 1000000) / 1000000.0) / 3600.0 AS x FROM {_AT_SITE})
    SELECT event_time, point_id, CASE WHEN x >= 6 AND x < 12 THEN 'morning' WHEN x >= 12 AND x < 18 THEN 'afternoon' ELSE 'off' END AS band
    FROM h""")
def hour_bands(p: Plant) -> DataFrame:
    """Readings by half-open ranges of the local hour."""
    catalog = p.points.join(p.sites.select("site_id", "timezone"), "site_id").select("point_id", "timezone")
    rows = p.readings.join(catalog, "point_id").withColumn("x", local_hours(F.col("event_time"), F.col("timezone")))
    band = sc.between_hours(F.col("x"), [(6, 12, F.lit("morning")), (12, 18, F.lit("afternoon"))], F.lit("off"))
    return rows.select("event_time", "point_id", band.alias("band"))


@query("number_text", "SELECT event_id, printf('%.2f', CAST(round(CAST(value AS DECIMAL(38,9)), 2) AS DOUBLE)) AS label FROM events")
def number_text(p: Plant) -> DataFrame:
    return p.events.select("event_id", sc.number_text("value", 2).alias("label"))


@query("time_arithmetic", """
    SELECT event_id, ts + to_minutes(CAST(round_even(value, 0) AS BIGINT)) AS later, ts - INTERVAL 7 DAY AS earlier,
           CAST(ts AS DATE) + 1 AS next_day, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 11 HOUR AS eleven,
           date_trunc('day', ts)::TIMESTAMP AS day_start, epoch(hi - ts)::BIGINT AS age_s
    FROM events CROSS JOIN span""")
def time_arithmetic(p: Plant) -> DataFrame:
    ts = F.col("ts")
    zero = F.lit(0)
    minutes = F.make_dt_interval(zero, zero, sc.to_int("value"), F.lit(0).cast("decimal(18,6)"))
    age = instant(p.span[1]) - ts
    micros = F.date_part(F.lit("DAY"), age) * 86400 + F.date_part(F.lit("HOUR"), age) * 3600 + F.date_part(F.lit("MINUTE"), age) * 60
    return p.events.select(
        "event_id",
        (ts + minutes).alias("later"),
        (ts - F.expr("INTERVAL '7' DAY")).alias("earlier"),
        F.date_add(F.to_date(ts), 1).alias("next_day"),
        (F.to_date(ts).cast("timestamp_ntz") + F.expr("INTERVAL '11' HOUR")).alias("eleven"),
        F.to_date(ts).cast("timestamp_ntz").alias("day_start"),
        F.bround(micros + F.date_part(F.lit("SECOND"), age).cast("double"), 0).cast("bigint").alias("age_s"),
    )


@query("series_per_point", """
    SELECT point_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS at_time FROM points CROSS JOIN span""")
def series_per_point(p: Plant) -> DataFrame:
    """A time grid per point, both ends included."""
    start, end = (instant(t) for t in p.span)
    return time_series(p.points.select("point_id"), start, end, F.expr("INTERVAL '1' DAY"), "at_time")


@query("rounding_and_math", f"""
    SELECT event_id, {r('value', 1)} AS one_digit, {r('sin(value)', 6)} AS s, {r('cos(value)', 6)} AS c,
           {r('power(value / 100.0, 1.15)', 6)} AS p, {r('sin(2 * pi() * value / 365.0)', 6)} AS season,
           {r('least(value, 50.0)')} AS clipped, {r('greatest(value - 40.0, 0.0)')} AS above
    FROM events""")
def rounding(p: Plant) -> DataFrame:
    x = F.col("value")
    return p.events.select(
        "event_id",
        sc.round_half_away(x, 1).alias("one_digit"),
        sc.round_half_away(F.sin(x), 6).alias("s"),
        sc.round_half_away(F.cos(x), 6).alias("c"),
        sc.round_half_away(F.pow(x / 100.0, F.lit(1.15)), 6).alias("p"),
        sc.round_half_away(F.sin(2 * F.pi() * x / 365.0), 6).alias("season"),
        sc.round_half_away(F.least(x, F.lit(50.0)), 4).alias("clipped"),
        sc.round_half_away(F.greatest(x - 40.0, F.lit(0.0)), 4).alias("above"),
    )


@query("casts", """
    SELECT event_id, CAST(ts AS DATE) AS d, CAST(round_even(value, 0) AS INTEGER) AS i, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS n,
           CAST(event_id AS VARCHAR) AS t, CAST(event_id AS DOUBLE) AS f FROM events""")
def casts(p: Plant) -> DataFrame:
    x = F.col("value")
    return p.events.select(
        "event_id", F.to_date("ts").alias("d"), sc.to_int(x).alias("i"), x.cast("decimal(18,2)").cast("string").alias("n"),
        F.col("event_id").cast("string").alias("t"), F.col("event_id").cast("double").alias("f"),
    )


@query("string_functions", """
    SELECT point_id, 'INV' || lpad(CAST(point_id AS VARCHAR), 8, '0') AS code, repeat('  ', 2) || name AS indented,
           lower(trim('  ' || name || ' ')) AS lowered, left(name, 8) AS head, uom || '/' || coalesce(rollup_uom, '-') AS units
    FROM points""")
def strings(p: Plant) -> DataFrame:
    name = F.col("name")
    return p.points.select(
        "point_id",
        F.format_string("INV%s", F.lpad(F.col("point_id").cast("string"), 8, "0")).alias("code"),
        F.concat(F.repeat(F.lit("  "), F.lit(2)), name).alias("indented"),
        F.lower(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("lowered"),
        F.left(name, F.lit(8)).alias("head"),
        F.concat_ws("/", F.col("uom"), F.coalesce("rollup_uom", F.lit("-"))).alias("units"),
    )


@query("whitespace_squeeze", r"""
    SELECT doc_id, md5(regexp_replace(text, '\s+', ' ', 'g')) AS digest FROM documents""")
def whitespace(p: Plant) -> DataFrame:
    """Whole texts squeezed; the digest stands for the text in the result."""
    return p.base("documents").select("doc_id", F.md5(sc.squeeze("text", None)).alias("digest"))


@query("json_extract", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing
    FROM events""")
def json_extract(p: Plant) -> DataFrame:
    return p.events.select("event_id", sc.json_text("props", "k").cast("int").alias("k"), sc.json_text("props", "none").alias("missing"))


@query("array_functions", """
    SELECT control_request_id, line, setpoint AS first_element, CAST(NULL AS DOUBLE) AS second_element,
           status IN ('queued', 'accepted') AS is_member, 1 AS size
    FROM control_log""")
def arrays(p: Plant) -> DataFrame:
    rows = p.control_log.withColumn("value", F.array("setpoint"))
    return rows.select(
        "control_request_id", "line",
        sc.element("value", 1).cast("double").alias("first_element"),
        sc.element("value", 2).cast("double").alias("second_element"),
        F.array_contains(F.array(F.lit("queued"), F.lit("accepted")), F.col("status")).alias("is_member"),
        F.size("value").alias("size"),
    )


@query("array_unnest", """
    SELECT l_orderkey, l_linenumber, unnest(list_filter([l_returnflag, l_linestatus, 'x'], lambda e: e <> 'x')) AS flag FROM lineitem""")
def unnest(p: Plant) -> DataFrame:
    flags = F.array_remove(F.array("l_returnflag", "l_linestatus", F.lit("x")), "x")
    return p.base("lineitem").select("l_orderkey", "l_linenumber", F.explode(flags).alias("flag"))


@query("null_logic", """
    SELECT point_id, coalesce(rollup_uom, uom) AS unit, nullif(uom, 'kW') AS not_kw,
           (rollup_uom = uom) IS NOT TRUE AS is_not_true, rollup_uom IS NOT NULL AS has_rollup
    FROM points""")
def null_logic(p: Plant) -> DataFrame:
    return p.points.select(
        "point_id",
        F.coalesce("rollup_uom", "uom").alias("unit"),
        F.nullif(F.col("uom"), F.lit("kW")).alias("not_kw"),
        sc.is_not_true(F.col("rollup_uom") == F.col("uom")).alias("is_not_true"),
        F.col("rollup_uom").isNotNull().alias("has_rollup"),
    )


@query("size_formatting", """
    SELECT source, round(sum(n_chars) / 1073741824.0::DOUBLE, 3) AS gib, round(100.0 * (1 - count(*)::DOUBLE / nullif(sum(n_chars), 0)::DOUBLE), 1) AS saved_pct,
           round(sum(n_chars)::DOUBLE / nullif(count(*), 0), 1) AS ratio
    FROM documents GROUP BY source""")
def sizes(p: Plant) -> DataFrame:
    sums = p.base("documents").groupBy("source").agg(F.sum("n_chars").alias("before"), F.count(F.lit(1)).alias("after"))
    return sums.select(
        "source", sc.gib("before").alias("gib"), sc.percent_saved("before", "after").alias("saved_pct"),
        sc.ratio("before", "after").alias("ratio"),
    )


@query("enum_sort", """
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
                WHEN '4-NOT SPECIFIED' THEN 1 ELSE 2 END AS ordinal
    FROM orders""")
def enum_sort(p: Plant) -> DataFrame:
    """Order priorities as alarm severities, sorted by declaration order."""
    label = F.lower(F.element_at(F.split("o_orderpriority", "-"), 2))
    severity = F.when(label == "urgent", "critical").when(label == "not specified", "information").otherwise(label)
    ordinal = v.enum_ordinal("alarm_severity", severity)
    return p.base("orders").select("o_orderkey", "o_orderpriority", ordinal.cast("int").alias("ordinal")).orderBy("ordinal")


@query("like_escape", r"""
    SELECT p_partkey, replace(p_name, ' ', '_') LIKE 'small\_%' ESCAPE '\' AS starts,
           replace(p_name, ' ', '_') NOT LIKE '%\_ring' ESCAPE '\' AS not_ring
    FROM part""")
def like_escape(p: Plant) -> DataFrame:
    """Patterns in which the underscore stands for itself."""
    names = p.base("part").select("p_partkey", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("name"))
    return names.selectExpr(
        "p_partkey", "name LIKE 'small!_%' ESCAPE '!' AS starts", "name NOT LIKE '%!_ring' ESCAPE '!' AS not_ring"
    )


@query("set_predicates", """
    SELECT point_id, count(*) AS n FROM readings
    WHERE data_quality IN ('online', 'offline', 'estimated') AND data_quality NOT IN ('offline') AND reading_type <> 'heartbeat'
      AND event_time BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span)
    GROUP BY 1""")
def set_predicates(p: Plant) -> DataFrame:
    low, high = (instant(t) for t in p.span)
    q = F.col("data_quality")
    kept = p.readings.filter(
        q.isin("online", "offline", "estimated") & ~q.isin("offline") & (F.col("reading_type") != "heartbeat")
        & F.col("event_time").between(low, high)
    )
    return kept.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"))


@query("bernoulli_sample", f"""
    SELECT event_id, ts, user_id FROM events
    WHERE CAST('0x' || left(md5(CAST(event_id AS VARCHAR) || ':42'), 15) AS BIGINT) < {round(0.1 * (1 << 60))}""")
def sample(p: Plant) -> DataFrame:
    """Reproducible row sampling."""
    return p.events.filter(sc.sampled("event_id", 0.1)).select("event_id", "ts", "user_id")


@query("stable_ids", """
    SELECT point_id, sha256(concat(point_id, chr(1), name)) AS id FROM points""")
def stable_ids(p: Plant) -> DataFrame:
    return p.points.select("point_id", sc.stable_id("point_id", "name").alias("id"))


@query("config_typed", """
    SELECT key, value AS as_text, TRY_CAST(value AS INTEGER) AS as_int, TRY_CAST(value AS DOUBLE) AS as_float,
           CASE WHEN value LIKE '% Minutes' THEN CAST(split_part(value, ' ', 1) AS BIGINT) * 60
                WHEN value LIKE '% day' THEN CAST(split_part(value, ' ', 1) AS BIGINT) * 86400 END AS as_interval_s
    FROM (SELECT p_name || ' ' || p_partkey AS key,
                 CASE WHEN p_size < 15 THEN CAST(p_size AS VARCHAR) WHEN p_size < 25 THEN p_size || ' Minutes'
                      WHEN p_size < 30 THEN p_size || ' day' ELSE p_name END AS value FROM part)""")
def config_typed(p: Plant) -> DataFrame:
    """Parts as config rows: some values are numbers, some intervals, some names."""
    size = F.col("p_size").cast("string")
    value = (
        F.when(F.col("p_size") < 15, size).when(F.col("p_size") < 25, F.concat(size, F.lit(" Minutes")))
        .when(F.col("p_size") < 30, F.concat(size, F.lit(" day"))).otherwise(F.col("p_name"))
    )
    key = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    return config_columns(p.base("part").select(key.alias("key"), value.alias("value")))


@query("column_defaults", """
    SELECT CAST(point_id AS VARCHAR) AS device_id, name, CASE WHEN rollup_uom IS NULL THEN 'active' ELSE 'disabled' END AS status,
           false AS is_controllable, TIMESTAMP '2024-01-01' AS updated_at FROM points""")
def defaults(p: Plant) -> DataFrame:
    """Columns a writer left out, or left NULL, get the column default."""
    status = F.when(F.col("rollup_uom").isNotNull(), "disabled")
    rows = p.points.select(F.col("point_id").alias("device_id"), "name", status.alias("status"))
    filled = with_defaults(rows, "devices", dt.datetime(2024, 1, 1))
    return filled.select("device_id", "name", "status", "is_controllable", "updated_at")
