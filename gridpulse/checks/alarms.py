"""Outages, meters, alarms and configured rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.registry import query
from gridpulse.checks.views import r
from gridpulse.functions.buckets import bucket_of, instant
from gridpulse.functions.scalars import round_half_away
from gridpulse.functions.values import any_value_of, decode_bits, range_quality, translate
from gridpulse.operators import alarms as al
from gridpulse.operators.meter import derived_sum, site_meter
from gridpulse.operators.outages import apply_markers, data_gaps, outage_markers, silence
from gridpulse.operators.rollups import rollup_1h
from gridpulse.session import run_dir
from gridpulse.sources.adapters import Plant
from gridpulse.streaming.rules import read_rule_events, start_rules
from gridpulse.streaming.sources import files_per_batch, parquet_stream, write_batch


def definitions(p: Plant) -> DataFrame:
    """Three alarm definitions per site."""
    kinds = F.explode(
        F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(name).alias("name"), F.lit(severity).alias("severity"))
            for k, name, severity in (
                (1, al.COMMS_LOST, "high"), (2, al.OVER_TEMPERATURE, "medium"), (3, al.STORM, "information"),
            )
        ])
    )
    return p.sites.select("site_id", kinds.alias("d")).select(
        (F.col("site_id") * 10 + F.col("d.k")).alias("alarm_definition_id"), "site_id", "d.name", "d.severity"
    )


def devices(p: Plant) -> DataFrame:
    """Every point is its own device."""
    return p.points.select(F.col("point_id").alias("device_id"), "site_id", "name")


def own_points(p: Plant) -> DataFrame:
    return p.points.select(F.col("point_id").alias("device_id"), "point_id")


def power_points(p: Plant) -> DataFrame:
    """Points that measure power or energy; other devices have none."""
    return own_points(p).join(p.points.filter(F.col("rollup_uom").isNotNull()), "point_id", "left_semi")


def comms_lost(p: Plant) -> DataFrame:
    return al.comms_lost(p.outages, devices(p), definitions(p), power_points(p), p.now)


def crossings(p: Plant) -> DataFrame:
    """Of the points that measure a temperature."""
    return al.threshold_crossings(p.readings, points=p.points.filter(F.col("uom") == "degC"))


def over_temperature(p: Plant) -> DataFrame:
    return al.over_temperature(crossings(p), p.points, devices(p), own_points(p), definitions(p))


def storms(p: Plant) -> DataFrame:
    factors = p.day_factors.withColumnRenamed("utc_day", "local_day")
    return al.storm_advisories(factors, p.sites, definitions(p), p.now)


def all_alarms(p: Plant) -> DataFrame:
    a, b, c = comms_lost(p), over_temperature(p), storms(p)
    same = {k: F.col(k).cast("bigint") for k in ("device_id", "point_id")}
    return a.unionByName(b).unionByName(c.withColumns(same))


@query("outage_silence", f"""
    SELECT event_time, point_id, {r('v')} AS v, data_quality FROM valued r
    WHERE NOT EXISTS (SELECT 1 FROM outages o WHERE o.device_id = r.point_id
                      AND r.event_time >= o.start_at AND r.event_time < o.end_at)""")
def outage_silence(p: Plant) -> DataFrame:
    kept = silence(p.readings, p.outages)
    return kept.select("event_time", "point_id", round_half_away(any_value_of(), 4).alias("v"), "data_quality")


def _markers(p: Plant) -> DataFrame:
    own = own_points(p)
    status = own.select("device_id", (-F.col("point_id") - 1).alias("point_id"))
    return outage_markers(p.outages, own, status)


_MARKERS = """
    SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, start_at, TIMESTAMP '2000-01-01') AS event_time,
           CASE k WHEN 1 THEN device_id ELSE -device_id - 1 END AS point_id,
           CASE k WHEN 1 THEN 0.0::DOUBLE END AS value_double, CASE k WHEN 3 THEN 2::BIGINT END AS value_bigint,
           'offline' AS data_quality
    FROM outages JOIN points ON device_id = point_id CROSS JOIN unnest([1, 3]) AS t(k)"""


@query("outage_markers", _MARKERS)
def markers(p: Plant) -> DataFrame:
    return _markers(p)


@query("markers_applied", f"""
    WITH m AS ({_MARKERS})
    SELECT r.event_time, r.point_id, CASE WHEN m.event_time IS NULL THEN r.value_double ELSE m.value_double END AS value_double,
           CASE WHEN m.event_time IS NULL THEN r.value_bigint ELSE m.value_bigint END AS value_bigint,
           coalesce(m.data_quality, r.data_quality) AS data_quality
    FROM readings r LEFT JOIN m ON m.event_time = r.event_time AND m.point_id = r.point_id
    UNION ALL
    SELECT m.event_time, m.point_id, m.value_double, m.value_bigint, m.data_quality
    FROM m WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE m.event_time = r.event_time AND m.point_id = r.point_id)""")
def applied(p: Plant) -> DataFrame:
    out = apply_markers(p.readings, _markers(p))
    return out.select("event_time", "point_id", "value_double", "value_bigint", "data_quality")


@query("meter_sum", f"""
    SELECT time_bucket(INTERVAL 1 HOUR, r.event_time) AS event_time, concat('MTR', p.site_id) AS point_id,
           {r('sum(r.v) * 0.985', 1)} AS value_double, 'online' AS data_quality
    FROM valued r JOIN points p ON p.point_id = r.point_id GROUP BY 1, 2""")
def meter_sum(p: Plant) -> DataFrame:
    """Readings aligned to the hour, so that a site's points share instants."""
    aligned = p.readings.withColumn("event_time", bucket_of(F.col("event_time"), "1 hour"))
    meters = p.sites.select("site_id", F.concat(F.lit("MTR"), F.col("site_id").cast("string")).alias("point_id"))
    return site_meter(aligned, p.points, meters)


@query("derived_sum", f"""
    WITH src AS (SELECT point_id, day, last_value AS v FROM days),
    n AS (SELECT site_id, count(*) AS wanted FROM points GROUP BY 1)
    SELECT p.site_id AS point_id, s.day AS event_time, {r('sum(s.v)')} AS value, count(s.v) AS n_sources
    FROM src s JOIN points p ON p.point_id = s.point_id JOIN n ON n.site_id = p.site_id
    GROUP BY p.site_id, s.day, n.wanted HAVING p.site_id % 2 = 0 OR count(s.v) >= n.wanted""")
def derived(p: Plant) -> DataFrame:
    """A site total from each day's last values; odd sites require every source."""
    from gridpulse.operators.rollups import rollup_1d

    daily = rollup_1d(rollup_1h(p.readings)).select(
        F.col("bucket").alias("event_time"), "point_id", F.col("last_value").alias("value_double"),
        F.lit(None).cast("bigint").alias("value_bigint"), F.lit(None).cast("decimal(38,9)").alias("value_numeric"),
    )
    rules = p.sites.select(F.col("site_id").alias("point_id"), (F.col("site_id") % 2 == 1).alias("require_all_sources"))
    sources = p.points.select(F.col("site_id").alias("point_id"), F.col("point_id").alias("source_point_id"))
    out = derived_sum(daily, rules, sources)
    return out.withColumn("value", round_half_away("value", 4))


@query("data_gaps", """
    SELECT point_id, event_time AS gap_start, nxt AS gap_end
    FROM (SELECT point_id, event_time, lead(event_time) OVER (PARTITION BY point_id ORDER BY event_time) AS nxt
          FROM readings), span
    WHERE coalesce(nxt, hi) > event_time + INTERVAL 300 SECOND""")
def gaps(p: Plant) -> DataFrame:
    return data_gaps(p.readings, 300, p.span[1])


@query("over_threshold_first_cross", "SELECT point_id, day, first_cross, peak FROM crossings")
def first_cross(p: Plant) -> DataFrame:
    return crossings(p)


_ALARM_COLUMNS = (
    "alarm_definition_id, site_id, alarm_name, source, device_id, point_id, severity, is_active, message, "
    "raised_at, cleared_at, acknowledged_at, updated_at"
)


def _alarm_sql(name: str) -> str:
    return f"SELECT {_ALARM_COLUMNS} FROM alarms WHERE alarm_name = '{name}'"


@query("comms_lost", _alarm_sql(al.COMMS_LOST))
def comms(p: Plant) -> DataFrame:
    return comms_lost(p).select(*_ALARM_COLUMNS.split(", "))


@query("over_temperature", _alarm_sql(al.OVER_TEMPERATURE))
def overheated(p: Plant) -> DataFrame:
    return over_temperature(p).select(*_ALARM_COLUMNS.split(", "))


@query("storm_advisory", f"SELECT {_ALARM_COLUMNS.replace('source, device_id, point_id, ', '')} FROM alarms "
       f"WHERE alarm_name = '{al.STORM}'")
def storm_advisory(p: Plant) -> DataFrame:
    return storms(p).select(*_ALARM_COLUMNS.replace("source, device_id, point_id, ", "").split(", "))


@query("alarm_events", """
    SELECT site_id, alarm_definition_id, raised_at AS event_time, coalesce(message, alarm_name) AS message,
           'raise' AS event_condition, point_id, raised_at AS created_at FROM alarms
    UNION ALL
    SELECT site_id, alarm_definition_id, cleared_at, 'Condition cleared', 'clear', point_id, cleared_at
    FROM alarms WHERE cleared_at IS NOT NULL""")
def events(p: Plant) -> DataFrame:
    return al.alarm_events(all_alarms(p)).drop("alarm_event_id", "alarm_history_id")


# -- configured rules: one definition per point ------------------------------


def _rules(p: Plant, hits: int, seconds: int, match: str = "any", from_s: int | None = None) -> DataFrame:
    fixed = {
        "raise_occurrence_limit": F.lit(hits), "raise_timeframe_s": F.lit(seconds),
        "clear_occurrence_limit": F.lit(1), "clear_timeframe_s": F.lit(0),
        "raise_window_start_s": F.lit(from_s).cast("int"), "clear_window_start_s": F.lit(None).cast("int"),
        "raise_match_operator": F.lit(match), "clear_match_operator": F.lit("any"),
    }
    return p.points.select(F.col("point_id").alias("alarm_definition_id"), "site_id").withColumns(fixed)


def _expressions(p: Plant, conditions: list[tuple]) -> DataFrame:
    """(role, operator, value[, group, group operator[, bit]]) for every point."""
    rows = F.explode(
        F.array(*[
            F.struct(
                F.lit(i).alias("expression_id"), F.lit(role).alias("role"), F.lit(op).alias("comparison_operator"),
                F.lit(value).cast("decimal(38,9)").alias("point_value"),
                F.lit(more[0] if more else 1).alias("group_number"), F.lit(more[1] if more else "any").alias("group_operator"),
                F.lit(more[2] if len(more) > 2 else None).cast("int").alias("bit_position"),
            )
            for i, (role, op, value, *more) in enumerate(conditions)
        ])
    ).alias("x")
    return p.points.select(F.col("point_id").alias("alarm_definition_id"), "point_id", rows).select(
        "alarm_definition_id", "point_id", "x.*"
    )


def _valued(p: Plant) -> DataFrame:
    raw = p.readings.filter(F.col("reading_type") == "raw")
    return raw.select("event_time", "point_id", any_value_of().alias("value"))


@query("rule_raise_clear", """
    WITH said AS (
        SELECT point_id, event_time, CASE WHEN v > 75 THEN 1 WHEN v <= 65 THEN 0 END AS want
        FROM valued JOIN points USING (point_id) WHERE reading_type = 'raw'),
    state AS (
        SELECT point_id, event_time, coalesce(last_value(want IGNORE NULLS) OVER w, 0) AS after,
               coalesce(last_value(want IGNORE NULLS) OVER b, 0) AS before
        FROM said WINDOW w AS (PARTITION BY point_id ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             b AS (PARTITION BY point_id ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT point_id AS alarm_definition_id, event_time, CASE after WHEN 1 THEN 'raise' ELSE 'clear' END AS event_condition
    FROM state WHERE after <> before""")
def rule_raise_clear(p: Plant) -> DataFrame:
    """Raise above 75, clear at 65 or below."""
    return al.evaluate_rules(_valued(p), _rules(p, 1, 0), _expressions(p, [("raise", ">", 75.0), ("clear", "<=", 65.0)]))


def _while_holding(condition: str, source: str = "valued JOIN points USING (point_id)") -> str:
    """SQL of a rule whose hits last until the next reading and that has no clear side."""
    return f"""
    WITH said AS (SELECT point_id, event_time, {condition} AS hold FROM {source} WHERE reading_type = 'raw'),
    steps AS (SELECT *, lag(hold, 1, false) OVER (PARTITION BY point_id ORDER BY event_time) AS held FROM said)
    SELECT point_id AS alarm_definition_id, event_time, CASE WHEN hold THEN 'raise' ELSE 'clear' END AS event_condition
    FROM steps WHERE hold <> held"""


@query("rule_all_of_a_group", _while_holding("(v > 40 AND v < 60) OR v > 90"))
def rule_all(p: Plant) -> DataFrame:
    """Two expressions that must hold together, or a third one."""
    conditions = [("raise", ">", 40.0, 1, "all"), ("raise", "<", 60.0, 1, "all"), ("raise", ">", 90.0, 2, "any")]
    return al.evaluate_rules(_valued(p), _rules(p, 1, 0), _expressions(p, conditions))


@query("rule_all_groups", _while_holding("(v > 70 OR v < 30) AND (v > 80 OR v < 20)"))
def rule_all_groups(p: Plant) -> DataFrame:
    """Two groups that must both hold."""
    conditions = [("raise", ">", 70.0, 1, "any"), ("raise", "<", 30.0, 1, "any"), ("raise", ">", 80.0, 2, "any"), ("raise", "<", 20.0, 2, "any")]
    return al.evaluate_rules(_valued(p), _rules(p, 1, 0, "all"), _expressions(p, conditions))


@query("rule_bit", _while_holding("(CAST(floor(v) AS BIGINT) >> 3) & 1 = 1"))
def rule_bit(p: Plant) -> DataFrame:
    """A single bit of a status word."""
    return al.evaluate_rules(_valued(p), _rules(p, 1, 0), _expressions(p, [("raise", "=", 1.0, 1, "any", 3)]))


@query("rule_time_gate", _while_holding(
    "v > 50 AND hour((event_time AT TIME ZONE 'UTC') AT TIME ZONE timezone) >= 8",
    "valued JOIN points USING (point_id) JOIN sites USING (site_id)",
))
def rule_gate(p: Plant) -> DataFrame:
    """Hits count from 8 o'clock on the site's clock."""
    return al.evaluate_rules(_valued(p), _rules(p, 1, 0, from_s=8 * 3600), _expressions(p, [("raise", ">", 50.0)]), p.sites)


_DEBOUNCED = """
    WITH steps AS (
        SELECT point_id, moment, sum(d) AS net FROM (
            SELECT point_id, event_time AS moment, 1 AS d FROM valued JOIN points USING (point_id)
            WHERE reading_type = 'raw' AND v > 60
            UNION ALL
            SELECT point_id, event_time + INTERVAL 1 DAY, -1 FROM valued JOIN points USING (point_id)
            WHERE reading_type = 'raw' AND v > 60) GROUP BY 1, 2),
    levels AS (SELECT *, sum(net) OVER (PARTITION BY point_id ORDER BY moment) AS lvl FROM steps)
    SELECT point_id AS alarm_definition_id, moment AS event_time, CASE WHEN lvl >= 2 THEN 'raise' ELSE 'clear' END AS event_condition
    FROM levels WHERE (lvl >= 2) <> (lvl - net >= 2)"""


@query("rule_debounced", _DEBOUNCED)
def rule_debounced(p: Plant) -> DataFrame:
    """Two readings above 60 within a day raise; clears when they are no longer so close."""
    return al.evaluate_rules(_valued(p), _rules(p, 2, 86400), _expressions(p, [("raise", ">", 60.0)]))


@query("stream_rule_debounced", _DEBOUNCED)
def stream_rule_debounced(p: Plant) -> DataFrame:
    """The same rule on a stream whose readings arrive up to two days late, in four micro-batches."""
    late, values = dt.timedelta(days=2), _valued(p)
    folder = run_dir(p.spark, "stream-rules")
    arrival = F.col("event_time") + F.make_dt_interval(F.lit(0), F.pmod(F.xxhash64("event_time", "point_id"), F.lit(48)).cast("int"))
    first, last = values.agg(F.min("event_time"), F.max("event_time")).first()
    step = (last + late - first) / 4 + dt.timedelta(seconds=1)
    parts = [(arrival >= instant(first + i * step)) & (arrival < instant(first + (i + 1) * step)) for i in range(4)]
    files = files_per_batch(list(values.agg(*[F.count_if(part).alias(f"n{i}") for i, part in enumerate(parts)]).first()))
    for part in parts:
        write_batch(values.filter(part), f"{folder}/in", files)
    for after in (1, 2):  # the clock goes on by a point that no rule watches
        tick = [instant(last + 3 * late + dt.timedelta(days=after)), F.lit(-1), F.lit(None)]
        ticks = p.spark.range(0, files, 1, files).select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(tick, values.schema)])
        ticks.write.mode("append").parquet(f"{folder}/in")
    stream = parquet_stream(p.spark, f"{folder}/in", values.schema, max_files_per_trigger=files)
    expressions = _expressions(p, [("raise", ">", 60.0)])
    start_rules(stream, _rules(p, 2, 86400), expressions, f"{folder}/log", f"{folder}/checkpoint", lateness=late, once=True).awaitTermination()
    return read_rule_events(p.spark, f"{folder}/log")


@query("suppressed_alarms", f"""
    SELECT {_ALARM_COLUMNS.replace('acknowledged_at, ', '')} FROM alarms a
    WHERE alarm_name = '{al.COMMS_LOST}' AND NOT EXISTS (
        SELECT 1 FROM alarms l CROSS JOIN span s
        WHERE l.alarm_name = '{al.OVER_TEMPERATURE}' AND l.site_id = a.site_id
          AND a.raised_at >= l.raised_at AND a.raised_at < coalesce(l.cleared_at, s.now_at))""")
def suppressed(p: Plant) -> DataFrame:
    """Communication alarms are held back while a site runs too hot."""
    rules = definitions(p)
    dependent = rules.filter(F.col("name") == al.COMMS_LOST).select(
        F.col("alarm_definition_id").alias("dependent_alarm_definition_id"), "site_id"
    )
    limiter = rules.filter(F.col("name") == al.OVER_TEMPERATURE).select(
        F.col("alarm_definition_id").alias("limited_by_alarm_definition_id"), "site_id"
    )
    kept = al.suppress(comms_lost(p), over_temperature(p), dependent.join(limiter, "site_id").drop("site_id"), p.now)
    return kept.select(*_ALARM_COLUMNS.replace("acknowledged_at, ", "").split(", "))


@query("schedule_runs", """
    WITH s AS (
        SELECT o_custkey AS site_id, o_orderkey AS schedule_id, o_orderdate AS start_at,
               CASE left(o_orderpriority, 1) WHEN '1' THEN INTERVAL 13 WEEK WHEN '2' THEN INTERVAL 120 DAY
                    WHEN '3' THEN INTERVAL 5000 HOUR WHEN '4' THEN INTERVAL 200000 MINUTE END AS step
        FROM orders WHERE o_orderstatus IN ('F', 'O')),
    h AS (SELECT max(o_orderdate) AS horizon FROM orders)
    SELECT site_id, schedule_id, unnest(generate_series(start_at, horizon, step)) AS run_at
    FROM s CROSS JOIN h WHERE step IS NOT NULL
    UNION ALL
    SELECT site_id, schedule_id, start_at FROM s WHERE step IS NULL""")
def schedule_runs(p: Plant) -> DataFrame:
    orders = p.base("orders")
    horizon = orders.agg(F.max("o_orderdate")).first()[0]
    rank = F.left("o_orderpriority", F.lit(1))
    plan = F.create_map(*[
        x for k, n, u in (("1", 13, "weeks"), ("2", 120, "days"), ("3", 5000, "hours"), ("4", 200000, "minutes"),
                          ("5", 0, "days"))
        for x in (F.lit(k), F.struct(F.lit(n).alias("n"), F.lit(u).alias("u")))
    ])
    schedules = orders.select(
        F.col("o_custkey").alias("site_id"),
        F.col("o_orderkey").alias("schedule_id"),
        F.col("o_orderdate").alias("start_at"),
        plan[rank]["n"].alias("repeat_interval"),
        plan[rank]["u"].alias("repeat_units"),
        F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "ready").otherwise("draft").alias("status"),
    )
    return al.expand_schedules(schedules, horizon)


# -- labels and ranges -------------------------------------------------------

#: The labels of one value map; its whole numbers are their places.
LABELS = ("click", "error", "purchase", "signup", "view")
_MAP = """
    WITH map AS (SELECT * FROM (VALUES ('click', 0), ('error', 1), ('purchase', 2), ('signup', 3), ('view', 4)) AS t(label, i))"""


def _with_value_map(rows: DataFrame) -> DataFrame:
    """A value map is configuration, so it travels in the plan."""
    return rows.withColumns({
        "display_values": F.array(*map(F.lit, LABELS)), "int_values": F.array(*map(F.lit, range(len(LABELS)))),
    })


@query("value_translation", f"""{_MAP}
    SELECT event_id, map.label AS label
    FROM events LEFT JOIN map ON map.i = CAST(floor(value) AS BIGINT)""")
def value_translation(p: Plant) -> DataFrame:
    """Whole values looked up in the map; unlisted ones have no label."""
    rows = p.events.select("event_id", F.floor("value").alias("state"))
    return _with_value_map(rows).select(
        "event_id", translate("state", "int_values", "display_values").alias("label")
    )


@query("bitmask_decode", f"""{_MAP}
    SELECT event_id, coalesce(string_agg(map.label, ',' ORDER BY map.i), '') AS labels
    FROM events LEFT JOIN map ON (CAST(floor(value) AS BIGINT) >> CAST(map.i AS BIGINT)) & 1 = 1 GROUP BY event_id""")
def bitmask_decode(p: Plant) -> DataFrame:
    rows = p.events.select("event_id", F.floor("value").alias("state"))
    return _with_value_map(rows).select(
        "event_id", F.concat_ws(",", decode_bits("state", "int_values", "display_values")).alias("labels")
    )


@query("range_check", """
    SELECT r.event_time, r.point_id,
           CASE WHEN r.v > 60 + r.point_id % 60 THEN 'over_range' WHEN r.v < 5 THEN 'under_range'
                ELSE r.data_quality END AS data_quality
    FROM valued r JOIN points p ON p.point_id = r.point_id""")
def range_check(p: Plant) -> DataFrame:
    bounds = p.points.select(
        "point_id",
        F.lit(5).cast("decimal(24,7)").alias("eng_low"),
        (F.col("point_id") % 60 + 60).cast("decimal(24,7)").alias("eng_high"),
    )
    rows = p.readings.withColumn("v", any_value_of()).join(bounds, "point_id")
    return rows.select(
        "event_time", "point_id", range_quality("v", "eng_low", "eng_high", "data_quality").alias("data_quality")
    )
