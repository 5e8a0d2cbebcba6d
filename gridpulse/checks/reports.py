"""Reporting queries, aggregates, windows and top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.checks.alarms import all_alarms
from gridpulse.checks.merges import _queue
from gridpulse.checks.registry import query
from gridpulse.checks.rollups import rounded
from gridpulse.checks.views import r
from gridpulse.functions.buckets import local_day
from gridpulse.functions.scalars import percent, round_half_away, safe_divide
from gridpulse.functions.values import any_value_of, quality_to_aggregate, reading_value
from gridpulse.operators.rollup import power_to_energy, raw_readings
from gridpulse.operators.rollups import rollup_1d, rollup_1h
from gridpulse.plans import reports as rp
from gridpulse.sources.adapters import Plant
from gridpulse.sources.tables import discard, staged, values

_DAY_ENERGY = f"""
    local_energy AS (
        SELECT d.site_id, s.name AS site, CAST(d.b AS DATE) AS local_day, {r('sum(d.a * 24 * u.factor)', 0)} AS kwh
        FROM (SELECT t.point_id, t.site_id, avg(t.v) AS a,
                     date_trunc('day', (t.event_time AT TIME ZONE 'UTC') AT TIME ZONE s.timezone)::TIMESTAMP AS b
              FROM typed t JOIN sites s ON s.site_id = t.site_id GROUP BY t.point_id, t.site_id, b) d
        JOIN units u ON u.point_id = d.point_id JOIN sites s ON s.site_id = d.site_id
        GROUP BY d.site_id, s.name, d.b)"""


def _energy(p: Plant) -> DataFrame:
    return rp.daily_energy(p.readings, p.points, p.sites, *p.span)


@query("daily_energy", f"WITH {_DAY_ENERGY} SELECT * FROM local_energy")
def daily_energy(p: Plant) -> DataFrame:
    return _energy(p)


@query("weather_and_energy", f"""
    WITH {_DAY_ENERGY}
    SELECT e.site, e.local_day, w.factor, CASE WHEN w.factor < 0.40 THEN '** storm **' ELSE '' END AS note, e.kwh
    FROM local_energy e JOIN day_factors w ON w.site_id = e.site_id AND w.utc_day = e.local_day""")
def weather_and_energy(p: Plant) -> DataFrame:
    return rp.weather_and_energy(_energy(p), p.day_factors.withColumnRenamed("utc_day", "local_day"))


_CURVE = f"""
    seen AS (
        SELECT point_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS b, arg_max_null(v, event_time) AS v,
               arg_max_null(q, event_time) AS q
        FROM typed, span WHERE event_time >= hi - INTERVAL 1 DAY GROUP BY 1, 2),
    grid AS (
        SELECT i.point_id, unnest(generate_series(s.hi - INTERVAL 1 DAY, s.hi - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS b
        FROM (SELECT DISTINCT point_id FROM seen) i CROSS JOIN span s),
    curve AS (
        SELECT g.b AS bucket_time, g.point_id, {r('last_value(seen.v IGNORE NULLS) OVER w', 1)} AS kw,
               last_value(seen.q IGNORE NULLS) OVER w AS data_quality, seen.point_id IS NULL AS is_generated
        FROM grid g LEFT JOIN seen ON seen.point_id = g.point_id AND seen.b = g.b
        WINDOW w AS (PARTITION BY g.point_id ORDER BY g.b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("power_curve", f"WITH {_CURVE} SELECT * FROM curve")
def power_curve(p: Plant) -> DataFrame:
    """The last day's 15-minute curve of every point."""
    end = p.span[1]
    return rp.power_curve(p.readings, p.points, end - dt.timedelta(days=1), end)


@query("alarm_board", """
    SELECT alarm_name, source AS device, severity, is_active, raised_at, cleared_at,
           acknowledged_at IS NOT NULL AS acked, left(message, 60) AS message
    FROM alarms ORDER BY is_active DESC, raised_at DESC LIMIT 25""")
def alarm_board(p: Plant) -> DataFrame:
    return rp.alarm_board(all_alarms(p))


@query("open_requests", """
    SELECT o.o_orderdate AS created_at, q.control_request_id, q.status, 'dispatch' AS source, s.s_name AS device,
           q.setpoint AS setpoint_kw, left('Setpoint ' || o.o_orderpriority, 40) AS description
    FROM queue q JOIN orders o ON o.o_orderkey = q.control_request_id LEFT JOIN supplier s ON s.s_suppkey = q.device_id
    WHERE q.status IN ('queued', 'accepted', 'scheduled', 'active')
    ORDER BY o.o_orderdate DESC, q.control_request_id DESC LIMIT 20""")
def open_requests(p: Plant) -> DataFrame:
    """Newest requests in flight; the order gives the creation time."""
    orders = p.base("orders").select(
        F.col("o_orderkey").alias("control_request_id"),
        F.col("o_orderdate").alias("created_at"),
        F.concat(F.lit("Setpoint "), "o_orderpriority").alias("description"),
    )
    queue = _queue(p).join(orders, "control_request_id").withColumns(
        {"value": F.array("setpoint"), "source": F.lit("dispatch")}
    )
    devices = p.base("supplier").select(F.col("s_suppkey").alias("device_id"), F.col("s_name").alias("name"))
    return rp.open_requests(queue, devices).withColumn("setpoint_kw", F.col("setpoint_kw").cast("double"))


@query("control_audit_trail", """
    WITH pick AS (
        SELECT control_request_id FROM control_log GROUP BY 1 HAVING count(*) >= 4
        ORDER BY max(updated_at) DESC, control_request_id DESC LIMIT 1)
    SELECT control_request_id, updated_at, status, setpoint AS setpoint_kw, is_internal
    FROM control_log JOIN pick USING (control_request_id)""")
def audit_trail(p: Plant) -> DataFrame:
    trail = rp.audit_trail(p.control_log)
    return trail.select(
        "control_request_id", "updated_at", "status", F.col("setpoint").cast("double").alias("setpoint_kw"), "is_internal"
    )


@query("hourly_averages", f"""
    SELECT time_bucket(INTERVAL 1 HOUR, t.event_time) AS bucket_start, t.point_id, p.name, {r('avg(t.v)', 1)} AS avg_value
    FROM typed t JOIN points p ON p.point_id = t.point_id
    WHERE t.point_id IN (SELECT point_id FROM points WHERE uom IN ('kW', 'MW')) GROUP BY 1, 2, 3""")
def hourly_averages(p: Plant) -> DataFrame:
    """Points measured in kW or MW."""
    return rp.hourly_averages(p.readings, p.points.filter(F.col("uom").isin("kW", "MW")), None, None)


@query("quality_sweep", """
    SELECT data_quality, count(*) AS readings, min(event_time) AS first_seen, max(event_time) AS last_seen
    FROM readings WHERE data_quality <> 'online' GROUP BY 1""")
def quality_sweep(p: Plant) -> DataFrame:
    return rp.quality_sweep(p.readings).orderBy(F.col("readings").desc())


@query("point_day_stats", f"""
    SELECT point_id, time_bucket(INTERVAL 1 DAY, event_time) AS day, count(*) AS n, {r('avg(v)')} AS avg_value
    FROM valued WHERE reading_type = 'raw' GROUP BY 1, 2""")
def point_day_stats(p: Plant) -> DataFrame:
    return rounded(rp.point_day_stats(p.readings), "avg_value")


@query("count_over_threshold", "SELECT count(*) AS n FROM valued WHERE reading_type = 'raw' AND v > 78")
def count_over_threshold(p: Plant) -> DataFrame:
    return rp.count_over(p.readings, 78.0)


_REPORT = f"{r('avg_value')} AS avg_value, {r('max_value')} AS max_value"


@query("daily_report_raw", f"""
    SELECT day, point_id, {_REPORT} FROM (
        SELECT time_bucket(INTERVAL 1 DAY, event_time) AS day, point_id, avg(v) AS avg_value, max(v) AS max_value
        FROM valued WHERE reading_type = 'raw' GROUP BY 1, 2)""")
def daily_report_raw(p: Plant) -> DataFrame:
    return rounded(rp.daily_report_raw(p.readings), "avg_value", "max_value")


@query("daily_report_rollup", f"SELECT day, point_id, {_REPORT} FROM days")
def daily_report_rollup(p: Plant) -> DataFrame:
    return rounded(rp.daily_report_rollup(rollup_1d(rollup_1h(p.readings))), "avg_value", "max_value")


@query("hourly_report_rollup", f"SELECT bucket, point_id, {_REPORT} FROM hours")
def hourly_report_rollup(p: Plant) -> DataFrame:
    return rounded(rp.hourly_report_rollup(rollup_1h(p.readings)), "avg_value", "max_value")


@query("raw_vs_rollup", f"""
    SELECT d.day, d.point_id, {r('x.a', 2)} AS raw_avg, {r('d.avg_value', 2)} AS rollup_avg
    FROM days d JOIN (SELECT time_bucket(INTERVAL 1 DAY, event_time) AS day, point_id, avg(v) AS a
                      FROM valued WHERE reading_type = 'raw' GROUP BY 1, 2) x
      ON x.day = d.day AND x.point_id = d.point_id""")
def raw_vs_rollup(p: Plant) -> DataFrame:
    return rp.raw_vs_rollup(rp.daily_report_raw(p.readings), rollup_1d(rollup_1h(p.readings)))


@query("downsampling_span", """
    SELECT 'readings' AS source, min(event_time) AS earliest, max(event_time) AS latest FROM readings
    UNION ALL SELECT 'daily rollup', min(day), max(day) FROM days""")
def downsampling_span(p: Plant) -> DataFrame:
    return rp.time_spans({
        "readings": (p.readings, "event_time"), "daily rollup": (rollup_1d(rollup_1h(p.readings)), "bucket"),
    })


@query("aged_out_rows", """
    SELECT 'readings' AS source, count(*) AS rows_available FROM readings, span
    WHERE event_time BETWEEN hi - INTERVAL 12 DAY AND hi - INTERVAL 5 DAY
    UNION ALL SELECT 'daily rollup', count(*) FROM days, span WHERE day BETWEEN hi - INTERVAL 12 DAY AND hi - INTERVAL 5 DAY""")
def aged_out_rows(p: Plant) -> DataFrame:
    """Rows in a closed range between 12 and 5 days ago, per table."""
    end = p.span[1]
    named = {"readings": (p.readings, "event_time"), "daily rollup": (rollup_1d(rollup_1h(p.readings)), "bucket")}
    return rp.rows_available(named, end - dt.timedelta(days=12), end - dt.timedelta(days=5))


_COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query("row_counts", "\n UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COUNTED))
def row_counts(p: Plant) -> DataFrame:
    return rp.row_counts({t: p.base(t) for t in _COUNTED})


@query("share_by_quality", """
    SELECT data_quality, n, round(100.0 * n / sum(n) OVER (), 2)::DOUBLE AS percent
    FROM (SELECT data_quality, count(*) AS n FROM readings GROUP BY 1)""")
def share_by_quality(p: Plant) -> DataFrame:
    return rp.share_of_total(p.readings.groupBy("data_quality").agg(F.count(F.lit(1)).alias("n")), "n")


@query("topk_points", f"""
    SELECT CAST(row_number() OVER (ORDER BY kwh DESC NULLS LAST, point_id) AS INTEGER) AS rank, point_id, kwh
    FROM (SELECT d.point_id, {r('sum(d.avg_value * 24 * u.factor)', 3)} AS kwh
          FROM days d JOIN units u ON u.point_id = d.point_id GROUP BY 1)
    QUALIFY rank <= 50""")
def topk_points(p: Plant) -> DataFrame:
    """The 50 points with the most energy."""
    energy = power_to_energy(p.readings, p.points, bucket="1 day")
    totals = energy.groupBy("point_id").agg(round_half_away(F.sum("energy"), 3).alias("kwh"))
    return rp.top_points(totals, "kwh", 50)


@query("busy_points", """
    SELECT point_id, count(*) AS n, count(DISTINCT data_quality) AS qualities,
           min(event_time) AS first_seen, max(event_time) AS last_seen
    FROM readings GROUP BY 1 HAVING count(*) >= 10""")
def busy_points(p: Plant) -> DataFrame:
    grouped = p.readings.groupBy("point_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("data_quality").alias("qualities"),
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"),
    )
    return grouped.filter(F.col("n") >= 10)


@query("conditional_counts", """
    SELECT p.site_id, count(*) AS n, count(*) FILTER (WHERE data_quality = 'online') AS online,
           CAST(sum(CASE WHEN reading_type = 'heartbeat' THEN 1 ELSE 0 END) AS BIGINT) AS heartbeats,
           round(100.0 * count(*) FILTER (WHERE data_quality = 'online') / nullif(count(*), 0), 1)::DOUBLE AS pct_online
    FROM readings r JOIN points p ON p.point_id = r.point_id GROUP BY 1""")
def conditional_counts(p: Plant) -> DataFrame:
    """Counted per point before the join, so the catalog meets a small table."""
    per_point = p.readings.groupBy("point_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("data_quality") == "online").alias("online"),
        F.sum(F.when(F.col("reading_type") == "heartbeat", 1).otherwise(0)).alias("heartbeats"),
    )
    online, total = F.sum("online"), F.sum("n")
    return per_point.join(p.points.select("point_id", "site_id"), "point_id").groupBy("site_id").agg(
        total.alias("n"), online.alias("online"), F.sum("heartbeats").alias("heartbeats"),
        percent(online, total).alias("pct_online"),
    )


@query("quality_lists", """
    SELECT point_id, string_agg(data_quality, ', ' ORDER BY data_quality) AS qualities,
           string_agg(data_quality, ', ' ORDER BY data_quality) FILTER (WHERE data_quality <> 'online') AS bad_qualities,
           string_agg(data_quality, '|' ORDER BY data_quality DESC) AS gathered
    FROM (SELECT DISTINCT point_id, data_quality FROM readings) GROUP BY 1""")
def quality_lists(p: Plant) -> DataFrame:
    """Ordered text lists. Distinct first: a list then has at most one entry per quality."""
    seen = p.readings.select("point_id", "data_quality").distinct()
    return seen.groupBy("point_id").agg(
        F.expr("listagg(data_quality, ', ') WITHIN GROUP (ORDER BY data_quality)").alias("qualities"),
        F.expr("listagg(data_quality, ', ') WITHIN GROUP (ORDER BY data_quality) FILTER (WHERE data_quality <> 'online')").alias("bad_qualities"),
        F.array_join(F.sort_array(F.collect_list("data_quality"), asc=False), "|").alias("gathered"),
    )


@query("plain_limit", """
    SELECT least(count(*), 100) AS n, 0::BIGINT AS strangers FROM readings""")
def plain_limit(p: Plant) -> DataFrame:
    """Any 100 readings; which ones is not defined, but none of them is not a reading."""
    some = p.readings.limit(100).select("event_time", "point_id")
    known = p.readings.select("event_time", "point_id").distinct().withColumn("_known", F.lit(True))
    found = some.join(known, ["event_time", "point_id"], "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_known").isNull()).alias("strangers"))


@query("discarded_rollup", f"""
    SELECT count(*) AS n_rows, sum(n) AS n_samples, {r('max(max_value)')} AS top FROM hours""")
def discarded_rollup(p: Plant) -> DataFrame:
    """The hourly rollup run into the discard sink, and what was observed of its rows there."""
    seen = discard(
        rollup_1h(p.readings), F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_samples"), F.max("max_value").alias("top")
    )
    return rounded(values(p.spark, "n_rows bigint, n_samples bigint, top double", [tuple(seen[c] for c in ("n_rows", "n_samples", "top"))]), "top")


@query("inline_values", """
    SELECT event_type, label, count(*) AS n
    FROM events JOIN (VALUES ('view', 'seen'), ('click', 'used'), ('error', 'broken')) AS t(event_type, label) USING (event_type)
    GROUP BY 1, 2""")
def inline_values(p: Plant) -> DataFrame:
    """A few literal rows as a source."""
    labels = values(p.spark, "event_type string, label string", [("view", "seen"), ("click", "used"), ("error", "broken")])
    return p.events.join(labels, "event_type").groupBy("event_type", "label").agg(F.count(F.lit(1)).alias("n"))


@query("global_stats", f"""
    SELECT count(*) AS n, {r('avg(v)')} AS avg_value, {r('min(v)')} AS lo, {r('max(v)')} AS hi, count(v) AS filled FROM valued""")
def global_stats(p: Plant) -> DataFrame:
    rows = p.readings.select(any_value_of().alias("v"))
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("avg_value"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.count("v").alias("filled"),
    )
    return rounded(stats, "avg_value", "lo", "hi")


@query("first_point_stats", f"""
    SELECT point_id, count(*) AS n, {r('avg(v)')} AS avg_value FROM valued
    WHERE reading_type = 'raw' AND point_id = (SELECT point_id FROM points ORDER BY name, point_id LIMIT 1) GROUP BY 1""")
def first_point_stats(p: Plant) -> DataFrame:
    """Statistics of the point whose name sorts first (a scalar subquery as key)."""
    key = rp.first_point(p.points).scalar()
    rows = raw_readings(p.readings).filter(F.col("point_id") == key).withColumn("v", any_value_of())
    return rounded(rows.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("avg_value")), "avg_value")


@query("exact_average", f"""
    SELECT site_id, {r('sum(sum_value) / nullif(sum(n), 0)')} AS avg_value, CAST(sum(n) AS BIGINT) AS n
    FROM days JOIN points USING (point_id) GROUP BY 1""")
def exact_average(p: Plant) -> DataFrame:
    """A site's average from stored sums and counts, never from averages."""
    daily = rollup_1d(rollup_1h(p.readings)).join(p.points.select("point_id", "site_id"), "point_id")
    stats = daily.groupBy("site_id").agg(
        safe_divide(F.sum("sum_value"), F.sum("n")).alias("avg_value"), F.sum("n").alias("n")
    )
    return rounded(stats, "avg_value")


@query("points_without_readings", """
    SELECT p.point_id, p.name FROM points p WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.point_id = p.point_id)""")
def silent_points(p: Plant) -> DataFrame:
    """Anti join; readings are reduced to their distinct points first."""
    seen = p.readings.select("point_id").distinct()
    return p.points.join(seen, "point_id", "left_anti").select("point_id", "name")


@query("star_join", f"""
    SELECT s.timezone, s.name AS site, p.uom, CASE WHEN r.data_quality IN ('online', 'estimated') THEN r.data_quality ELSE 'offline' END AS quality,
           count(*) AS n, {r('sum(r.v)', 2)} AS total
    FROM valued r JOIN points p ON p.point_id = r.point_id JOIN sites s ON s.site_id = p.site_id GROUP BY 1, 2, 3, 4""")
def star_join(p: Plant) -> DataFrame:
    """Readings with point and site. Counted per point and quality before the
    joins, so the dimensions meet a small table."""
    per_point = p.readings.withColumn("v", any_value_of()).groupBy(
        "point_id", quality_to_aggregate().alias("quality")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    catalog = p.points.select("point_id", "site_id", "uom")
    sites = p.sites.select("site_id", F.col("name").alias("site"), "timezone")
    summed = per_point.join(catalog, "point_id").join(sites, "site_id").groupBy("timezone", "site", "uom", "quality").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    return rounded(summed, "total", digits=2)


@query("active_alarms", """
    SELECT alarm_name, site_id, severity, raised_at FROM alarms WHERE is_active""")
def active_alarms(p: Plant) -> DataFrame:
    """A boolean column as the predicate."""
    return all_alarms(p).filter("is_active").select("alarm_name", "site_id", "severity", "raised_at")


@query("topk_by_larger_count", """
    SELECT point_id, online, other FROM (
        SELECT point_id, count(*) FILTER (WHERE data_quality = 'online') AS online,
               count(*) FILTER (WHERE data_quality <> 'online') AS other
        FROM readings GROUP BY 1)
    ORDER BY greatest(online, other) DESC, point_id LIMIT 25""")
def topk_by_larger_count(p: Plant) -> DataFrame:
    """Ordered by the larger of two computed columns."""
    online = F.col("data_quality") == "online"
    counts = p.readings.groupBy("point_id").agg(F.count_if(online).alias("online"), F.count_if(~online).alias("other"))
    return counts.orderBy(F.greatest("online", "other").desc(), "point_id").limit(25)


@query("staged_grid", f"""
    SELECT site_id, local_day, count(*) AS n, {r('avg(v)')} AS avg_value
    FROM (SELECT t.site_id, t.v, CAST((t.event_time AT TIME ZONE 'UTC') AT TIME ZONE s.timezone AS DATE) AS local_day
          FROM typed t JOIN sites s ON s.site_id = t.site_id)
    GROUP BY 1, 2""")
def staged_grid(p: Plant) -> DataFrame:
    """An intermediate table staged once, then read by SQL."""
    located = p.points.join(p.sites.select("site_id", "timezone"), "site_id").select(
        "point_id", "site_id", "timezone", "value_type"
    )
    rows = raw_readings(p.readings).join(located, "point_id")
    day = local_day(F.col("event_time"), F.col("timezone"))
    grid = staged(rows.select("site_id", day.alias("local_day"), reading_value().alias("v")), "staged_grid")
    stats = p.spark.sql("SELECT site_id, local_day, count(*) AS n, avg(v) AS avg_value FROM {g} GROUP BY ALL", g=grid)
    return rounded(stats, "avg_value")
