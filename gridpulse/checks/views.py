"""The model views of `sources/adapters.py` in SQL, as common table expressions."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "sites": """
        SELECT n_nationkey AS site_id, n_name AS name,
               CASE n_regionkey WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'Asia/Kolkata'
                    WHEN 3 THEN 'America/Phoenix' ELSE 'America/Denver' END AS timezone
        FROM nation""",
    "points": """
        SELECT c_custkey AS point_id, c_nationkey AS site_id, c_name AS name,
               CASE c_custkey % 3 WHEN 0 THEN 'int64' WHEN 1 THEN 'float64' ELSE 'numeric' END AS value_type,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'W' WHEN 'BUILDING' THEN 'kW' WHEN 'MACHINERY' THEN 'MW'
                    WHEN 'HOUSEHOLD' THEN 'Wh' ELSE 'degC' END AS uom,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'kWh' END AS rollup_uom
        FROM customer""",
    "readings": """
        SELECT ts AS event_time, user_id AS point_id,
               CASE WHEN event_id % 20 = 0 THEN 'heartbeat' ELSE 'raw' END AS reading_type,
               CASE WHEN user_id % 3 = 0 THEN CAST(floor(value) AS BIGINT) END AS value_bigint,
               CASE WHEN user_id % 3 = 1 THEN value END AS value_double,
               CASE WHEN user_id % 3 = 2 THEN CAST(value AS DECIMAL(38,9)) END AS value_numeric,
               CASE event_type WHEN 'view' THEN 'online' WHEN 'click' THEN 'online' WHEN 'purchase' THEN 'estimated'
                    WHEN 'signup' THEN 'over_range' ELSE 'offline' END AS data_quality
        FROM events""",
    "valued": """
        SELECT event_time, point_id, reading_type, data_quality,
               CASE WHEN value_double IS NOT NULL THEN value_double
                    WHEN value_bigint IS NOT NULL THEN CAST(value_bigint AS DOUBLE)
                    ELSE CAST(value_numeric AS DOUBLE) END AS v
        FROM readings""",
    "typed": """
        SELECT r.event_time, r.point_id, p.site_id, p.uom, p.rollup_uom,
               CASE p.value_type WHEN 'int64' THEN CAST(r.value_bigint AS DOUBLE) WHEN 'float64' THEN r.value_double
                    WHEN 'numeric' THEN CAST(r.value_numeric AS DOUBLE) END AS v,
               CASE WHEN r.data_quality IN ('online', 'estimated') THEN r.data_quality ELSE 'offline' END AS q
        FROM readings r JOIN points p ON p.point_id = r.point_id
        WHERE r.reading_type = 'raw'""",
    "span": """
        SELECT date_trunc('day', min(event_time))::TIMESTAMP AS lo,
               date_trunc('day', max(event_time))::TIMESTAMP + INTERVAL 1 DAY AS hi,
               date_trunc('day', max(event_time))::TIMESTAMP + INTERVAL 12 HOUR AS now_at
        FROM readings""",
    "units": """
        SELECT point_id, uom, rollup_uom,
               CASE WHEN rollup_uom <> 'kWh' OR rollup_uom IS NULL THEN 1.0::DOUBLE
                    WHEN uom IN ('W', 'Wh') THEN 0.001::DOUBLE WHEN uom = 'MW' THEN 1000.0::DOUBLE
                    ELSE 1.0::DOUBLE END AS factor
        FROM points""",
    "hours": """
        SELECT point_id, time_bucket(INTERVAL 1 HOUR, event_time) AS bucket, count(*) AS n, sum(v) AS sum_value,
               avg(v) AS avg_value, min(v) AS min_value, max(v) AS max_value,
               arg_min_null(v, event_time) AS first_value, arg_max_null(v, event_time) AS last_value,
               CAST(sum(CASE WHEN data_quality <> 'online' THEN 1 ELSE 0 END) AS BIGINT) AS not_online_n
        FROM valued WHERE reading_type = 'raw' GROUP BY 1, 2""",
    "days": """
        SELECT point_id, time_bucket(INTERVAL 1 DAY, bucket) AS day, CAST(sum(n) AS BIGINT) AS n,
               sum(sum_value) AS sum_value, sum(sum_value) / nullif(sum(n), 0) AS avg_value,
               min(min_value) AS min_value, max(max_value) AS max_value,
               arg_min_null(first_value, bucket) AS first_value, arg_max_null(last_value, bucket) AS last_value,
               CAST(sum(not_online_n) AS BIGINT) AS not_online_n
        FROM hours GROUP BY 1, 2""",
    "control_log": """
        SELECT l_orderkey AS control_request_id, l_suppkey AS device_id, l_partkey AS point_id,
               l_quantity AS setpoint,
               CASE l_linenumber WHEN 1 THEN 'queued' WHEN 2 THEN 'accepted' WHEN 3 THEN 'active'
                    WHEN 4 THEN 'completed' ELSE 'failed' END AS status,
               l_returnflag = 'R' AS is_internal, l_shipdate AS updated_at, l_linenumber AS line,
               l_extendedprice AS price,
               row_number() OVER (PARTITION BY l_orderkey
                   ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS arrival
        FROM lineitem""",
    "queue": """
        SELECT control_request_id, last.device_id AS device_id, last.point_id AS point_id,
               last.setpoint AS setpoint, last.status AS status, last.updated_at AS updated_at,
               created_by
        FROM (SELECT control_request_id,
                     arg_min({'device_id': device_id, 'point_id': point_id, 'setpoint': setpoint,
                              'status': status, 'updated_at': updated_at}, place) AS last,
                     arg_min(device_id, arrival) AS created_by
              FROM (SELECT *, row_number() OVER (PARTITION BY control_request_id
                           ORDER BY updated_at DESC, arrival) AS place
                    FROM control_log WHERE NOT is_internal)
              GROUP BY 1)""",
    "day_factors": """
        SELECT p.site_id, CAST(r.event_time AS DATE) AS utc_day, CAST(count(*) % 10 AS DOUBLE) / 10 AS factor
        FROM readings r JOIN points p ON p.point_id = r.point_id GROUP BY 1, 2""",
    "outages": """
        SELECT event_id AS outage_id, user_id AS device_id, ts AS start_at,
               ts + to_minutes(CAST(floor(value) AS BIGINT)) AS end_at
        FROM events WHERE event_type = 'error'""",
    "devices": """
        SELECT concat('R', r_regionkey) AS device_id, r_regionkey AS site_id, r_name AS name, 1 AS kind FROM region
        UNION ALL
        SELECT concat('N', n_nationkey), n_regionkey, n_name, 2 FROM nation
        UNION ALL
        SELECT concat('S', s_suppkey), n_regionkey, s_name, 3 FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "hierarchy": """
        SELECT concat('R', n_regionkey) AS parent_device_id, concat('N', n_nationkey) AS child_device_id FROM nation
        UNION ALL
        SELECT concat('N', s_nationkey), concat('S', s_suppkey) FROM supplier""",
    "definitions": """
        SELECT site_id * 10 + k AS alarm_definition_id, site_id,
               CASE k WHEN 1 THEN 'Inverter Communications Lost' WHEN 2 THEN 'Inverter Over Temperature'
                      ELSE 'Storm Output Degradation' END AS name,
               CASE k WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'information' END AS severity
        FROM sites, unnest([1, 2, 3]) AS t(k)""",
    "crossings": """
        SELECT point_id, time_bucket(INTERVAL 1 DAY, event_time) AS day, min(event_time) AS first_cross,
               CAST(round(CAST(max(v) AS DECIMAL(38,9)), 1) AS DOUBLE) AS peak
        FROM (SELECT point_id, event_time, value_double AS v FROM readings JOIN points USING (point_id) WHERE uom = 'degC')
        WHERE v > 78 GROUP BY 1, 2""",
    "alarms": """
        SELECT d.alarm_definition_id, p.site_id, d.name AS alarm_name, p.name AS source, o.device_id,
               CASE WHEN p.rollup_uom IS NOT NULL THEN p.point_id END AS point_id, d.severity,
               o.end_at > s.now_at AS is_active,
               'No telemetry from ' || p.name || ' for 5 minutes' AS message,
               o.start_at + INTERVAL 5 MINUTE AS raised_at,
               CASE WHEN o.end_at <= s.now_at THEN o.end_at END AS cleared_at,
               CAST(NULL AS TIMESTAMP) AS acknowledged_at,
               greatest(o.start_at + INTERVAL 5 MINUTE, least(o.end_at, s.now_at)) AS updated_at
        FROM outages o JOIN points p ON p.point_id = o.device_id
        JOIN definitions d ON d.site_id = p.site_id AND d.name = 'Inverter Communications Lost'
        CROSS JOIN span s
        UNION ALL
        SELECT d.alarm_definition_id, p.site_id, d.name, p.name, p.point_id, p.point_id, d.severity, false,
               p.name || ' heatsink exceeded 78 degC (peak ' || printf('%.1f', c.peak) || ')',
               c.first_cross, c.first_cross + INTERVAL 2 HOUR, c.first_cross + INTERVAL 20 MINUTE,
               c.first_cross + INTERVAL 2 HOUR
        FROM crossings c JOIN points p ON p.point_id = c.point_id
        JOIN definitions d ON d.site_id = p.site_id AND d.name = 'Inverter Over Temperature'
        UNION ALL
        SELECT d.alarm_definition_id, w.site_id, d.name, NULL, NULL, NULL, d.severity, false,
               'Output degraded by weather: cloud factor ' || printf('%.2f', w.factor),
               ((w.utc_day + INTERVAL 11 HOUR) AT TIME ZONE s.timezone) AT TIME ZONE 'UTC',
               ((w.utc_day + INTERVAL 16 HOUR) AT TIME ZONE s.timezone) AT TIME ZONE 'UTC', NULL,
               ((w.utc_day + INTERVAL 16 HOUR) AT TIME ZONE s.timezone) AT TIME ZONE 'UTC'
        FROM day_factors w JOIN sites s ON s.site_id = w.site_id
        JOIN definitions d ON d.site_id = w.site_id AND d.name = 'Storm Output Degradation'
        CROSS JOIN span x
        WHERE w.factor < 0.40
          AND ((w.utc_day + INTERVAL 16 HOUR) AT TIME ZONE s.timezone) AT TIME ZONE 'UTC' <= x.now_at""",
}


def _needed(text: str) -> list[str]:
    """Views the text uses, directly or through another view, in definition order."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\b[a-z_]+\b", pending.pop()))
        for name in VIEWS:
            if name in words and name not in found:
                found.add(name)
                pending.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def with_views(sql: str) -> str:
    """The query with its views in front; `sql` may start with its own WITH list."""
    text = sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in _needed(text))
    if not views:
        return text
    recursive = re.match(r"WITH\s+(RECURSIVE\s+)?", text)
    if recursive:
        keyword = "WITH RECURSIVE" if recursive[1] else "WITH"
        return f"{keyword} {views},\n{text[recursive.end():]}"
    return f"WITH {views}\n{text}"


def r(expr: str, digits: int = 4) -> str:
    """SQL of `round_half_away`."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"
