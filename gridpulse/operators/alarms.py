"""Alarms derived from the data, and configured alarm rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions.buckets import at_local_time, bucket_of, instant, to_local
from gridpulse.functions.scalars import round_half_away, stable_id
from gridpulse.operators.outages import not_covered
from gridpulse.operators.scans import Running, in_stretches, running

# Alarm names, message texts, delays and limits.
COMMS_LOST = "Inverter Communications Lost"
OVER_TEMPERATURE = "Inverter Over Temperature"
STORM = "Storm Output Degradation"
OVER_TEMPERATURE_LIMIT = 78.0
STORM_LIMIT = 0.40
STORM_HOURS = (dt.time(11, 0), dt.time(16, 0))
CLEARED_TEXT = "Condition cleared"

ALARM_COLUMNS = (
    "alarm_history_id", "alarm_definition_id", "site_id", "alarm_name", "source", "device_id",
    "point_id", "severity", "is_active", "is_system_alarm", "message", "raised_at",
    "cleared_at", "acknowledged_at", "created_at", "updated_at",
)


def _minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' MINUTE")


def _definitions(definitions: DataFrame, name: str) -> DataFrame:
    return definitions.filter(F.col("name") == name).select(
        "alarm_definition_id", "site_id", F.col("name").alias("alarm_name"), "severity"
    )


def _history(df: DataFrame, **columns: Column) -> DataFrame:
    """Alarm rows in the history layout; the id follows from the natural key."""
    for name, value in columns.items():
        df = df.withColumn(name, value)
    df = df.withColumn("alarm_history_id", stable_id("alarm_definition_id", "device_id", "point_id", "raised_at"))
    return df.select(*ALARM_COLUMNS)


def comms_lost(
    outages: DataFrame, devices: DataFrame, definitions: DataFrame, device_points: DataFrame, now: dt.datetime
) -> DataFrame:
    """One alarm per outage, five minutes after it starts; active while it lasts.

    `device_points` holds the candidate points per device; the smallest id is
    shown, or NULL when the device has none.
    """
    moment = instant(now)
    first_point = device_points.groupBy("device_id").agg(F.min("point_id").alias("point_id"))
    device = devices.select("device_id", F.col("name").alias("source"), "site_id")
    rows = (
        outages.select("device_id", "start_at", "end_at")
        .join(device, "device_id")
        .join(_definitions(definitions, COMMS_LOST), "site_id")
        .join(first_point, "device_id", "left")
    )
    raised = F.col("start_at") + _minutes(5)
    end = F.col("end_at")
    return _history(
        rows,
        is_active=end > moment,
        is_system_alarm=F.lit(False),
        message=F.format_string("No telemetry from %s for 5 minutes", F.col("source")),
        raised_at=raised,
        cleared_at=F.when(end <= moment, end),
        acknowledged_at=F.lit(None).cast("timestamp_ntz"),
        created_at=raised,
        updated_at=F.greatest(raised, F.least(end, moment)),
    )


def threshold_crossings(
    readings: DataFrame, limit: float = OVER_TEMPERATURE_LIMIT, points: DataFrame | None = None, column: str = "value_double"
) -> DataFrame:
    """First time above `limit` and the peak, per point and UTC day.

    One typed column is tested, and the comparison reaches the scan. `points` are
    the points of the kind that the limit is meant for, met before anything is grouped; all without it.
    """
    hot = readings.filter(F.col(column) > F.lit(limit)).withColumn("_v", F.col(column))
    hot = hot if points is None else hot.join(points.select("point_id"), "point_id", "left_semi")
    return hot.groupBy("point_id", bucket_of(F.col("event_time"), "1 day").alias("day")).agg(
        F.min("event_time").alias("first_cross"), round_half_away(F.max("_v"), 1).alias("peak")
    )


def _observed(value: Column, bit: Column) -> Column:
    """The value, or one bit of its whole part where a bit position is given."""
    return F.when(bit.isNull(), value).otherwise(F.getbit(F.floor(value).cast("bigint"), bit).cast("double"))


def over_temperature(
    crossings: DataFrame, points: DataFrame, devices: DataFrame, device_points: DataFrame, definitions: DataFrame
) -> DataFrame:
    """One cleared alarm per crossing: two hours long, acknowledged after 20 minutes."""
    rows = (
        crossings.join(points.select("point_id", "site_id"), "point_id")
        .join(device_points.select("point_id", "device_id"), "point_id")
        .join(devices.select("device_id", F.col("name").alias("source")), "device_id")
        .join(_definitions(definitions, OVER_TEMPERATURE), "site_id")
    )
    first = F.col("first_cross")
    cleared = first + F.expr("INTERVAL '2' HOUR")
    text = F.format_string("%s heatsink exceeded 78 degC (peak %.1f)", F.col("source"), F.col("peak"))
    return _history(
        rows,
        is_active=F.lit(False),
        is_system_alarm=F.lit(False),
        message=text,
        raised_at=first,
        cleared_at=cleared,
        acknowledged_at=first + _minutes(20),
        created_at=first,
        updated_at=cleared,
    )


def storm_advisories(day_factors: DataFrame, sites: DataFrame, definitions: DataFrame, now: dt.datetime) -> DataFrame:
    """An advisory per site and day with a low factor, 11:00 to 16:00 site time,
    once 16:00 has passed."""
    start, stop = STORM_HOURS
    rows = (
        day_factors.filter(F.col("factor") < STORM_LIMIT)
        .join(sites.select("site_id", "timezone"), "site_id")
        .withColumn("raised_at", at_local_time(F.col("local_day"), start, F.col("timezone")))
        .withColumn("cleared_at", at_local_time(F.col("local_day"), stop, F.col("timezone")))
        .filter(F.col("cleared_at") <= instant(now))
        .join(_definitions(definitions, STORM), "site_id")
    )
    text = F.format_string("Output degraded by weather: cloud factor %.2f", round_half_away("factor", 2))
    none = F.lit(None)
    return _history(
        rows,
        source=none.cast("string"),
        device_id=none.cast("string"),
        point_id=none.cast("string"),
        is_active=F.lit(False),
        is_system_alarm=F.lit(True),
        message=text,
        acknowledged_at=none.cast("timestamp_ntz"),
        created_at=F.col("raised_at"),
        updated_at=F.col("cleared_at"),
    )


def alarm_events(history: DataFrame) -> DataFrame:
    """A raise event per alarm and a clear event where it cleared, in one pass."""
    text = F.coalesce("message", "alarm_name")

    def event(condition: str, at: str, message: Column) -> Column:
        return F.struct(
            F.lit(condition).alias("event_condition"), F.col(at).alias("event_time"), message.alias("message")
        )

    both = F.array(event("raise", "raised_at", text), event("clear", "cleared_at", F.lit(CLEARED_TEXT)))
    rows = history.withColumn("_e", F.explode(both)).filter(F.col("_e.event_time").isNotNull())
    return rows.select(
        "site_id",
        stable_id("alarm_history_id", "_e.event_condition").alias("alarm_event_id"),
        "alarm_history_id",
        "alarm_definition_id",
        "_e.event_time",
        "_e.message",
        "_e.event_condition",
        "point_id",
        F.col("_e.event_time").alias("created_at"),
    )


def _compare(value: Column, operator: Column, limit: Column) -> Column:
    return (
        F.when(operator == ">", value > limit)
        .when(operator == ">=", value >= limit)
        .when(operator == "=", value == limit)
        .when(operator == "<>", value != limit)
        .when(operator == "<", value < limit)
        .when(operator == "<=", value <= limit)
    )


def rule_sides(definitions: DataFrame, expressions: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """Every expression with what its side of the definition asks for, and the zone of the definition's site.

    Neither table is sent whole to the driver: both may have a row per point, and few narrow columns of a
    compressed table look small enough to broadcast long after their rows are not.
    """
    raise_side = F.col("role") == "raise"
    rules = definitions.select(
        "alarm_definition_id", "site_id", "raise_occurrence_limit", "raise_timeframe_s",
        "clear_occurrence_limit", "clear_timeframe_s", "raise_window_start_s",
        "clear_window_start_s", "raise_match_operator", "clear_match_operator",
    )
    if sites is not None:
        rules = rules.join(sites.select("site_id", "timezone"), "site_id")
    else:
        rules = rules.withColumn("timezone", F.lit("UTC"))
    if "bit_position" not in expressions.columns:
        expressions = expressions.withColumn("bit_position", F.lit(None).cast("int"))
    return expressions.join(rules.hint("merge"), "alarm_definition_id").select(
        "alarm_definition_id", "expression_id", "point_id", "point_value", "comparison_operator", "bit_position",
        "role", "group_operator", "group_number", "timezone",
        F.when(raise_side, F.col("raise_occurrence_limit")).otherwise(F.col("clear_occurrence_limit")).alias("limit"),
        F.when(raise_side, F.col("raise_timeframe_s")).otherwise(F.col("clear_timeframe_s")).alias("seconds"),
        F.when(raise_side, F.col("raise_window_start_s")).otherwise(F.col("clear_window_start_s")).alias("from_s"),
        F.when(raise_side, F.col("raise_match_operator")).otherwise(F.col("clear_match_operator")).alias("match"),
    )


def is_hit() -> Column:
    """Whether a reading fulfils the expression of `rule_sides` it is joined to; never NULL."""
    seen = _observed(F.col("value"), F.col("bit_position"))
    hit = _compare(seen, F.col("comparison_operator"), F.col("point_value").cast("double"))
    local = to_local(F.col("event_time"), F.col("timezone"))
    clock = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    return F.coalesce(hit & (F.col("from_s").isNull() | (clock >= F.col("from_s"))), F.lit(False))


def evaluate_rules(
    readings: DataFrame, definitions: DataFrame, expressions: DataFrame, sites: DataFrame | None = None
) -> DataFrame:
    """Raise and clear times of every alarm definition.

    An expression holds while at least N of its hits are younger than M seconds;
    with M = 0 a hit lasts until the point's next reading. Expressions of a group
    combine by the group operator, groups by the definition's match operator. An
    alarm rises when its raise side holds and clears when only its clear side
    holds; without clear expressions it clears when the raise side ends. Raise
    (clear) hits before the window start, in seconds past local midnight, do not
    count; `sites` gives the zone, UTC otherwise. An expression with a `bit_position`
    compares that bit of the whole part of the value.

    `readings` has point_id, event_time and value. Everything is a running sum of
    +1/-1 steps, worked in (alarm, stretch) blocks: where each expression stands when a
    stretch begins is carried over, and from there all levels follow within the stretch.
    Stretches are of about equal size however many steps an alarm has. The steps, and the
    readings of points whose hits last until the next one, are kept in the shared folder
    when the function is called, as they are read twice.
    """
    side = rule_sides(definitions, expressions, sites)

    # 1. The hits of every expression; only those without a duration need the point's next reading.
    values = readings.select("point_id", "event_time", "value")
    timed = F.coalesce(F.col("seconds") > 0, F.lit(False))
    brief, lasting = side.filter(timed), side.filter(~timed)
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("seconds").cast("decimal(18,6)"))
    hits = values.join(brief, "point_id").filter(is_hit()).withColumn("_until", F.col("event_time") + seconds)
    watched = values.join(lasting.select("point_id"), "point_id", "left_semi")
    watched = in_stretches(watched, ["point_id"], "event_time", "_stretch")
    following = Running("_until", F.col("event_time"), "last", inclusive=False)
    watched = running(watched, ["point_id"], "_stretch", "event_time", [following], descending=True)
    hits = hits.unionByName(watched.drop("_stretch").join(lasting, "point_id").filter(is_hit()))
    expr_keys = ["alarm_definition_id", "role", "group_number", "expression_id"]
    step = F.explode(
        F.array(
            F.struct(F.col("event_time").alias("at"), F.lit(1).alias("d")),
            F.struct(F.col("_until").alias("at"), F.lit(-1).alias("d")),
        )
    )
    steps = hits.select(*expr_keys, step.alias("s")).filter("s.at IS NOT NULL")
    steps = steps.select(*expr_keys, F.col("s.at").alias("at"), F.col("s.d").alias("d"))

    # 2. Net steps per expression and instant, in stretches; read by the carry and by the rows.
    net = steps.groupBy(*expr_keys, "at").agg(F.sum("d").alias("net")).filter("net <> 0")
    net = in_stretches(net, ["alarm_definition_id"], "at", "_stretch")

    # 3. What every expression of an alarm stands at when one of the alarm's stretches begins.
    parts = side.select(*expr_keys, "limit").distinct()
    stretches = net.select("alarm_definition_id", "_stretch").distinct()
    totals = net.groupBy(*expr_keys, "_stretch").agg(F.sum("net").alias("total"))
    grid = stretches.join(parts, "alarm_definition_id").join(totals, [*expr_keys, "_stretch"], "left")
    earlier = Window.partitionBy(*expr_keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    begin = grid.select(
        *expr_keys, "_stretch", F.lit(None).cast("timestamp_ntz").alias("at"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("net"),
    )

    # 4. Expression -> group -> side inside (alarm, stretch), dealt once; a row without a time begins it.
    groups = side.groupBy("alarm_definition_id", "role", "group_number").agg(
        F.countDistinct("expression_id").alias("n"), F.max("group_operator").alias("op")
    )
    sides = side.groupBy("alarm_definition_id", "role").agg(
        F.countDistinct("group_number").alias("n"), F.max("match").alias("op")
    )

    def needed(of: DataFrame) -> DataFrame:
        return of.withColumn("need", F.when(F.col("op") == "all", F.col("n")).otherwise(F.lit(1))).drop("n", "op")

    dealt = begin.unionByName(net.select(*begin.columns)).repartition("alarm_definition_id", "_stretch")
    held = _changes(dealt.join(parts.withColumnRenamed("limit", "need"), expr_keys), [*expr_keys, "_stretch"])
    for of, keys in ((groups, expr_keys[:3]), (sides, expr_keys[:2])):
        summed = held.groupBy(*keys, "_stretch", "at").agg(F.sum("change").alias("net"))
        held = _changes(summed.join(needed(of), keys), [*keys, "_stretch"])

    # 5. The alarm's state: the last instruction given by either side.
    key = ["alarm_definition_id"]
    on = F.col("role") == "raise"
    moves = held.groupBy(*key, "_stretch", "at").agg(
        F.sum(F.when(on, F.col("change")).otherwise(0)).alias("r"),
        F.sum(F.when(on, 0).otherwise(F.col("change"))).alias("c"),
    )
    here = Window.partitionBy(*key, "_stretch").orderBy(F.col("at").asc_nulls_first())
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    has_clear = side.groupBy(*key).agg(F.max((F.col("role") == "clear").cast("int")).alias("has_clear"))
    moves = moves.join(has_clear, key).withColumns({"raise_on": F.sum("r").over(so_far), "clear_on": F.sum("c").over(so_far)})
    off = F.when(F.col("has_clear") == 1, F.col("clear_on") > 0).otherwise(F.lit(True))
    moves = moves.withColumn("want", F.when(F.col("raise_on") > 0, 1).when(off, 0)).select(*key, "_stretch", "at", "want")
    place = F.struct(F.col("at").isNotNull(), F.col("at"))  # sorts the beginning of a stretch first
    last = moves.groupBy(*key, "_stretch").agg(F.max_by("want", F.when(F.col("want").isNotNull(), place)).alias("last"))
    before_stretch = Window.partitionBy(*key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*key, "_stretch", F.last("last", ignorenulls=True).over(before_stretch).alias("carry"))
    moves = moves.join(carry, [*key, "_stretch"])
    state = F.coalesce(F.last("want", ignorenulls=True).over(so_far), "carry", F.lit(0))
    before = F.last("want", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1))
    moves = moves.withColumns({"state": state, "before": F.coalesce(before, "carry", F.lit(0))})
    return moves.filter("at IS NOT NULL AND state <> before").select(
        "alarm_definition_id",
        F.col("at").alias("event_time"),
        F.when(F.col("state") == 1, "raise").otherwise("clear").alias("event_condition"),
    )


def _changes(net: DataFrame, keys: list[str]) -> DataFrame:
    """Where the running sum of `net` reaches `need` (+1) or falls below it (-1), within `keys`.

    The row that begins a stretch is always kept; its change is what holds already.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("at").asc_nulls_first())
    level = F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, 0))
    holds = net.withColumn("_holds", (level >= F.col("need")).cast("int"))
    change = F.col("_holds") - F.lag("_holds", 1, 0).over(order)
    return holds.withColumn("change", change).filter("change <> 0 OR at IS NULL").select(*keys, "at", "change")


def suppress(raised: DataFrame, active: DataFrame, dependencies: DataFrame, now: dt.datetime) -> DataFrame:
    """Alarms that were not raised while a limiting alarm was active.

    `active` has alarm_definition_id, raised_at and cleared_at; an alarm that has
    not cleared limits up to and including `now`.
    """
    end = F.coalesce(F.col("cleared_at"), instant(now + dt.timedelta(microseconds=1)))
    limits = dependencies.join(
        active.select(
            F.col("alarm_definition_id").alias("limited_by_alarm_definition_id"),
            F.col("raised_at").alias("_start"),
            end.alias("_end"),
        ),
        "limited_by_alarm_definition_id",
    ).withColumnRenamed("dependent_alarm_definition_id", "alarm_definition_id")
    return not_covered(raised, "raised_at", limits, ["alarm_definition_id"], "_start", "_end")


def expand_schedules(schedules: DataFrame, horizon: dt.datetime) -> DataFrame:
    """Run times of every ready or active schedule up to `horizon`, start included."""
    unit = (
        F.when(F.col("repeat_units") == "minutes", 60)
        .when(F.col("repeat_units") == "hours", 3600)
        .when(F.col("repeat_units") == "days", 86400)
        .when(F.col("repeat_units") == "weeks", 604800)
    )
    seconds = (F.col("repeat_interval").cast("bigint") * unit).cast("decimal(18,6)")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    runs = F.when(
        F.col("repeat_interval") > 0, F.sequence(F.col("start_at"), instant(horizon), step)
    ).otherwise(F.array("start_at"))
    live = schedules.filter(
        F.col("status").isin("ready", "active") & (F.col("start_at") <= instant(horizon))
    )
    return live.select("site_id", "schedule_id", F.explode(runs).alias("run_at"))
