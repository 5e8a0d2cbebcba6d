import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators import alarms as al
from gridpulse.operators import outages as og
from gridpulse.operators.meter import derived_sum, site_meter
from gridpulse.operators.scans import Running, running

OUTAGES = "outage_id int, device_id string, site_id string, start_at timestamp_ntz, end_at timestamp_ntz"


def outages(spark, *spans):
    return spark.createDataFrame([(i, d, "s", a, b) for i, (d, a, b) in enumerate(spans)], OUTAGES)


def test_silence_is_half_open(spark, readings):
    df = readings(*[(at(c), "d", 1.0) for c in ("09:59", "10:00", "10:29", "10:30")])
    kept = og.silence(df, outages(spark, ("d", at("10:00"), at("10:30"))))
    assert rows(kept, "event_time") == [(at("09:59"),), (at("10:30"),)]


def test_silence_follows_the_device_mapping(spark, readings):
    df = readings((at("10:00"), "p1", 1.0), (at("10:00"), "p2", 1.0))
    mapping = spark.createDataFrame([("d", "p1")], "device_id string, point_id string")
    kept = og.silence(df, outages(spark, ("d", at("09:00"), at("11:00"))), mapping)
    assert rows(kept, "point_id") == [("p2",)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_silence_equals_brute_force(spark, readings, threshold):
    rng = random.Random(3)
    spans = []
    for _ in range(40):
        start = at("00:00") + dt.timedelta(minutes=rng.randrange(4 * 1440))
        spans.append((rng.choice("ab"), start, start + dt.timedelta(minutes=rng.choice([5, 60, 2000]))))
    times = [(at("00:00") + dt.timedelta(minutes=m), rng.choice("abc"), float(m)) for m in range(0, 6 * 1440, 17)]
    want = sorted(t for t, p, _ in times if not any(d == p and a <= t < b for d, a, b in spans))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = [r[0] for r in rows(og.silence(readings(*times), outages(spark, *spans)), "event_time")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want


def test_markers(spark, readings):
    power = spark.createDataFrame([("d", "pw")], "device_id string, point_id string")
    status = spark.createDataFrame([("d", "st")], "device_id string, point_id string")
    marks = og.outage_markers(outages(spark, ("d", at("10:07"), at("11:00")), ("d", at("10:08"), at("11:00"))), power, status)
    assert rows(marks, "event_time", "point_id", "value_double", "value_bigint", "data_quality") == [
        (at("10:05"), "pw", 0.0, None, "offline"), (at("10:05"), "st", None, 2, "offline")
    ]
    out = og.apply_markers(readings((at("10:05"), "pw", 7.0), (at("10:10"), "pw", 8.0)), marks)
    assert rows(out, "event_time", "point_id", "value_double", "reading_type", "data_quality") == [
        (at("10:05"), "pw", 0.0, "raw", "offline"), (at("10:05"), "st", None, "raw", "offline"),
        (at("10:10"), "pw", 8.0, "raw", "online"),
    ]


def test_data_gaps(spark, readings):
    df = readings(*[(at(c), "p", 1.0) for c in ("10:00", "10:05", "10:11", "12:00")])
    assert rows(og.data_gaps(df), "gap_start", "gap_end") == [(at("10:05"), at("10:11")), (at("10:11"), at("12:00"))]
    assert rows(og.data_gaps(df, now=at("13:00")), "gap_end")[0] == (None,)
    assert og.data_gaps(df, now=at("12:05")).count() == 2


def test_data_gaps_equal_brute_force(spark, readings):
    rng = random.Random(1)
    times = sorted({rng.randrange(200_000) for _ in range(600)})
    df = readings(*[(at("00:00") + dt.timedelta(seconds=s), "p", 1.0) for s in times])
    want = [(a, b) for a, b in zip(times, times[1:]) if b - a > 300]
    got = rows(og.data_gaps(df), "gap_start", "gap_end")
    assert [((a - at("00:00")).total_seconds(), (b - at("00:00")).total_seconds()) for a, b in got] == want


def test_meter(spark, readings):
    df = readings((at("10:00"), "a", 10.0), (at("10:00"), "b", 20.0), (at("10:00"), "x", 99.0))
    sources = spark.createDataFrame([("a", "s"), ("b", "s")], "point_id string, site_id string")
    meters = spark.createDataFrame([("m", "s")], "point_id string, site_id string")
    assert rows(site_meter(df, sources, meters), "event_time", "point_id", "value_double", "data_quality") == [
        (at("10:00"), "m", 29.6, "online")
    ]


@pytest.mark.parametrize("require,n", [(True, 1), (False, 2)])
def test_derived_sum(spark, readings, require, n):
    df = readings((at("10:00"), "a", 1.0), (at("10:00"), "b", 2.0), (at("11:00"), "a", 5.0))
    derived = spark.createDataFrame([("t", require)], "point_id string, require_all_sources boolean")
    sources = spark.createDataFrame([("t", "a"), ("t", "b")], "point_id string, source_point_id string")
    out = rows(derived_sum(df, derived, sources), "event_time", "value")
    assert len(out) == n and out[0] == (at("10:00"), 3.0)


@pytest.fixture
def world(spark):
    devices = spark.createDataFrame([("d", "s", "INV01")], "device_id string, site_id string, name string")
    definitions = spark.createDataFrame(
        [("c", "s", al.COMMS_LOST, "high"), ("o", "s", al.OVER_TEMPERATURE, "medium"), ("w", "s", al.STORM, "information")],
        "alarm_definition_id string, site_id string, name string, severity string",
    )
    mapping = spark.createDataFrame([("d", "p2"), ("d", "p1")], "device_id string, point_id string")
    return devices, definitions, mapping


def test_comms_lost(spark, world):
    devices, definitions, mapping = world
    o = outages(spark, ("d", at("10:00"), at("11:00")), ("d", at("11:30"), at("13:00")))
    out = al.comms_lost(o, devices, definitions, mapping, at("12:00"))
    assert rows(out, "raised_at", "cleared_at", "is_active", "updated_at", "point_id", "message") == [
        (at("10:05"), at("11:00"), False, at("11:00"), "p1", "No telemetry from INV01 for 5 minutes"),
        (at("11:35"), None, True, at("12:00"), "p1", "No telemetry from INV01 for 5 minutes"),
    ]
    none = al.comms_lost(o, devices, definitions, mapping.limit(0), at("12:00"))
    assert {r[0] for r in rows(none, "point_id")} == {None}


def test_threshold(spark, readings, world):
    devices, definitions, mapping = world
    df = readings((at("10:00"), "p1", 77.0), (at("11:00"), "p1", 78.0), (at("12:00"), "p1", 78.1), (at("13:00"), "x", 90.0))
    kind = spark.createDataFrame([("p1", "s")], "point_id string, site_id string")
    found = al.threshold_crossings(df, points=kind)
    assert rows(found, "point_id", "day", "first_cross", "peak") == [("p1", at("00:00"), at("12:00"), 78.1)]
    out = al.over_temperature(found, kind, devices, mapping, definitions)
    assert rows(out, "raised_at", "cleared_at", "acknowledged_at", "is_active", "message") == [
        (at("12:00"), at("14:00"), at("12:20"), False, "INV01 heatsink exceeded 78 degC (peak 78.1)")
    ]


def test_storm(spark, world):
    _, definitions, _ = world
    sites = spark.createDataFrame([("s", "America/Phoenix")], "site_id string, timezone string")
    factors = spark.createDataFrame(
        [("s", dt.date(2024, 1, 5), 0.2), ("s", dt.date(2024, 1, 4), 0.4), ("s", dt.date(2024, 1, 6), 0.1)],
        "site_id string, local_day date, factor double",
    )
    out = al.storm_advisories(factors, sites, definitions, at("23:00"))
    assert rows(out, "raised_at", "cleared_at", "is_system_alarm", "message") == [
        (at("18:00"), at("23:00"), True, "Output degraded by weather: cloud factor 0.20")
    ]
    assert al.storm_advisories(factors, sites, definitions, at("22:59")).count() == 0


def test_alarm_events_and_stable_ids(spark, world):
    devices, definitions, mapping = world
    o = outages(spark, ("d", at("10:00"), at("11:00")), ("d", at("11:30"), at("13:00")))
    history = al.comms_lost(o, devices, definitions, mapping, at("12:00"))
    events = al.alarm_events(history)
    assert sorted(r[0] for r in rows(events, "event_condition")) == ["clear", "raise", "raise"]
    assert len({r[0] for r in rows(events, "alarm_event_id")}) == 3
    again = al.alarm_events(history.repartition(3))
    assert rows(events, "alarm_event_id") == rows(again, "alarm_event_id")
    assert ("clear", "Condition cleared", at("11:00")) in rows(events, "event_condition", "message", "created_at")


# -- configured rules against a plain simulation -----------------------------

RULES = (
    "alarm_definition_id string, site_id string, raise_occurrence_limit int, raise_timeframe_s int, "
    "clear_occurrence_limit int, clear_timeframe_s int, raise_window_start_s int, clear_window_start_s int, "
    "raise_match_operator string, clear_match_operator string"
)
EXPRESSIONS = (
    "alarm_definition_id string, expression_id string, point_id string, point_value decimal(38,9), "
    "comparison_operator string, role string, group_operator string, group_number int"
)
OPS = {">": lambda a, b: a > b, "<=": lambda a, b: a <= b}


def _simulate(samples, rule, exprs):
    """Evaluate one definition at every instant anything can change."""
    _, _, rn, rm, cn, cm, rw, cw, r_match, c_match = rule
    limits = {"raise": (rn, rm, rw, r_match), "clear": (cn, cm, cw, c_match)}
    spans = []
    for _, eid, pid, value, op, role, gop, gno in exprs:
        n, m, window, _ = limits[role]
        own = sorted(t for t, p, _ in samples if p == pid)
        for t, p, v in samples:
            if p != pid or not OPS[op](v, float(value)):
                continue
            if window is not None and (t - t.replace(hour=0, minute=0, second=0)).total_seconds() < window:
                continue
            later = [x for x in own if x > t]
            until = t + dt.timedelta(seconds=m) if m else (later[0] if later else None)
            spans.append((eid, t, until))
    times = sorted({s[1] for s in spans} | {s[2] for s in spans if s[2]})

    def side(role, now):
        n, _, _, match = limits[role]
        groups = {}
        for _, eid, _, _, _, r, gop, gno in exprs:
            if r == role:
                live = sum(1 for e, a, b in spans if e == eid and a <= now and (b is None or now < b))
                groups.setdefault(gno, (gop, []))[1].append(live >= n)
        if not groups:
            return None
        states = [(all if gop == "all" else any)(hits) for gop, hits in groups.values()]
        return (all if match == "all" else any)(states)

    state, out = False, []
    for now in times:
        up, down = side("raise", now), side("clear", now)
        want = True if up else (False if (down if down is not None else True) else None)
        if want is not None and want != state:
            state = want
            out.append((rule[0], now, "raise" if want else "clear"))
    return out


@pytest.mark.parametrize("rule,exprs", [
    ((2, 1800, 1, 0, None, None, "any", "any"), [("e1", "p", 75, ">", "raise", "any", 1), ("e2", "p", 65, "<=", "clear", "any", 1)]),
    ((1, 0, 1, 0, None, None, "any", "any"), [("e1", "p", 70, ">", "raise", "all", 1), ("e2", "q", 70, ">", "raise", "all", 1)]),
    ((1, 900, 2, 3600, None, None, "all", "any"), [
        ("e1", "p", 60, ">", "raise", "any", 1), ("e2", "q", 60, ">", "raise", "any", 1), ("e3", "r", 30, ">", "raise", "any", 2),
        ("e4", "p", 40, "<=", "clear", "any", 1)]),
    ((1, 0, 1, 0, 43200, None, "any", "any"), [("e1", "p", 75, ">", "raise", "any", 1), ("e2", "p", 65, "<=", "clear", "any", 1)]),
])
def test_rules_equal_simulation(spark, rule, exprs):
    rng = random.Random(11)
    samples = []
    for p in "pqr":
        t = at("00:00")
        for _ in range(120):
            t += dt.timedelta(seconds=rng.randrange(60, 2400))
            samples.append((t, p, float(rng.randrange(20, 100))))
    full_rule = ("a", "s", *rule)
    full_exprs = [("a", eid, p, Decimal(v), op, role, gop, g) for eid, p, v, op, role, gop, g in exprs]
    df = spark.createDataFrame(samples, "event_time timestamp_ntz, point_id string, value double")
    out = al.evaluate_rules(df, spark.createDataFrame([full_rule], RULES), spark.createDataFrame(full_exprs, EXPRESSIONS))
    want = _simulate(samples, full_rule, full_exprs)
    assert [r for r in sorted(rows(out, "alarm_definition_id", "event_time", "event_condition"), key=lambda r: r[1])] == want
    assert len(want) > 3


@pytest.mark.parametrize("limits", [(3, 1800, 1, 0), (1, 0, 2, 3600)])
def test_one_hot_alarm_is_split(spark, monkeypatch, limits):
    """All steps belong to one alarm and one day; they are still dealt over several stretches."""
    rng = random.Random(5)
    t, samples = at("00:00"), []
    for _ in range(700):
        t += dt.timedelta(seconds=rng.randrange(20, 150))
        samples.append((t, "p", float(rng.randrange(20, 100))))
    rule = ("a", "s", *limits, None, None, "any", "any")
    exprs = [("a", "e1", "p", Decimal(90), ">", "raise", "any", 1), ("a", "e2", "p", Decimal(45), "<=", "clear", "any", 1)]
    kept, whole = [], al.in_stretches

    def seen(*args):
        kept.append(whole(*args))
        return kept[-1]

    monkeypatch.setattr(al, "in_stretches", seen)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(samples, "event_time timestamp_ntz, point_id string, value double")
        out = al.evaluate_rules(df, spark.createDataFrame([rule], RULES), spark.createDataFrame(exprs, EXPRESSIONS))
        got = sorted(rows(out, "alarm_definition_id", "event_time", "event_condition"), key=lambda r: r[1])
        sizes = [r["count"] for r in kept[-1].groupBy("_stretch").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == _simulate(samples, rule, exprs) and len(got) > 3
    assert len(sizes) > 2 and max(sizes) < sum(sizes) / 2


def test_rules_are_not_broadcast(spark):
    """Definitions and expressions may be as many as points, so they meet by a shuffle however small they look."""
    rule = ("a", "s", 1, 0, 1, 0, None, None, "any", "any")
    exprs = [("a", "e1", "p", Decimal(60), ">", "raise", "any", 1)]
    sides = al.rule_sides(spark.createDataFrame([rule], RULES), spark.createDataFrame(exprs, EXPRESSIONS))
    plan = sides._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(sides, "alarm_definition_id", "limit", "match") == [("a", 1, "any")]


def test_rules_without_readings(spark):
    rule = ("a", "s", 1, 0, 1, 0, None, None, "any", "any")
    exprs = [("a", "e1", "p", Decimal(60), ">", "raise", "any", 1)]
    df = spark.createDataFrame([], "event_time timestamp_ntz, point_id string, value double")
    out = al.evaluate_rules(df, spark.createDataFrame([rule], RULES), spark.createDataFrame(exprs, EXPRESSIONS))
    assert out.collect() == []


def test_suppression(spark):
    raised = spark.createDataFrame([("x", at("10:00")), ("x", at("12:00")), ("y", at("10:00"))], "alarm_definition_id string, raised_at timestamp_ntz")
    active = spark.createDataFrame([("l", at("09:00"), at("11:00"))], "alarm_definition_id string, raised_at timestamp_ntz, cleared_at timestamp_ntz")
    deps = spark.createDataFrame([("x", "l")], "dependent_alarm_definition_id string, limited_by_alarm_definition_id string")
    out = al.suppress(raised, active, deps, at("13:00"))
    assert rows(out, "alarm_definition_id", "raised_at") == [("x", at("12:00")), ("y", at("10:00"))]
    still = active.withColumn("cleared_at", F.lit(None).cast("timestamp_ntz"))
    assert rows(al.suppress(raised, still, deps, at("13:00")), "alarm_definition_id") == [("y",)]


def test_schedules(spark):
    df = spark.createDataFrame(
        [("s", 1, at("00:00"), 6, "hours", "ready"), ("s", 2, at("01:00"), 0, "days", "active"), ("s", 3, at("00:00"), 1, "hours", "draft")],
        "site_id string, schedule_id int, start_at timestamp_ntz, repeat_interval int, repeat_units string, status string",
    )
    out = rows(al.expand_schedules(df, at("12:00")), "schedule_id", "run_at")
    assert out == [(1, at("00:00")), (1, at("06:00")), (1, at("12:00")), (2, at("01:00"))]


@pytest.mark.parametrize("how,inclusive,descending", [
    (h, i, d) for h in ("sum", "max", "last") for i in (True, False) for d in (True, False)
])
def test_running_equals_brute_force(spark, how, inclusive, descending):
    rng = random.Random(7)
    data = [("ab"[rng.random() < 0.3], i, i // 5, rng.choice([None, rng.randrange(9)])) for i in range(80)]
    df = spark.createDataFrame(data, "k string, i int, b int, v int")
    out = running(df, ["k"], "b", "i", [Running("out", F.col("v"), how, inclusive)], descending)
    got = {(r["k"], r["i"]): r["out"] for r in out.collect()}
    for k, i, _, _ in data:
        line = sorted((x for x in data if x[0] == k), key=lambda x: -x[1] if descending else x[1])
        upto = [x for x in line if ((x[1] >= i) if descending else (x[1] <= i)) and (inclusive or x[1] != i)]
        seen = [x[3] for x in upto if x[3] is not None]
        want = sum(seen) if how == "sum" else (None if not seen else max(seen) if how == "max" else seen[-1])
        assert got[k, i] == want
