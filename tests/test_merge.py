import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators import merge as m

ROWS = "key string, name string, updated_at timestamp_ntz"
UPD = ROWS + ", arrival int, block int"


def _merge(spark, target, updates):
    t = spark.createDataFrame(target, ROWS)
    u = spark.createDataFrame([(*r, i, i // 3) for i, r in enumerate(updates)], UPD)
    return m.lww_merge(t, u, ["key"], "updated_at", ["name"], block="block", now=at("12:00"))


def test_newest_wins_and_stale_is_reported(spark):
    merged, outcome = _merge(spark, [], [("k", "A", at("01:00")), ("k", "B", at("03:00")), ("k", "C", at("02:00"))])
    assert rows(merged, "key", "name", "updated_at") == [("k", "B", at("03:00"))]
    assert rows(outcome, "arrival", "accepted") == [(0, True), (1, True), (2, False)]


def test_tie_goes_to_the_first(spark):
    merged, outcome = _merge(spark, [], [("k", "B", at("03:00")), ("k", "D", at("03:00"))])
    assert rows(merged, "name") == [("B",)]
    assert rows(outcome, "arrival", "accepted") == [(0, True), (1, False)]
    merged, outcome = _merge(spark, [("k", "old", at("03:00"))], [("k", "D", at("03:00"))])
    assert rows(merged, "name") == [("old",)] and rows(outcome, "accepted") == [(False,)]


def test_missing_time_means_now(spark):
    merged, outcome = _merge(spark, [("k", "old", at("11:59"))], [("k", "new", None)])
    assert rows(merged, "name", "updated_at") == [("new", at("12:00"))]
    assert rows(outcome, "accepted") == [(True,)]


@pytest.mark.parametrize("seed", range(3))
def test_replay_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    target = [(f"k{i}", "t", at("05:00")) for i in range(3)]
    updates = [
        (f"k{0 if rng.random() < 0.5 else rng.randrange(6)}", f"n{i}", at(f"{rng.randrange(10)}:00")) for i in range(60)
    ]
    state, accepted = {k: (n, t) for k, n, t in target}, []
    for key, name, t in updates:
        ok = key not in state or t > state[key][1]
        accepted.append(ok)
        if ok:
            state[key] = (name, t)
    merged, outcome = _merge(spark, target, updates)
    assert rows(merged, "key", "name", "updated_at") == sorted((k, *v) for k, v in state.items())
    assert [r[1] for r in rows(outcome, "arrival", "accepted")] == accepted
    again, _ = m.lww_merge(
        merged, spark.createDataFrame([(*r, i, 0) for i, r in enumerate(updates)], UPD), ["key"], "updated_at", ["name"]
    )
    assert rows(again, "key", "name", "updated_at") == rows(merged, "key", "name", "updated_at")


@pytest.mark.parametrize("kind", ["int", "timestamp_ntz", "string"])
def test_outcome_for_numbered_timed_and_other_arrivals(spark, kind):
    rng = random.Random(9)
    data = [("k" if rng.random() < 0.6 else "j", at(f"{rng.randrange(12)}:00"), i) for i in range(50)]
    place = {"int": lambda i: i, "timestamp_ntz": lambda i: at("00:00") + dt.timedelta(hours=7 * i), "string": lambda i: f"{i:04d}"}[kind]
    df = spark.createDataFrame([(k, t, place(i)) for k, t, i in data], f"key string, updated_at timestamp_ntz, arrival {kind}")
    newest, want = {}, []
    for k, t, i in data:
        ok = k not in newest or t > newest[k]
        newest[k] = max(t, newest.get(k, t))
        want.append((place(i), ok))
    assert rows(m.lww_outcome(df, ["key"], "updated_at"), "arrival", "accepted") == want


CALLS = (
    "control_request_id string, created_at timestamp_ntz, site_id int, created_by string, status string, "
    "description string, is_internal boolean, updated_at timestamp_ntz, arrival int, block int"
)


def _call(i, status, minute, site=1, description=None, internal=None, request="r", by="u"):
    return (request, at("10:00"), site, by, status, description, internal, at(f"10:{minute:02d}"), i, i // 2)


def _submit(spark, *calls):
    empty = spark.createDataFrame([], CALLS)
    return m.submit_control_requests(empty, spark.createDataFrame(list(calls), CALLS), at("12:00"))


def test_queue_keeps_first_site_and_newest_rest(spark):
    audit, queue, outcome = _submit(
        spark, _call(0, "queued", 0, 1, "x", by="a"), _call(1, "accepted", 5, 2, None, by="b")
    )
    assert rows(queue, "site_id", "created_by", "status", "description") == [(1, "a", "accepted", None)]
    assert rows(audit, "arrival", "description") == [(0, "x"), (1, None)]
    assert rows(outcome, "arrival", "returned_id") == [(0, "r"), (1, "r")]


def test_stale_transition_is_audited_only(spark):
    audit, queue, outcome = _submit(spark, _call(0, "queued", 0), _call(1, "active", 9), _call(2, "accepted", 5))
    assert rows(queue, "status") == [("active",)] and audit.count() == 3
    assert rows(outcome, "arrival", "returned_id") == [(0, "r"), (1, "r"), (2, None)]


@pytest.mark.parametrize("internal,queued", [(True, 0), (None, 1), (False, 1)])
def test_internal_requests_bypass_the_queue(spark, internal, queued):
    audit, queue, outcome = _submit(spark, _call(0, "completed", 0, internal=internal))
    assert (audit.count(), queue.count()) == (1, queued)
    assert rows(outcome, "returned_id") == [("r" if queued else None,)]


def test_insert_if_absent(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    r = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3)], "k string, v int")
    assert rows(m.insert_if_absent(t, r, ["k"], F.col("v")), "k", "v") == [("a", 1), ("b", 2)]


def test_upsert_replaces_listed_columns_only(spark):
    t = spark.createDataFrame([("a", 1, "keep"), ("c", 5, "c")], "k string, v int, note string")
    r = spark.createDataFrame([("a", None, "no"), ("b", 2, "new")], "k string, v int, note string")
    assert rows(m.upsert(t, r, ["k"], ["v"]), "k", "v", "note") == [("a", None, "keep"), ("b", 2, "new"), ("c", 5, "c")]


def test_replace_latest(spark):
    t = spark.createDataFrame([(1, at("01:00"), "x"), (2, at("03:00"), "x"), (3, at("02:00"), "x")], "id int, s timestamp_ntz, e string")
    assert rows(m.replace_latest(t, "id", "s", "e", F.lit("open")), "id", "e") == [(1, "x"), (2, "open"), (3, "x")]


def test_set_retention_days(spark):
    empty = spark.createDataFrame([], "table_name string, retention_days int, updated_at timestamp_ntz")
    out = m.set_retention_days(empty, " Point_Readings ", 30, at("01:00"))
    assert rows(out, "table_name", "retention_days") == [("point_readings", 30)]
    again = m.set_retention_days(out, "point_readings", 10, at("02:00"))
    assert rows(again, "table_name", "retention_days", "updated_at") == [("point_readings", 10, at("02:00"))]
    for name, days in (("point_readings", -1), ("point_readings", None), ("unknown", 5)):
        with pytest.raises(ValueError):
            m.set_retention_days(empty, name, days, at("01:00"))


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert rows(m.latest_per_key(df, ["k"], F.col("t")), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(m.first_per_key(df, ["k"], F.col("t")), "k", "v") == [("a", "x"), ("b", "z")]


def test_folds_need_no_window(spark):
    df = spark.createDataFrame([("k", "n", at("01:00"), 0, 0)], UPD)
    plan = m.lww_fold(df, ["key"], "updated_at", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_device_defaults(spark):
    devices = spark.createDataFrame([], "device_id string, site_id string, name string, status string, updated_at timestamp_ntz")
    up = spark.createDataFrame([("d", "s", "n", "active", None, 0)], "device_id string, site_id string, name string, status string, updated_at timestamp_ntz, arrival int")
    merged, _ = m.upsert_devices(devices, up, now=dt.datetime(2024, 1, 1))
    assert rows(merged, "device_id", "name", "updated_at") == [("d", "n", dt.datetime(2024, 1, 1))]


def test_advancing_a_stored_queue_equals_the_full_fold(spark):
    rng = random.Random(4)
    calls = [
        _call(i, f"s{i}", rng.randrange(40), site=i, description=f"d{i}", internal=rng.choice([True, None, False]),
              request=rng.choice("rst"), by=f"u{i}")
        for i in range(60)
    ]
    full = m.control_queue(spark.createDataFrame(calls, CALLS))
    first = m.control_queue(spark.createDataFrame(calls[:30], CALLS))
    after = m.advance_queue(first, spark.createDataFrame(calls[30:], CALLS))
    assert rows(after, *full.columns) == rows(full, *full.columns)


def test_null_keys_and_arrivals_are_judged(spark):
    data = [(None, at("01:00"), 1), (None, at("02:00"), 2), (None, at("02:00"), 3), ("k", at("03:00"), None), ("k", at("04:00"), None), ("k", at("03:30"), 1)]
    df = spark.createDataFrame(data, "key string, updated_at timestamp_ntz, arrival int")
    got = rows(m.lww_outcome(df, ["key"], "updated_at"), "key", "updated_at", "arrival", "accepted")
    assert got == [
        (None, at("01:00"), 1, True), (None, at("02:00"), 2, True), (None, at("02:00"), 3, False),
        ("k", at("03:00"), None, True), ("k", at("03:30"), 1, False), ("k", at("04:00"), None, True),
    ]
    target = spark.createDataFrame([("k", "old", at("03:15"))], ROWS)
    merged, outcome = m.lww_merge(target, df.withColumn("name", F.lit("new")), ["key"], "updated_at", ["name"])
    assert outcome.count() == 6 and rows(merged, "key", "updated_at") == [(None, at("02:00")), ("k", at("04:00"))]
