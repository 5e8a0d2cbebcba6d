import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators.rollups import ROLLUP_COLUMNS, create_rollup, rollup_1d, rollup_1h
from gridpulse.session import run_database
from gridpulse.sources import tables as tb
from gridpulse.streaming.ingest import batch_writer, new_readings
from gridpulse.streaming.rollups import publish, publish_days
from gridpulse.streaming.sources import parquet_stream
from gridpulse.streaming.windows import LATENESS, ingest_batch, newest_time, read_windows, start_ingest, start_windows, window_sizes

ONE = dt.timedelta(days=1)


@pytest.fixture
def table(spark, readings):
    name = f"{run_database(spark, 'test_windows')}.point_readings"
    tb.create_partitioned(spark, name, tb.with_partition(readings((at("10:00"), "p", 1.0)).limit(0), "event_time"))
    return name


@pytest.fixture
def feed(spark, readings, table, tmp_path):
    """Streams every batch of rows through both streams; returns the folder and the last progress of the windows."""
    src, folder = str(tmp_path / "src"), str(tmp_path / "streams")

    def run(*batches):
        for batch in batches:
            readings(*batch).coalesce(1).write.mode("append").parquet(src)
            stream = parquet_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
            start_ingest(stream, table, folder, once=True).awaitTermination()
            query = start_windows(spark, table, folder, once=True)
            query.awaitTermination()
        return folder, query.recentProgress

    return run


def same(spark, got, want):
    assert rows(got, *ROLLUP_COLUMNS) == rows(want, *ROLLUP_COLUMNS)


def test_unordered_batches_with_rows_past_the_bound(spark, readings, feed):
    rng = random.Random(8)
    everything = [(at("00:00") + rng.randrange(14) * ONE + dt.timedelta(minutes=i), "pqr"[i % 3], float(i % 17), ["online", "error"][i % 2]) for i in range(240)]
    folder, _ = feed(*[everything[i::4] for i in range(4)])
    same(spark, read_windows(spark, folder), rollup_1h(readings(*everything)))


def test_late_rows_are_repaired_and_the_others_are_not(spark, feed):
    folder, progress = feed(
        [(at("10:00"), "p", 1.0)], [(at("10:00") + 10 * ONE, "p", 2.0)], [(at("10:30"), "p", 5.0), (at("10:30") + 9 * ONE, "p", 7.0)],
    )
    repaired = rows(spark.read.parquet(f"{folder}/repairs"), "bucket", "sum_value")
    assert repaired == [(at("10:00"), 6.0)]
    assert rows(read_windows(spark, folder), "bucket", "sum_value") == [
        (at("10:00"), 6.0), (at("10:00") + 9 * ONE, 7.0), (at("10:00") + 10 * ONE, 2.0)
    ]
    # The state held one row past the bound that was dropped, and holds the hours of three days.
    state = [op for step in progress for op in step["stateOperators"]]
    assert sum(op["numRowsDroppedByWatermark"] for op in state) == 1
    assert state[-1]["numRowsTotal"] == 2


def test_state_does_not_grow_with_time(spark, feed):
    held = []
    for day in range(0, 40, 8):
        _, progress = feed([(at("00:00") + (day + d) * ONE + dt.timedelta(hours=h), "p", 1.0) for d in range(8) for h in range(24)])
        held.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 3 * 24 + 1


def test_a_batch_that_runs_again_changes_nothing(spark, readings, table, tmp_path):
    folder = str(tmp_path / "streams")
    write = ingest_batch(spark, table, folder, LATENESS["1h"])
    first, second = readings((at("10:00"), "p", 1.0)), readings((at("10:00"), "p", 9.0), (at("10:00") - 9 * ONE, "p", 2.0))
    for _ in range(2):
        write(first, 0)
    for _ in range(2):
        write(second, 1)
    assert rows(spark.table(table), "event_time", "value_double") == [(at("10:00") - 9 * ONE, 2.0), (at("10:00"), 1.0)]
    assert rows(spark.read.parquet(f"{folder}/accepted"), "value_double") == [(1.0,), (2.0,)]
    assert rows(spark.read.parquet(f"{folder}/repairs"), "sum_value") == [(2.0,)]


def test_a_batch_that_failed_between_keeping_and_appending(spark, readings, table, tmp_path, monkeypatch):
    from gridpulse.streaming import windows

    def failing(*_):
        raise OSError("lost")

    folder, real = str(tmp_path / "streams"), windows.append
    write = ingest_batch(spark, table, folder, LATENESS["1h"])
    monkeypatch.setattr(windows, "append", failing)
    with pytest.raises(OSError):
        write(readings((at("10:00"), "p", 1.0)), 0)
    monkeypatch.setattr(windows, "append", real)
    write(readings((at("10:00"), "p", 1.0)), 0)
    assert spark.table(table).count() == 1 and newest_time(spark, table) == at("10:00")


def test_a_batch_is_held_against_the_table_once(spark, readings, table, tmp_path, monkeypatch):
    from gridpulse.streaming import windows

    calls, real = [], windows.new_readings
    monkeypatch.setattr(windows, "new_readings", lambda *args: calls.append(1) or real(*args))
    write = ingest_batch(spark, table, str(tmp_path / "streams"), LATENESS["1h"])
    for batch_id, clock in enumerate(("10:00", "11:00", "10:00")):
        write(readings((at(clock), "p", 1.0 + batch_id), (at(clock), "p", 1.0 + batch_id)), batch_id)
    assert len(calls) == 3
    assert rows(spark.table(table), "event_time", "value_double") == [(at("10:00"), 1.0), (at("11:00"), 2.0)]
    write(readings((at("11:00"), "p", 2.0)), 1)
    assert len(calls) == 4 and spark.table(table).count() == 2


@pytest.mark.parametrize("minute", [0, 20])
def test_hours_that_end_at_the_bound_are_repaired(spark, readings, table, tmp_path, minute):
    newest = at("12:00") + 3 * ONE + dt.timedelta(minutes=minute)
    write = ingest_batch(spark, table, str(tmp_path / "streams"), LATENESS["1h"])
    write(readings((newest, "p", 1.0), *[(at(clock), "p", 2.0) for clock in ("10:59", "11:00", "11:59", "12:00", "12:30")]), 0)
    assert rows(spark.read.parquet(str(tmp_path / "streams/repairs")), "bucket", "n") == [(at("10:00"), 1), (at("11:00"), 2)]


def test_micro_batches_and_partitions_of_the_windows_follow_the_rows(spark, readings, table, tmp_path, monkeypatch):
    from gridpulse.streaming import windows

    folder, session = str(tmp_path / "streams"), spark.conf.get("spark.sql.shuffle.partitions")
    write, everything = ingest_batch(spark, table, folder, LATENESS["1h"]), []
    real = windows.new_readings
    monkeypatch.setattr(windows, "new_readings", lambda *args: real(*args).repartition(9))
    for batch_id in range(3):
        everything += (batch := [(at("00:00") + (5 * batch_id + i % 5) * ONE + dt.timedelta(minutes=i), f"p{i % 4}", float(i)) for i in range(90)])
        write(readings(*batch), batch_id)
    assert window_sizes(spark, folder, 3) == {"files": 9, "partitions": spark.sparkContext.defaultParallelism}
    assert window_sizes(spark, folder, 27)["files"] == 4
    monkeypatch.setattr(windows, "STATE_ROWS", 15)
    assert (sizes := window_sizes(spark, folder, 3)) == {"files": 9, "partitions": 6}
    query = start_windows(spark, table, folder, once=True, **sizes)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [90, 90, 90]
    assert {op["numShufflePartitions"] for p in progress for op in p["stateOperators"]} == {6}
    assert spark.conf.get("spark.sql.shuffle.partitions") == session
    same(spark, read_windows(spark, folder), rollup_1h(readings(*everything)))


def test_only_changed_days_are_built(spark, readings, tmp_path):
    log, database = str(tmp_path / "log"), run_database(spark, "test_days")
    hourly, daily = f"{database}.h", f"{database}.d"
    first = rollup_1h(readings(*[(at("10:00") + d * ONE, "p", 1.0 + d) for d in range(4)]))
    create_rollup(spark, hourly, first)
    create_rollup(spark, daily, rollup_1d(first).select(*ROLLUP_COLUMNS))
    batch_writer(log)(first.select(*ROLLUP_COLUMNS), 0)
    assert publish_days(spark, log, hourly, daily) == []
    publish(spark, log, hourly)
    assert len(publish_days(spark, log, hourly, daily)) == 4
    before = {r.d: r.path for r in tb.files(spark, daily).select(F.col("event_date").alias("d"), "path").collect()}
    late = rollup_1h(readings((at("13:00") + ONE, "p", 5.0), (at("13:00") + ONE, "q", 6.0)))
    batch_writer(log)(late.select(*ROLLUP_COLUMNS), 1)
    publish(spark, log, hourly)
    assert publish_days(spark, log, hourly, daily) == [(at("00:00") + ONE).date()]
    assert publish_days(spark, log, hourly, daily) == []
    after = {r.d: r.path for r in tb.files(spark, daily).select(F.col("event_date").alias("d"), "path").collect()}
    assert [d for d in before if before[d] != after[d]] == [(at("00:00") + ONE).date()]
    same(spark, spark.table(daily), rollup_1d(first.unionByName(late)).select(*ROLLUP_COLUMNS))


def test_rows_appended_while_a_partition_is_switched_stay(spark, readings, table, monkeypatch):
    """The append falls between the listing of the files and the switch of the partition."""
    day = tb.with_partition(readings(*[(at("10:00") + dt.timedelta(minutes=i), "p", 1.0) for i in range(10)]), "event_time")
    more = tb.with_partition(readings(*[(at("12:00") + dt.timedelta(minutes=i), "p", 2.0) for i in range(7)]), "event_time")
    tb.append(spark, table, day)
    before = tb.partition_files(spark, table, [at("00:00").date()])
    real, calls = tb.partition_files, []

    def listed(*args):
        found = real(*args)
        if not calls:
            calls.append(1)
            tb.append(spark, table, more)
        return found

    monkeypatch.setattr(tb, "partition_files", listed)
    assert tb.replace_partitions(spark, table, day, before) == ([at("00:00").date()], [])
    assert rows(spark.table(table), "value_double") == [(1.0,)] * 10 + [(2.0,)] * 7


def test_old_versions_go_by_age(spark, readings, table):
    day = tb.with_partition(readings(*[(at("10:00") + dt.timedelta(minutes=i), "p", 1.0) for i in range(10)]), "event_time")
    tb.append(spark, table, day)
    for _ in range(2):
        tb.replace_partitions(spark, table, day, tb.partition_files(spark, table, [at("00:00").date()]))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert tb.remove_versions(spark, table, now - ONE) == 0
    assert tb.remove_versions(spark, table, now + ONE) == 2
    assert tb.remove_versions(spark, table, now + ONE) == 0
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 10


def test_rows_without_a_key_are_not_taken(spark, readings, table):
    batch = readings((at("10:00"), "p", 1.0), (at("10:00"), None, 2.0), (None, "p", 3.0), (at("10:00"), "p", 4.0))
    for _ in range(2):
        tb.append(spark, table, new_readings(spark, table, batch))
        spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 1


def test_discard_tells_what_it_has_seen(spark):
    assert tb.discard(spark.range(50), F.count(F.lit(1)).alias("n"), F.max("id").alias("top")) == {"n": 50, "top": 49}
    assert tb.discard(spark.range(5)) == {}
