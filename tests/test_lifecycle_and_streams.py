import datetime as dt

import pytest

from helpers import at, rows
from gridpulse.operators.rollups import create_rollup, partitions, refresh_due, rollup_1h
from gridpulse.plans import lifecycle as lc
from gridpulse.plans import reports as rp
from gridpulse.schemas import DEFAULTS, SCHEMAS
from gridpulse.session import run_database
from gridpulse.sources import tables as tb
from gridpulse.streaming.ingest import batch_writer, start_readings
from gridpulse.streaming.rollups import publish, read_published, read_rollup
from gridpulse.streaming.sources import parquet_stream

NOW = at("00:00")
ONE = dt.timedelta(days=1)


@pytest.fixture
def stored(spark, readings):
    """A readings table with one day per given age; age is counted to the range end."""

    def build(*ages):
        db = run_database(spark, "test_jobs")
        df = readings(*[(NOW - (a + 1) * ONE + dt.timedelta(hours=h), p, float(h)) for a in ages for h in (3, 2, 1) for p in "ba"])
        tb.create_partitioned(spark, f"{db}.point_readings", tb.with_partition(df, "event_time"))
        lc.create_log(spark, f"{db}.compaction_logs", "compaction_logs")
        lc.create_log(spark, f"{db}.retention_logs", "retention_logs")
        return db, f"{db}.point_readings", f"{db}.compaction_logs", f"{db}.retention_logs"

    return build


def _date(age):
    return (NOW - (age + 1) * ONE).date()


def test_compaction_takes_old_partitions_only(spark, stored):
    _, table, log, _ = stored(6, 7, 8)
    before = rows(spark.table(table), "event_time", "point_id", "value_double")
    done = lc.compact_eligible(spark, [table], log, NOW)
    assert done == {table: [_date(8)]}
    assert rows(spark.table(table), "event_time", "point_id", "value_double") == before
    assert lc.compact_eligible(spark, [table], log, NOW) == {table: []}
    inv = lc.partition_inventory(spark, table, log)
    assert rows(inv, "partition_date", "state") == [(_date(8), "Compacted"), (_date(7), "Hot"), (_date(6), "Hot")]
    assert rows(lc.compaction_progress(inv), "partitions", "compacted", "hot", "pct_compacted") == [(3, 1, 2, 33.3)]
    sizes = lc.table_sizes(inv).first()
    assert sizes["total_bytes"] == sizes["hot_bytes"] + sizes["compacted_bytes"] > 0
    saved = lc.compaction_savings(spark.table(log)).first()
    assert saved["compacted"] == 1 and saved["before_bytes"] > 0


def test_compacted_files_are_clustered(spark, stored):
    _, table, log, _ = stored(20)
    lc.compact_eligible(spark, [table], log, NOW)
    paths = [r[0] for r in lc.files(spark, table).select("path").collect()]
    for path in paths:
        got = [(r["point_id"], r["event_time"]) for r in spark.read.parquet(path).collect()]
        assert got == sorted(got, key=lambda r: (r[0], -r[1].timestamp()))


def test_an_append_during_a_rewrite_is_not_lost(spark, stored, readings, monkeypatch):
    _, table, log, _ = stored(20, 21)
    real = tb.partition_files
    calls = []

    def interrupted(spark_, table_, dates):
        if calls == [1]:  # after the rows were written, before any partition is replaced
            row = (NOW - 21 * ONE + dt.timedelta(hours=9), "late", 9.0)
            tb.append(spark, table, tb.with_partition(readings(row), "event_time"))
        calls.append(1)
        return real(spark_, table_, dates)

    monkeypatch.setattr(tb, "partition_files", interrupted)
    monkeypatch.setattr(lc, "partition_files", interrupted)
    assert lc.compact_eligible(spark, [table], log, NOW) == {table: [_date(21)]}
    monkeypatch.undo()
    assert spark.table(table).count() == 13
    assert lc.compact_eligible(spark, [table], log, NOW) == {table: [_date(20)]}
    assert spark.table(table).count() == 13
    tb.append(spark, table, tb.with_partition(readings((NOW - 21 * ONE, "later", 1.0)), "event_time"))
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 14


def test_a_failure_before_the_swap_changes_nothing(spark, stored, monkeypatch):
    _, table, log, _ = stored(20)
    before = rows(spark.table(table), "event_time", "point_id", "value_double")
    calls = []

    def failing(spark_, table_, dates, real=tb.partition_files):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("gone")
        return real(spark_, table_, dates)

    monkeypatch.setattr(tb, "partition_files", failing)
    monkeypatch.setattr(lc, "partition_files", failing)
    with pytest.raises(OSError):
        lc.compact_eligible(spark, [table], log, NOW)
    monkeypatch.undo()
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table), "event_time", "point_id", "value_double") == before
    assert spark.table(log).count() == 0


def test_a_partition_without_files_is_skipped(spark, stored):
    _, table, log, _ = stored(20)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (event_date='2023-01-01')")
    assert lc.compact_eligible(spark, [table], log, NOW) == {table: [_date(20)]}
    assert spark.table(table).count() == 6


def test_refresh_stays_within_retention(spark, stored):
    db, table, *_ = stored(1)
    create_rollup(spark, f"{db}.readings_1h", rollup_1h(spark.table(table)))
    with pytest.raises(ValueError):
        refresh_due(spark, f"{db}.readings_1h", spark.table(table), NOW, "1h", retention_days=2)


def test_uncompact(spark, stored):
    _, table, log, _ = stored(8, 9)
    lc.compact_eligible(spark, [table], log, NOW)
    assert lc.uncompact_partitions(spark, table, log, NOW + ONE, [_date(9)]) == [_date(9)]
    assert {r[0] for r in lc.compacted_dates(spark, log, table).collect()} == {_date(8)}
    assert lc.uncompact_partitions(spark, table, log, NOW + ONE) == [_date(8)]
    assert spark.table(table).count() == 12


def test_retention_drops_whole_partitions_and_logs(spark, stored):
    db, table, _, log = stored(40, 45, 46, 50)
    settings = spark.createDataFrame(
        [("point_readings", 45, NOW), ("control_requests", 10, NOW), ("nonsense", 1, NOW)], SCHEMAS["retention_settings"]
    )
    assert lc.enforce_retention(spark, db, settings, log, NOW) == (3, 2)
    assert partitions(spark, table) == [_date(40)]
    assert spark.table(table).count() == 6
    assert rows(spark.table(log), "table_name", "deleted_chunks", "status") == [
        ("ALL", 3, "completed (2 failures)"), ("control_requests", 0, "failed"), ("nonsense", 0, "failed"),
        ("point_readings", 3, "success"),
    ]
    assert lc.enforce_retention(spark, db, settings.filter("table_name = 'point_readings'"), log, NOW + dt.timedelta(hours=1)) == (0, 0)
    stats = {r["table_name"]: r for r in lc.run_statistics(spark.table(log)).collect()}
    assert (stats["point_readings"]["total_runs"], stats["point_readings"]["last_status"]) == (2, "no_chunks_eligible")
    assert (stats["nonsense"]["total_failures"], stats["nonsense"]["last_success"]) == (1, None)
    assert rows(lc.recent_errors(spark.table(log), 50), "table_name") == [("control_requests",), ("nonsense",)]
    assert rows(lc.latest_runs(spark.table(log)), "table_name", "status")[-1] == ("point_readings", "no_chunks_eligible")


def test_dropped_partitions_leave_no_files(spark, stored):
    db, table, _, log = stored(40, 50)
    settings = spark.createDataFrame([("point_readings", 45, NOW)], SCHEMAS["retention_settings"])
    lc.enforce_retention(spark, db, settings, log, NOW)
    assert rows(lc.files(spark, table).select("event_date").distinct(), "event_date") == [(_date(40),)]


def test_inventory_of_an_emptied_table(spark, stored):
    db, table, compaction, log = stored(50)
    settings = spark.createDataFrame([("point_readings", 45, NOW)], SCHEMAS["retention_settings"])
    assert lc.enforce_retention(spark, db, settings, log, NOW) == (1, 0)
    assert lc.partition_inventory(spark, table, compaction).count() == 0


def test_retention_defaults_and_job_entry(spark, stored):
    db, table, _, log = stored(50)
    settings = lc.seed_retention(spark, spark.createDataFrame([("point_readings", 9, NOW)], SCHEMAS["retention_settings"]), NOW)
    assert dict(rows(settings, "table_name", "retention_days")) == {
        "alarm_events": 90, "control_requests": 180, "control_requests_history": 90, "point_readings": 9
    }
    settings.filter("table_name = 'point_readings'").write.saveAsTable(f"{db}.retention_settings")
    config = {"database": db, "settings_table": f"{db}.retention_settings", "log_table": log, "now": NOW.isoformat()}
    assert lc.retention_job(spark, 1, config) == (1, 0)


def test_rollup_survives_retention(spark, stored):
    db, table, _, log = stored(10, 50)
    daily = spark.createDataFrame(rollup_1h(spark.table(table)).collect(), rollup_1h(spark.table(table)).schema)
    lc.enforce_retention(spark, db, spark.createDataFrame([("point_readings", 45, NOW)], SCHEMAS["retention_settings"]), log, NOW)
    out = rp.rows_available({"raw": (spark.table(table), "event_time"), "rollup": (daily, "bucket")}, NOW - 60 * ONE, NOW - 45 * ONE)
    assert dict(rows(out, "source", "rows_available")) == {"raw": 0, "rollup": 6}


def test_statistics_and_settings(spark, stored):
    db, *_ = stored(1)
    assert lc.analyze_all(spark, db, scan=True) == ["compaction_logs", "point_readings", "retention_logs"]
    got = dict((r[0], r[1:]) for r in rows(lc.clustering_settings(spark), "table_name", "segment_by", "order_by"))
    assert got["point_readings"] == ("point_id", "event_time DESC")


def test_append_and_rebuild(spark, stored, readings):
    _, table, *_ = stored(1)
    tb.append(spark, table, tb.with_partition(readings((NOW, "z", 1.0)), "event_time"))
    assert spark.table(table).count() == 7
    fresh = tb.with_partition(readings((NOW, "z", 1.0)), "event_time")
    tb.create_partitioned(spark, table, fresh)
    assert spark.table(table).count() == 1


def test_seven_day_partitions(spark, readings):
    df = tb.with_partition(readings((dt.datetime(2024, 1, 3), "p", 1.0)), "event_time", 7)
    assert rows(df, "event_date") == [(dt.date(2024, 1, 1),)]


def test_defaults_and_schema(spark, tmp_path):
    df = tb.with_defaults(spark.createDataFrame([("p",)], "point_id string"), "points")
    assert df.schema.names == SCHEMAS["points"].names
    assert rows(df, "is_derived", "is_analog") == [(False, True)]
    assert set(DEFAULTS) <= set(SCHEMAS)
    path = str(tmp_path / "t")
    df.write.parquet(path)
    assert tb.read_table(spark, "points", path).schema == SCHEMAS["points"]


def test_config(spark):
    config = tb.values(spark, "key string, value string", [("days", "60"), ("rate", "1.5"), ("step", "5 minutes")])
    assert tb.config_value(config, "days", "int") == 60
    assert tb.config_value(config, "rate", "float") == 1.5
    assert tb.config_value(config, "step", "interval").seconds == 300
    assert tb.config_value(config, "none") is None


# -- streams -----------------------------------------------------------------


def _batches(readings, path, *batches):
    for batch in batches:
        readings(*batch).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def ingest(spark, readings, tmp_path):
    """Streams batches of rows into a table and its change log, a trigger per batch."""
    table = f"{run_database(spark, 'test_ingest')}.point_readings"
    tb.create_partitioned(spark, table, tb.with_partition(readings((at("10:00"), "p", 1.0)).limit(0), "event_time"))
    src, log, ck = (str(tmp_path / n) for n in ("src", "log", "ck"))

    def run(*batches):
        for batch in batches:
            _batches(readings, src, batch)
            stream = parquet_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
            start_readings(stream, table, ck, once=True, log=log).awaitTermination()
        spark.catalog.refreshTable(table)
        return table, log

    return run


def test_stream_equals_batch_over_several_triggers(spark, readings, ingest):
    everything = [(at("00:00") + dt.timedelta(minutes=7 * i), "pq"[i % 2], float(i), ["online", "error"][i % 3 == 0]) for i in range(300)]
    _, out = ingest(everything[0::3], everything[1::3], everything[2::3])
    assert rows(read_rollup(spark, out), *read_rollup(spark, out).columns) == rows(
        rollup_1h(readings(*everything)), *read_rollup(spark, out).columns
    )


def test_stream_ignores_repeats_and_heartbeats(spark, ingest):
    _, out = ingest([(at("10:00"), "p", 1.0), (at("10:05"), "p", 9.0, "online", "heartbeat")], [(at("10:00"), "p", 1.0)])
    assert rows(read_rollup(spark, out), "n", "sum_value") == [(1, 1.0)]


def test_readings_of_any_age_are_kept(spark, ingest):
    """Later files hold readings 17 and 18 days older; all land, and their hours are rolled up."""
    batches = [[(at("10:00") - d * ONE + dt.timedelta(minutes=i), "p", 1.0) for i in range(3)] for d in (0, 17, 18, 17)]
    table, out = ingest(*batches)
    assert spark.table(table).count() == 9
    assert rows(read_rollup(spark, out), "bucket", "n") == [(at("10:00") - 18 * ONE, 3), (at("10:00") - 17 * ONE, 3), (at("10:00"), 3)]


def test_a_late_row_repairs_its_hour(spark, ingest):
    _, out = ingest([(at("10:00"), "p", 1.0)], [(at("10:00") + 10 * ONE, "p", 2.0)], [(at("10:30"), "p", 5.0)])
    assert rows(read_rollup(spark, out), "bucket", "sum_value") == [(at("10:00"), 6.0), (at("10:00") + 10 * ONE, 2.0)]


def test_replayed_batch_counts_once(spark, readings, tmp_path):
    out = str(tmp_path / "out")
    hourly = rollup_1h(readings((at("10:00"), "p", 1.0)))
    for batch_id in (0, 0, 1):
        batch_writer(out)(hourly, batch_id)
    assert rows(read_rollup(spark, out), "n") == [(1,)]


def test_streamed_readings_land_once(spark, ingest):
    table, _ = ingest([(at("10:00"), "p", 1.0)], [(at("10:00"), "p", 2.0), (at("11:00"), "p", 3.0)])
    assert rows(spark.table(table), "event_time", "event_date", "value_double") == [
        (at("10:00"), dt.date(2024, 1, 5), 1.0), (at("11:00"), dt.date(2024, 1, 5), 3.0)
    ]


def test_publishing_the_log(spark, readings, tmp_path):
    out = str(tmp_path / "out")
    table = f"{run_database(spark, 'test_publish')}.readings_1h"
    versions = [
        readings((at("10:00"), "p", 1.0), (at("10:00"), "q", 1.0), (at("10:00") + ONE, "p", 1.0)),
        readings((at("10:00"), "p", 2.0)),
        readings((at("10:00"), "p", 3.0), (at("11:00"), "p", 3.0)),
    ]
    create_rollup(spark, table, rollup_1h(versions[0]))
    want = [(at("10:00"), "p", 3.0), (at("10:00"), "q", 1.0), (at("10:00") + ONE, "p", 1.0), (at("11:00"), "p", 3.0)]
    for i, df in enumerate(versions):
        batch_writer(out)(rollup_1h(df), i)
        if i == 1:
            assert publish(spark, out, table) == 1
            assert publish(spark, out, table) == 1
            assert rows(spark.table(table), "bucket", "point_id", "sum_value")[0] == (at("10:00"), "p", 2.0)
    assert rows(read_published(spark, out, table), "bucket", "point_id", "sum_value") == sorted(want)
    assert publish(spark, out, table) == 2
    assert rows(spark.table(table), "bucket", "point_id", "sum_value") == sorted(want)
    assert rows(read_published(spark, out, table), "bucket", "point_id", "sum_value") == sorted(want)
