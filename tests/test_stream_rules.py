import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators.alarms import evaluate_rules
from gridpulse.streaming import sources
from gridpulse.streaming.rules import AlarmRule, instruction, read_rule_events, start_rules
from gridpulse.streaming.sources import files_per_batch, parquet_stream, write_batch

VALUES = "point_id string, event_time timestamp_ntz, value double"
DEFINITIONS = (
    "alarm_definition_id int, site_id string, raise_occurrence_limit int, raise_timeframe_s int, clear_occurrence_limit int, "
    "clear_timeframe_s int, raise_window_start_s int, clear_window_start_s int, raise_match_operator string, clear_match_operator string"
)
EXPRESSIONS = (
    "alarm_definition_id int, expression_id int, point_id string, role string, comparison_operator string, "
    "point_value decimal(38,9), group_number int, group_operator string, bit_position int"
)
COLUMNS = ["alarm_definition_id", "event_time", "event_condition"]
LATE = dt.timedelta(minutes=30)


@pytest.fixture
def rules(spark):
    from decimal import Decimal

    definitions = [
        (1, "s", 2, 600, 1, 0, None, None, "any", "any"),  # two hits within ten minutes
        (2, "s", 1, 0, 1, 0, None, None, "any", "any"),  # raise and clear sides
        (3, "s", 1, 0, 1, 0, None, None, "all", "any"),  # two points, two groups
        (4, "s", 1, 900, 2, 1200, 36000, None, "any", "any"),  # from ten o'clock; two hits clear
    ]
    expressions = [
        (1, 1, "p", "raise", ">", 5, 1, "any", None), (2, 1, "p", "raise", ">", 7, 1, "any", None), (2, 2, "p", "clear", "<=", 3, 1, "any", None),
        (3, 1, "p", "raise", ">", 4, 1, "all", None), (3, 2, "q", "raise", "<", 6, 1, "all", None), (3, 3, "q", "raise", "=", 1, 2, "any", 0),
        (4, 1, "q", "raise", ">=", 8, 1, "any", None), (4, 2, "p", "clear", "<", 5, 1, "any", None),
    ]
    expressions = [(*e[:5], Decimal(e[5]), *e[6:]) for e in expressions]
    return spark.createDataFrame(definitions, DEFINITIONS), spark.createDataFrame(expressions, EXPRESSIONS)


@pytest.fixture
def feed(spark, rules, tmp_path):
    """Streams batches, one query after the other from one checkpoint, so each of them is a restart."""
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "checkpoint"))

    def run(*batches):
        for batch in batches:
            spark.createDataFrame(batch, VALUES).coalesce(1).write.mode("append").parquet(src)
            stream = parquet_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
            query = start_rules(stream, *rules, out, checkpoint, lateness=LATE, once=True)
            query.awaitTermination()
        return read_rule_events(spark, out), query.recentProgress

    return run


def tick(hours):
    return [("tick", at("10:00") + dt.timedelta(hours=hours), None)]


def test_unordered_batches_and_restarts(spark, rules, feed):
    rng = random.Random(5)
    everything = [(rng.choice("pqr"), at("09:00") + dt.timedelta(seconds=37 * i), float(rng.randrange(10))) for i in range(300)]
    arrival = sorted(everything, key=lambda r: r[1] + dt.timedelta(minutes=rng.randrange(30)))
    got, _ = feed(*[arrival[i : i + 75] for i in range(0, 300, 75)], tick(50), tick(51))
    want = evaluate_rules(spark.createDataFrame(everything, VALUES), *rules)
    assert rows(got, *COLUMNS) == rows(want, *COLUMNS)
    assert {r.alarm_definition_id for r in got.select("alarm_definition_id").distinct().collect()} == {1, 2, 3, 4}


def test_nothing_is_said_before_the_watermark_has_passed_it(feed):
    got, _ = feed([("p", at("10:00"), 9.0), ("p", at("10:05"), 9.0)])
    assert got.count() == 0
    got, _ = feed([("p", at("10:40"), 1.0)], tick(0.9))
    assert (1, at("10:05"), "raise") in rows(got, *COLUMNS)


def test_late_readings_are_left_out_and_the_state_is_let_go(feed):
    got, progress = feed([("p", at("10:00"), 9.0)], tick(30), [("p", at("10:01"), 9.0)], tick(60))
    assert [r for r in rows(got, *COLUMNS) if r[0] == 1] == []
    assert [r for r in rows(got, *COLUMNS) if r[0] == 2] == [(2, at("10:00"), "raise")]
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) >= 0


def test_instruction():
    part = {"role": "raise", "group_number": 1, "group_operator": "all", "limit": 2, "match": "any"}
    two = [part, part | {"limit": 1}]
    assert [instruction(two, x) for x in ([2, 1], [1, 1], [2, 0])] == [True, False, False]
    clear = {"role": "clear", "group_number": 1, "group_operator": "any", "limit": 1, "match": "any"}
    assert [instruction([part, clear], x) for x in ([2, 1], [0, 1], [0, 0])] == [True, False, None]


class Store:
    """What a processor asks of its state, by name."""

    def __init__(self):
        self.calls, self.value, self.list = [], None, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name in ("getValueState", "getListState"):
                return self
            if name == "update":
                self.value = args[0]
            if name == "appendValue":
                self.list.append(args[0])
            return self.value if name == "get" else None

        return call


def test_a_batch_of_readings_costs_the_state_a_few_calls():
    from pyspark.sql import Row

    store, alarm = Store(), AlarmRule()
    alarm.init(store)
    for earliest, calls in ((1000, ["appendValue", "get", "update", "registerTimer"]), (2000, ["appendValue", "get"])):
        store.calls.clear()
        batch = [Row(rule="[{}]", part=0, at=earliest + i, hit=True) for i in range(50)]
        alarm.handleInputRows((1,), iter(batch), None)
        assert store.calls == calls
    assert store.value == ("[{}]", [0], False, 1000) and len(store.list) == 2


def test_micro_batches_of_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "FILE_ROWS", 20)
    src, counts, seen = str(tmp_path / "src"), [100, 60, 75], []
    files = files_per_batch(counts)
    for i, n in enumerate(counts):
        write_batch(spark.range(n).select(F.lit(i).alias("part"), "id"), src, files)
    stream = parquet_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=files)
    look = lambda batch, _: seen.append(batch.agg(F.min("part"), F.max("part"), F.count("id")).first())
    stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(look).start().awaitTermination()
    assert [tuple(r) for r in seen] == [(i, i, n) for i, n in enumerate(counts)]
    assert len(spark.read.parquet(src).inputFiles()) == 9
    assert files_per_batch([100, 0]) == files_per_batch([100, 30]) == 1
