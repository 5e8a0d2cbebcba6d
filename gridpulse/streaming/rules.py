"""Alarm rules on a stream of readings, by state and event-time timers per alarm.

Readings wait in the state of their alarm until the watermark has passed them, so they are
judged in the order of their times whatever order they arrive in, and each time is
judged once. What an alarm keeps is what the lateness bound and its time frames span.
"""

from __future__ import annotations

import datetime as dt
import heapq
import json
import struct
import sys
from collections.abc import Iterator
from itertools import chain, islice

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridpulse.functions.buckets import utc_timestamp
from gridpulse.operators.alarms import is_hit, rule_sides
from gridpulse.streaming.ingest import batch_writer

#: How late a reading may be.
LATENESS = dt.timedelta(hours=1)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a waiting row does at its time: a reading that is no hit, one that is, the end of an earlier hit.
MISS, HIT, END = 0, 1, 2
KINDS = 3
#: Waiting rows that are kept as one value.
PACKED = 10_000


# The workers need nothing but this module, so it travels with the processor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class AlarmRule(StatefulProcessor):
    """One alarm: the expressions of its rule, how many hits each has, whether it is raised, and when it is due next.

    Every call of the state costs a message to the store, so readings wait in packed stretches, and
    a timer is set only where none is due as early.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alarm = handle.getValueState("alarm", "rule string, levels array<int>, raised boolean, due long")
        self.waiting = handle.getListState("waiting", "events binary")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rule, first = None, None
        while some := list(islice(rows, PACKED)):
            self.waiting.appendValue((pack([(row.at, _code(row.part, HIT if row.hit else MISS)) for row in some]),))
            rule, earliest = some[0].rule, min(row.at for row in some)
            first = earliest if first is None else min(first, earliest)
        rule, levels, raised, due = self.alarm.get() or (rule, [0] * len(json.loads(rule)), False, None)
        if due is None or first < due:
            self.alarm.update((rule, levels, raised, first))
            self.handle.registerTimer(_timer(first))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        rule, levels, raised, due = self.alarm.get()
        if due is None or due > until:
            return
        parts, levels = json.loads(rule), list(levels)
        events, later = [], []
        for (packed,) in self.waiting.get():
            for event in unpack(packed):
                (events if event[0] <= until else later).append(event)
        heapq.heapify(events)
        while events and events[0][0] <= until:
            now = events[0][0]
            while events and events[0][0] == now:
                part, what = divmod(heapq.heappop(events)[1], KINDS)
                if seconds := parts[part]["seconds"]:
                    levels[part] += {MISS: 0, HIT: 1, END: -1}[what]
                    if what == HIT:
                        heapq.heappush(events, (now + round(seconds * 1_000_000), _code(part, END)))
                else:
                    levels[part] = what  # a hit lasts until the point's next reading
            said = instruction(parts, levels)
            if said is not None and said != raised:
                raised = said
                yield Row(alarm_definition_id=key[0], at=now, event_condition="raise" if raised else "clear")
        later += events
        due = min(later)[0] if later else None
        self.alarm.update((rule, levels, raised, due))
        if later:
            self.waiting.put([(pack(later[i : i + PACKED]),) for i in range(0, len(later), PACKED)])
            self.handle.registerTimer(_timer(due))
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def _code(part: int, what: int) -> int:
    """What happens to which expression; sorts by expression first."""
    return part * KINDS + what


def pack(events: list[tuple[int, int]]) -> bytes:
    """Times and codes as bytes."""
    return struct.pack(f"<{2 * len(events)}q", *chain.from_iterable(events))


def unpack(packed: bytes) -> Iterator[tuple[int, int]]:
    return struct.iter_unpack("<2q", packed)


def _timer(at: int) -> int:
    """The first millisecond that has passed a time in microseconds."""
    return -(-at // 1000)


def instruction(parts: list[dict], levels: list[int]) -> bool | None:
    """Whether the rule says to raise or to clear when its expressions have so many hits; None if neither."""
    groups: dict[tuple, list[bool]] = {}
    operators: dict[tuple, str] = {}
    for part, level in zip(parts, levels):
        key = (part["role"], part["group_number"])
        groups.setdefault(key, []).append(level >= part["limit"])
        operators[key] = max(operators.get(key, ""), part["group_operator"])
    sides: dict[str, list[bool]] = {}
    for key, holds in groups.items():
        sides.setdefault(key[0], []).append((all if operators[key] == "all" else any)(holds))
    match = {part["role"]: part["match"] for part in parts}
    on = {role: (all if match[role] == "all" else any)(holds) for role, holds in sides.items()}
    if on.get("raise", False):
        return True
    return False if on.get("clear", True) else None


def _rules(sides: DataFrame) -> DataFrame:
    """`sides` with the whole rule of the alarm as text, and the number of the expression in it (`part`).

    `quiet` says that a reading which is no hit changes nothing: hits end by themselves, and no expression holds without any.
    """
    of_rule = ["role", "group_number", "expression_id", "group_operator", "limit", "seconds", "match"]
    every = F.array_sort(F.collect_list(F.struct(*of_rule)))
    rules = sides.groupBy("alarm_definition_id").agg(every.alias("parts"))
    here = F.struct(*of_rule)
    joined = sides.join(rules.select("alarm_definition_id", "parts", F.to_json("parts").alias("rule")), "alarm_definition_id")
    quiet = (F.col("seconds") > 0) & F.forall("parts", lambda part: part["limit"] > 0)
    number = (F.array_position("parts", here) - 1).cast("int")
    return joined.withColumns({"part": number, "quiet": F.coalesce(quiet, F.lit(False))}).drop("parts")


def rule_events(
    readings: DataFrame, definitions: DataFrame, expressions: DataFrame, sites: DataFrame | None = None,
    lateness: dt.timedelta = LATENESS,
) -> DataFrame:
    """The stream of raise and clear times; what `evaluate_rules` gives for the readings that the watermark has passed.

    `readings` is a stream of point_id, event_time and value. Readings later than `lateness` are left
    out, and are for `evaluate_rules` over the stored ones. Any row with a point moves the clock, also
    that of a point which no rule watches. Definitions are read when the stream starts; a changed rule starts a stream anew.
    """
    kind = definitions.schema["alarm_definition_id"].dataType
    timed = readings.filter("event_time IS NOT NULL").withColumn("_clock", utc_timestamp(F.col("event_time")))
    timed = timed.withWatermark("_clock", f"{int(lateness.total_seconds())} seconds")
    rules = _rules(rule_sides(definitions, expressions, sites))
    seen = timed.select("_clock", "point_id", "event_time", "value").join(rules, "point_id")  # the clock is moved by all rows
    rows = seen.filter(is_hit() | ~F.col("quiet"))
    rows = rows.select("alarm_definition_id", "_clock", "part", F.unix_micros("_clock").alias("at"), is_hit().alias("hit"), "rule")
    out = T.StructType([
        T.StructField("alarm_definition_id", kind), T.StructField("at", T.LongType()), T.StructField("event_condition", T.StringType()),
    ])
    found = rows.groupBy("alarm_definition_id").transformWithState(AlarmRule(), out, "Append", "EventTime")
    return found.select("alarm_definition_id", _wall_clock("at").alias("event_time"), "event_condition")


def _wall_clock(micros: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {micros}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def start_rules(
    readings: DataFrame, definitions: DataFrame, expressions: DataFrame, path: str, checkpoint: str,
    sites: DataFrame | None = None, lateness: dt.timedelta = LATENESS, once: bool = False,
) -> StreamingQuery:
    """Log raise and clear events with one folder per micro-batch; started again it goes on where it ended."""
    spark = readings.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # the store that has timers and lists; a query keeps what was set when it started
    try:
        events = rule_events(readings, definitions, expressions, sites, lateness)
        writer = events.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
        writer = writer.trigger(availableNow=True) if once else writer
        return writer.foreachBatch(batch_writer(path)).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def read_rule_events(spark: SparkSession, path: str) -> DataFrame:
    """All events that a stream of rules has logged."""
    return spark.read.parquet(path).select("alarm_definition_id", "event_time", "event_condition")
