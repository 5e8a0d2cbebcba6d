"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query runs into the noop sink: one warm-up, then the median of three.
Queries on stored tables have the tables built once, outside the timing.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridpulse.checks import merges, registry  # noqa: E402
from gridpulse.checks.jobs import stored_readings  # noqa: E402
from gridpulse.checks.rollups import materialised  # noqa: E402
from gridpulse.operators import rollups as tables  # noqa: E402
from gridpulse.operators.alarms import threshold_crossings  # noqa: E402
from gridpulse.operators.gapfill import readings_gapfilled  # noqa: E402
from gridpulse.operators.outages import data_gaps, silence  # noqa: E402
from gridpulse.operators.rollup import point_history, power_to_energy, readings_rollup  # noqa: E402
from gridpulse.plans import lifecycle, reports  # noqa: E402
from gridpulse.session import get_session  # noqa: E402
from gridpulse.sources.adapters import Plant  # noqa: E402
from gridpulse.sources.tables import discard  # noqa: E402

RUNS = 3
#: Timed once after the warm-up, as they write tables.
JOBS = {"refresh_window", "uncompacted_readings", "stream_rollup_1h"}


def headline(p: Plant) -> dict:
    """Name to a function that builds the plan anew."""
    checks = registry.queries()
    start, end = p.span
    day = dt.timedelta(days=1)
    _, arrival, log = stored_readings(p, "bench_arrival")
    _, compact, log2 = stored_readings(p, "bench_compact")
    lifecycle.compact_eligible(p.spark, [compact], log2, p.now, older_than=dt.timedelta(0))
    hourly, daily = materialised(p, p.now - day, daily=True)
    table = p.spark.table
    window = (end - 3 * day, end - 2 * day)
    one_point = reports.first_point(p.points).first()[0]

    def one_point_day(name: str):
        rows = table(name).filter(f"point_id = {one_point}")
        return lambda: reports.point_day_stats(rows, end - 12 * day, end - 11 * day)

    return {
        "rollup_hour": lambda: readings_rollup(p.readings, p.points, bucket="1 hour"),
        "gapfill_hour": lambda: readings_gapfilled(p.readings, p.points, start, end, "1 hour"),
        "energy_day": lambda: power_to_energy(p.readings, p.points, bucket="1 day"),
        "history_energy_day": lambda: point_history(p.readings, p.points, p.sites, "day", start, end, "energy"),
        "rollup_1h": lambda: tables.rollup_1h(p.readings),
        "rollup_1d": lambda: tables.rollup_1d(tables.rollup_1h(p.readings)),
        "daily_report_raw": lambda: reports.daily_report_raw(p.readings),
        "daily_report_1h_table": lambda: reports.daily_report_hourly(table(hourly)),
        "daily_report_1d_table": lambda: reports.daily_report_rollup(table(daily)),
        "realtime_1h": lambda: tables.read_1h(p.spark, hourly, table(arrival)),
        "point_day_arrival": one_point_day(arrival),
        "point_day_compacted": one_point_day(compact),
        "count_over_arrival": lambda: reports.count_over(table(arrival), 240.0, *window),
        "count_over_compacted": lambda: reports.count_over(table(compact), 240.0, *window),
        "control_queue": lambda: merges._queue(p),
        "outage_silence": lambda: silence(p.readings, p.outages),
        "threshold_crossings": lambda: threshold_crossings(p.readings, 78.0),
        "data_gaps": lambda: data_gaps(p.readings, 300, end),
        "quality_sweep": lambda: reports.quality_sweep(p.readings),
        "daily_energy": lambda: reports.daily_energy(p.readings, p.points, p.sites, start, end),
        # Jobs: what is timed includes what they write.
        "rule_raise_clear": lambda: checks["rule_raise_clear"](p.spark, p.sf_dir),
        "rule_debounced": lambda: checks["rule_debounced"](p.spark, p.sf_dir),
        "device_tree": lambda: checks["device_tree"](p.spark, p.sf_dir),
        "lww_outcome": lambda: checks["lww_outcome"](p.spark, p.sf_dir),
        "control_submit": lambda: checks["control_submit"](p.spark, p.sf_dir),
        "refresh_window": lambda: checks["refresh_window"](p.spark, p.sf_dir),
        "uncompacted_readings": lambda: checks["uncompacted_readings"](p.spark, p.sf_dir),
        "stream_rollup_1h": lambda: checks["stream_rollup_1h"](p.spark, p.sf_dir),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, build in headline(Plant(spark, folder)).items():
        seconds = []
        for _ in range(2 if name in JOBS else RUNS + 1):
            began = time.perf_counter()
            discard(build())
            seconds.append(time.perf_counter() - began)
        times[name] = round(statistics.median(seconds[1:]), 4)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 4), "unit": "sec",
        "queries": times, "sf": float(scale[1]) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
