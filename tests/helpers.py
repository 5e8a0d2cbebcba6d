"""Times, rows and schemas that the tests share."""

import datetime as dt

DAY = dt.datetime(2024, 1, 5)


def at(clock: str, day: dt.datetime = DAY) -> dt.datetime:
    """A time of 2024-01-05, from `HH:MM` or `HH:MM:SS`."""
    parts = [int(x) for x in clock.split(":")]
    return day + dt.timedelta(hours=parts[0], minutes=parts[1], seconds=parts[2] if len(parts) > 2 else 0)


READINGS = (
    "event_time timestamp_ntz, point_id string, reading_type string, value_bigint bigint, "
    "value_double double, value_numeric decimal(38,9), data_quality string"
)
POINTS = "point_id string, site_id string, name string, value_type string, uom string, rollup_uom string"


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(picked, key=lambda r: [(v is not None, v) for v in r])
