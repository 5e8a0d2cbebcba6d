"""Time buckets on `timestamp_ntz` columns that hold UTC wall clock.

Fixed widths use Spark's `window`, which is plain integer arithmetic inside
codegen and the same expression in batch and in a stream. Calendar widths use
date arithmetic. A time zone only shifts the clock before and after; shifting
back is done on grouped rows, not on readings.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z")
# Origins of fixed-width buckets (a Monday) and of `date_bin`.
WEEK_ORIGIN = dt.datetime(2000, 1, 3)
BIN_ORIGIN = dt.datetime(2000, 1, 1)
_EPOCH = dt.datetime(1970, 1, 1)
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
# The sample keywords a history request may use.
SAMPLE_TIMES = {
    "5min": "5 minutes",
    "15min": "15 minutes",
    "hour": "1 hour",
    "day": "1 day",
    "month": "1 month",
}


@dataclass(frozen=True)
class Bucket:
    """A bucket width: whole seconds, or whole months."""

    seconds: int = 0
    months: int = 0

    @staticmethod
    def of(width: "Bucket | str | dt.timedelta") -> "Bucket":
        if isinstance(width, Bucket):
            return width
        if isinstance(width, dt.timedelta):
            seconds = width.total_seconds()
            if seconds <= 0 or seconds != int(seconds):
                raise ValueError(f"bucket must be whole positive seconds, got {width}")
            return Bucket(seconds=int(seconds))
        match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
        if not match or int(match[1]) == 0:
            raise ValueError(f"cannot read bucket width {width!r}")
        count, unit = int(match[1]), match[2]
        if unit == "month":
            return Bucket(months=count)
        if unit == "year":
            return Bucket(months=12 * count)
        if unit not in _UNIT_SECONDS:
            raise ValueError(f"cannot read bucket width {width!r}")
        return Bucket(seconds=count * _UNIT_SECONDS[unit])

    @property
    def nominal_hours(self) -> float:
        """Length used for energy: a month is 30 days, a day always 24 h."""
        return self.months * 720.0 if self.months else self.seconds / 3600.0

    @property
    def step(self) -> Column:
        """The width as a Spark interval."""
        if self.months:
            return F.make_ym_interval(F.lit(0), F.lit(self.months))
        return F.expr(f"INTERVAL '{self.seconds}' SECOND")


def sample_bucket(keyword: str) -> Bucket:
    """Bucket of a sample keyword, any case."""
    width = SAMPLE_TIMES.get(keyword.lower())
    if width is None:
        raise ValueError(f"unknown sample time {keyword!r}; use one of {', '.join(SAMPLE_TIMES)}")
    return Bucket.of(width)


def instant(t: dt.datetime) -> Column:
    """A literal UTC time. Written as text, because a datetime literal would be
    read in the session's time zone."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def is_utc(tz: Column | str | None) -> bool:
    return tz is None or (isinstance(tz, str) and tz in UTC_NAMES)


def _zone(tz: Column | str) -> Column:
    return F.lit(tz) if isinstance(tz, str) else tz


def to_local(t: Column, tz: Column | str | None) -> Column:
    """Wall clock in `tz` of a UTC time."""
    return t if is_utc(tz) else F.convert_timezone(F.lit("UTC"), _zone(tz), t)


def to_utc(local: Column, tz: Column | str | None) -> Column:
    """UTC time of a wall clock. A wall clock that occurs twice means the later
    one (standard time); one that is skipped moves forward by the gap.

    The offset a day later is tried beside the one in force before a change, so a
    change of any size is resolved.
    """
    if is_utc(tz):
        return local
    zone = _zone(tz)
    day = F.expr("INTERVAL '1' DAY")
    first = F.convert_timezone(zone, F.lit("UTC"), local)
    after = F.convert_timezone(F.lit("UTC"), zone, first + day) - (first + day)
    later = local - after
    shown = F.convert_timezone(F.lit("UTC"), zone, later) == local
    return F.when(shown & (later > first), later).otherwise(first)


def bucket_of(t: Column, width: Bucket | str, origin: dt.datetime = WEEK_ORIGIN) -> Column:
    """Start of the bucket holding `t`, on the clock `t` is given in.

    At most one fixed-width bucket may be computed per `select`.
    """
    b = Bucket.of(width)
    if b.months == 1:
        return F.trunc(F.to_date(t), "month").cast("timestamp_ntz")
    if b.months:
        months = (F.year(t) - 2000) * 12 + F.month(t) - 1
        first = F.make_date(F.lit(2000), F.lit(1), F.lit(1))
        return F.add_months(first, (months - F.pmod(months, F.lit(b.months))).cast("int")).cast("timestamp_ntz")
    if b == Bucket(seconds=86400) and origin.time() == dt.time():
        return F.to_date(t).cast("timestamp_ntz")
    offset = int((origin - _EPOCH).total_seconds()) % b.seconds
    size = f"{b.seconds} seconds"
    return F.window(t, size, size, f"{offset} seconds").start


def date_bin(t: Column, width: Bucket | str, origin: dt.datetime = BIN_ORIGIN) -> Column:
    """Fixed-width floor counted from `origin`, also for times before it."""
    b = Bucket.of(width)
    if b.months:
        raise ValueError("date_bin takes fixed widths only")
    return bucket_of(t, b, origin)


def local_hours(t: Column, tz: Column | str | None) -> Column:
    """Hours since local midnight, with fraction."""
    local = to_local(t, tz)
    return F.hour(local) + F.minute(local) / 60.0 + F.date_part(F.lit("SECOND"), local).cast("double") / 3600.0


def local_day(t: Column, tz: Column | str | None) -> Column:
    return F.to_date(to_local(t, tz))


def at_local_time(day: Column, clock: dt.time, tz: Column | str | None) -> Column:
    """UTC time at which a site's clock shows `clock` on `day`."""
    seconds = clock.hour * 3600 + clock.minute * 60 + clock.second
    return to_utc(day.cast("timestamp_ntz") + F.expr(f"INTERVAL '{seconds}' SECOND"), tz)


def floor_to(t: dt.datetime, width: Bucket | str) -> dt.datetime:
    """Driver-side bucket start, for the bounds of a job."""
    b = Bucket.of(width)
    if b.months:
        months = (t.year - 2000) * 12 + t.month - 1
        months -= months % b.months
        return dt.datetime(2000 + months // 12, months % 12 + 1, 1)
    return t - (t - WEEK_ORIGIN) % dt.timedelta(seconds=b.seconds)


def ceil_to(t: dt.datetime, width: Bucket | str) -> dt.datetime:
    b = Bucket.of(width)
    low = floor_to(t, b)
    if low == t:
        return t
    if b.months:
        return floor_to(low + dt.timedelta(days=31 * b.months + 1), b)
    return low + dt.timedelta(seconds=b.seconds)


def utc_timestamp(t: Column) -> Column:
    """The instant of a UTC wall clock, in any session time zone; streams keep their watermark on it."""
    return F.make_timestamp_ltz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.extract(F.lit("SECOND"), t), F.lit("UTC")
    )
