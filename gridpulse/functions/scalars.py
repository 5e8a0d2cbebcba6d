"""Small scalar helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024 ** 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(value: Column | str, digits: int) -> Column:
    """Round as an exact decimal would, ties away from zero, returned as double."""
    return F.round(_col(value).cast("decimal(38,9)"), digits).cast("double")


def to_int(value: Column | str) -> Column:
    """Integer by rounding half to even, the rule for a double; Spark's cast truncates."""
    return F.bround(_col(value), 0).cast("int")


def safe_divide(top: Column | str, bottom: Column | str) -> Column:
    """NULL instead of an error for a zero divisor."""
    return _col(top) / F.nullif(_col(bottom), F.lit(0))


def gib(size: Column | str) -> Column:
    return F.round(_col(size) / F.lit(GIB), 3)


def percent_saved(before: Column | str, after: Column | str) -> Column:
    return F.round(100.0 * (1 - safe_divide(_col(after).cast("double"), before)), 1)


def ratio(before: Column | str, after: Column | str) -> Column:
    return F.round(safe_divide(_col(before).cast("double"), after), 1)


def percent(part: Column, whole: Column) -> Column:
    return F.round(safe_divide(100.0 * part, whole), 1)


def squeeze(text: Column | str, length: int | None) -> Column:
    """Runs of white space become one blank; then the first `length` characters, None for all."""
    whole = F.regexp_replace(_col(text), r"\s+", " ")
    return whole if length is None else F.left(whole, F.lit(length))


def json_text(doc: Column | str, key: str) -> Column:
    return F.get_json_object(_col(doc), f"$.{key}")


def element(array: Column | str, position: int) -> Column:
    """1-based array element, NULL when out of range."""
    return F.get(_col(array), F.lit(position - 1))


def is_not_true(flag: Column | str) -> Column:
    return ~F.coalesce(_col(flag), F.lit(False))


def stable_id(*parts: Column | str) -> Column:
    """Identity derived from a natural key, so a retried task gives the same id."""
    text = [F.coalesce(_col(p).cast("string"), F.lit("\u0000")) for p in parts]
    return F.sha2(F.concat_ws("\u0001", *text), 256)


def sampled(key: Column | str, fraction: float, seed: int = 42) -> Column:
    """Row sampling that does not change when a task is retried or the plan moves."""
    digest = F.md5(F.concat_ws(":", _col(key).cast("string"), F.lit(str(seed))))
    # The first 15 digits are a number below 2 ** 60.
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint") < F.lit(round(fraction * (1 << 60)))


def number_text(value: Column | str, digits: int) -> Column:
    """A number as text with so many decimals and no grouping."""
    return F.format_string(f"%.{digits}f", round_half_away(value, digits))


def between_hours(hours: Column, steps: list[tuple[float, float, Column]], default: Column) -> Column:
    """Piecewise curve: the expression of the half-open hour range holding `hours`."""
    branches = [((hours >= low) & (hours < high), expr) for low, high, expr in steps]
    out = F.when(*branches[0])
    for condition, expr in branches[1:]:
        out = out.when(condition, expr)
    return out.otherwise(default)
