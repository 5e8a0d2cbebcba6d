"""Typed values, quality, units and labels as column expressions."""

from __future__ import annotations

import math
from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse.schemas import ENUMS

# Raw unit and rollup unit to multiplier. Any other pair means 1.
UNIT_FACTORS: dict[tuple[str, str], float] = {
    ("W", "kWh"): 0.001,
    ("W", "MWh"): 0.000001,
    ("kW", "Wh"): 1000.0,
    ("kW", "kWh"): 1.0,
    ("kW", "MWh"): 0.001,
    ("MW", "Wh"): 1000000.0,
    ("MW", "kWh"): 1000.0,
    ("Wh", "kWh"): 0.001,
    ("Wh", "MWh"): 0.000001,
    ("kWh", "Wh"): 1000.0,
    ("kWh", "MWh"): 0.001,
    ("MWh", "kWh"): 1000.0,
    ("Wh/m2", "kWh/m2"): 0.001,
}

# Statuses of a control request that is still in flight.
OPEN_STATUSES = ("queued", "accepted", "scheduled", "active")

# Qualities an aggregate can carry. Codes keep the aggregation buffers fixed
# width, which keeps the plan on HashAggregate with whole-stage codegen.
_AGG_QUALITY = ("online", "estimated", "offline")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reading_value(
    value_type: Column | str = "value_type",
    bigint: Column | str = "value_bigint",
    double: Column | str = "value_double",
    numeric: Column | str = "value_numeric",
) -> Column:
    """The value of the column the point's type declares; unknown type gives NULL."""
    kind = _col(value_type)
    return (
        F.when(kind == "int64", _col(bigint).cast("double"))
        .when(kind == "float64", _col(double))
        .when(kind == "numeric", _col(numeric).cast("double"))
    )


def any_value_of(
    bigint: Column | str = "value_bigint",
    double: Column | str = "value_double",
    numeric: Column | str = "value_numeric",
) -> Column:
    """Join-free value: whichever typed column is filled, double first."""
    return F.coalesce(_col(double), _col(bigint).cast("double"), _col(numeric).cast("double"))


def any_over(limit: float) -> Column:
    """Whether `any_value_of` exceeds `limit`.

    The comparisons on the typed columns come first, because scans can skip row
    groups by them; the last one decides.
    """
    low = Decimal(math.floor(limit * 10**6)) / 10**6
    typed = (
        (F.col("value_double") > F.lit(float(limit)))
        | (F.col("value_bigint") >= F.lit(math.floor(limit)).cast("bigint"))
        | (F.col("value_numeric") >= F.lit(low).cast("decimal(38,9)"))
    )
    return typed & (any_value_of() > limit)


def quality_to_aggregate(quality: Column | str = "data_quality") -> Column:
    """online and estimated stay; everything else, NULL included, is offline."""
    q = _col(quality)
    return F.when(q.isin("online", "estimated"), q).otherwise("offline")


def quality_code(quality: Column | str = "data_quality") -> Column:
    """`quality_to_aggregate` as a small integer, for aggregation buffers."""
    q = _col(quality)
    return (
        F.when(q == _AGG_QUALITY[0], F.lit(0)).when(q == _AGG_QUALITY[1], F.lit(1)).otherwise(F.lit(2))
    )


def quality_label(code: Column | str) -> Column:
    """Text of a `quality_code`; NULL stays NULL."""
    c = _col(code)
    return F.when(c == 0, _AGG_QUALITY[0]).when(c == 1, _AGG_QUALITY[1]).when(c == 2, _AGG_QUALITY[2])


def collapse_quality(low: Column | str, high: Column | str) -> Column:
    """One distinct quality gives that quality, several give `mixed`.

    `low`/`high` are min and max of `quality_code`, which replaces a distinct
    count and so needs no Expand and works in a stream.
    """
    return F.when(_col(low) == _col(high), quality_label(low)).otherwise("mixed")


def uom_conversion_factor(uom: Column | str, rollup_uom: Column | str) -> Column:
    """Multiplier from the raw unit to the rollup unit, 1 when not listed."""
    pairs = chain.from_iterable(
        (F.lit(f"{a}>{b}"), F.lit(factor)) for (a, b), factor in UNIT_FACTORS.items()
    )
    table = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(table, F.concat(_col(uom), F.lit(">"), _col(rollup_uom))), F.lit(1.0))


def pick_value(kind: str) -> Column:
    """The rollup column a value keyword names; an unknown keyword means the average."""
    column = {"min": "min_value", "max": "max_value", "sum": "sum_value", "last": "last_value"}
    return F.col(column.get(kind.lower(), "avg_value"))


def open_rank(status: Column | str = "status") -> Column:
    """1 for a request in flight, 9 otherwise."""
    return F.when(_col(status).isin(*OPEN_STATUSES), 1).otherwise(9)


def enum_ordinal(enum: str, label: Column | str) -> Column:
    """Declaration position of a label, so that sorting follows the enum order."""
    labels = F.array(*[F.lit(v) for v in ENUMS[enum]])
    return F.nullif(F.array_position(labels, _col(label)), F.lit(0).cast("long"))


def translate(value: Column | str, int_values: Column | str, display_values: Column | str) -> Column:
    """Label of an integer under a translation map; unlisted gives NULL."""
    at = F.array_position(_col(int_values), _col(value).cast("int")).cast("int")
    return F.when(at > 0, F.get(_col(display_values), at - 1))


def decode_bits(value: Column | str, int_values: Column | str, display_values: Column | str) -> Column:
    """Labels of the bits set in `value`, in map order."""
    pairs = F.arrays_zip(_col(int_values).alias("bit"), _col(display_values).alias("label"))
    hit = F.filter(
        pairs,
        lambda p: F.call_function("shiftright", _col(value).cast("long"), p["bit"]).bitwiseAND(
            F.lit(1).cast("long")
        )
        == 1,
    )
    return F.transform(hit, lambda p: p["label"])


def range_quality(value: Column | str, low: Column | str, high: Column | str, quality: Column | str) -> Column:
    """over_range / under_range for a value outside its engineering range."""
    v = _col(value)
    return (
        F.when(v > _col(high).cast("double"), "over_range")
        .when(v < _col(low).cast("double"), "under_range")
        .otherwise(_col(quality))
    )
