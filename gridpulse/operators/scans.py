"""Running values over time without gathering a whole key in one task.

A window partitioned by key alone sends a hot key to a single task. Here rows
are windowed inside (key, block), where a block is a bounded stretch of the
order, and what earlier blocks contribute is added from one small row per block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.session import checkpointed


@dataclass(frozen=True)
class Running:
    """The sum, max or last non-null `value` of the rows up to each row, or
    strictly before it when not `inclusive`."""

    out: str
    value: Column
    how: str
    inclusive: bool = True


def _fold(how: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "last": lambda x: F.last(x, ignorenulls=True)}[how](c)


def _combine(how: str, earlier: Column, here: Column) -> Column:
    if how == "sum":
        return F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))
    return F.greatest(here, earlier) if how == "max" else F.coalesce(here, earlier)


def running(
    df: DataFrame, keys: list[str], block: str, order: str, values: list[Running], descending: bool = False
) -> DataFrame:
    """Add one column per `Running`, over the rows of the same key in `order`.

    `block` must not decrease along `order`. Rows that tie in `order` are taken
    in any sequence, so callers give a total order or tie-free rows. `df` is read
    twice: once reduced to a row per block, once for the rows.
    """
    names = [f"_value{i}" for i in range(len(values))]
    df = df.withColumns({n: v.value for n, v in zip(names, values)})
    o = F.col(order)
    extreme = F.min_by if descending else F.max_by

    def reduce_block(name: str, how: str) -> Column:
        c = F.col(name)
        return extreme(c, F.when(c.isNotNull(), o)) if how == "last" else _fold(how, c)

    def toward(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    first = Window.unboundedPreceding
    totals = df.groupBy(*keys, block).agg(*[reduce_block(n, v.how).alias(n) for n, v in zip(names, values)])
    across = Window.partitionBy(*keys).orderBy(toward(block)).rowsBetween(first, -1)
    carry = totals.select(
        *keys, block, *[_fold(v.how, F.col(n)).over(across).alias(f"{n}_carry") for n, v in zip(names, values)]
    )
    inside = Window.partitionBy(*keys, block).orderBy(toward(order))
    out = {
        v.out: _combine(
            v.how,
            F.col(f"{n}_carry"),
            _fold(v.how, F.col(n)).over(inside.rowsBetween(first, 0 if v.inclusive else -1)),
        )
        for n, v in zip(names, values)
    }
    # Null-safe, so that rows without a key or a place in the order are rows like any other.
    at = [*keys, block]
    carry = carry.withColumnsRenamed({c: f"_at{i}" for i, c in enumerate(at)})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(at)])
    joined = df.join(carry, same).withColumns(out)
    return joined.drop(*names, *[f"{n}_carry" for n in names], *[f"_at{i}" for i in range(len(at))])


def in_stretches(df: DataFrame, keys: list[str], order: str, out: str) -> DataFrame:
    """`df` with the number of a stretch of rows that follow each other by keys and order.

    Stretches come from a range partitioning, so they hold about equally many rows
    whatever the type of `order` and however hot a key is; only rows that are equal in
    keys and order stay together. The rows are kept in the shared folder, because
    their numbers must not change.
    """
    return checkpointed(df.repartitionByRange(*keys, order).withColumn(out, F.spark_partition_id()))
