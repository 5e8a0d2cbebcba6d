"""Sources interleaved to target weights by Pfair scheduling.

Each source is cut into blocks of equal size. With weight w, block b (from 0) is
released at slot floor(b / w) and due before slot ceil((b + 1) / w); each slot goes to
the released block that is due first. Weights that add up to one make all deadlines
hold, so at any slot every source is within less than one block of its share.

The schedule is made from the exact weights, slot by slot until the last block has one, so the
distance from a share does not grow with the input or with the number of sources.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import floor, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import col, fresh, map_arrow, stored
from gridpulse.llm.ranges import parts_for

#: Slots of a period, where weights are to be rounded to whole slots of one.
PERIOD = 1024
#: Characters of a block, and documents of a chunk that one task puts in order.
BLOCK_CHARS, CHUNK = 1 << 20, 1024
#: Chunks of a source that one task adds up.
GROUP = 4096
#: Rows of a schedule written at once.
_ROWS = 10_000


def slots_per_period(weights: dict, period: int = PERIOD) -> dict:
    """Whole slots of each source of positive weight; they add up to the period.

    Shares of the period are rounded by largest remainder, ties by the source's name; a source whose
    share is below one slot gets one, and the others share what is left. With more
    sources than slots the period is doubled until they fit.
    """
    positive = {s: Fraction(w) for s, w in weights.items() if w > 0}
    if not positive:
        return {}
    while period < 2 * len(positive):
        period *= 2
    out, rest, left = {}, dict(positive), period
    while small := [s for s, w in rest.items() if w * left < sum(rest.values())]:
        out |= dict.fromkeys(small, 1)
        rest = {s: w for s, w in rest.items() if s not in out}
        left = period - len(out)
    total = sum(rest.values())
    exact = {s: w * left / total for s, w in rest.items()}
    out |= {s: floor(x) for s, x in exact.items()}
    by_rest = sorted(rest, key=lambda s: (floor(exact[s]) - exact[s], str(s)))
    for s in by_rest[: period - sum(out.values())]:
        out[s] += 1
    return out


def timeline(shares: dict) -> Iterator[tuple]:
    """(source, block, release, deadline) of each slot, without end: earliest deadline first among the released.

    Shares are whole numbers; a weight is a share by the sum of all.
    """
    total = sum(shares.values())
    # A source has one block waiting or ready: its next is due later, and is released when this one has gone or later.
    waiting = [(0, str(s), i, 0, s) for i, s in enumerate(shares)]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slot = 0
    while shares:
        while waiting and waiting[0][0] <= slot:
            release, name, i, b, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(b + 1) * total // shares[s]), name, i, b, release, s))
        due, name, i, b, release, s = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline was missed")
        yield s, b, release, due
        heapq.heappush(waiting, ((b + 1) * total // shares[s], name, i, b + 1, s))
        slot += 1


def schedule(slots: dict) -> list[tuple]:
    """(source, block) of each slot of one period."""
    return [(s, b) for s, b, _, _ in islice(timeline(slots), sum(slots.values()))]


def _places(docs: DataFrame, source_col: str, shares: dict, blocks: dict) -> DataFrame:
    """(s, k, release, deadline, slot) of the blocks that there are, as the timeline has them.

    One task writes them: it holds a block per source, the driver none. It goes through the slots
    up to the last of the blocks, as many as the largest number of blocks by weight.
    """
    names = list(shares)
    ends = {i: blocks.get(s, 0) for i, s in enumerate(names)}
    whole = {i: shares[s] for i, s in enumerate(names)}
    # Ties go by the names of the sources, so the numbers that stand for them are given in that order.
    order = {i: n for n, i in enumerate(sorted(whole, key=lambda i: str(names[i])))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not any([b.num_rows for b in batches]):
            return
        left, out = sum(ends.values()), []
        back = {_name(n): i for i, n in order.items()}
        for slot, (s, k, release, due) in enumerate(timeline({_name(order[i]): w for i, w in whole.items()}) if left else ()):
            if k < ends[i := back[s]]:
                out.append((i, k, release, due, slot))
                left -= 1
            if out and (len(out) == _ROWS or not left):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["n", "k", "release", "deadline", "slot"])
                out = []
            if not left:
                break

    spark = docs.sparkSession
    made = stored(map_arrow(spark.range(0, 1, 1, 1), run, "n long, k long, release long, deadline long, slot long"), "mix-slots")
    named = spark.createDataFrame(list(enumerate(names)), f"n long, s {docs.schema[source_col].dataType.simpleString()}")
    return made.join(named, "n").drop("n")


def _name(n: int) -> str:
    return f"{n:09d}"


def tempered(docs: DataFrame, size: Column, source_col: str = "source", power: float = 0.5) -> dict:
    """Target weights: each source's size to a power below one, which evens out large and small sources."""
    found = docs.groupBy(col(source_col).alias("source")).agg(F.sum(size).alias("size")).collect()
    return {r.source: float(r.size or 0) ** power for r in found}


def mixed(
    docs: DataFrame, weights: dict, size: Column, id_col: str = "doc_id", source_col: str = "source",
    block_size: int = BLOCK_CHARS, period: int | None = None,
) -> DataFrame:
    """(id, source, size, block, release, deadline, slot, place) of every row of `docs`.

    Rows sorted by (slot, place) are the mix; `place` is the size of what comes before in
    the block. A row is in the block in which it begins. Within its source a row's order is
    by a hash of its id, then by id and size; equal rows in either order. When a source
    runs out, its slots stay empty and the others keep their proportions. Null is a
    source like any other; sources without a positive weight get no slot (null) and
    come last. A size of null or less than 0 counts as 0; no rows give none.

    Weights are exact unless a `period` is given, to whose slots they are then rounded. `weights` is
    held by the driver; documents and slots are not. A source is cut into chunks by the hash, so a
    large one is ordered by many tasks.
    """
    if period is None:
        exact = {s: Fraction(w) for s, w in weights.items() if w > 0}
        parts = lcm(*(w.denominator for w in exact.values()))
        shares = {s: int(w * parts) for s, w in exact.items()}
    else:
        shares = slots_per_period(weights, period)
    rows = docs.select(
        col(id_col).alias("id"), col(source_col).alias("source"),
        F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"),
    )
    rows = stored(rows.withColumn("hash", F.xxhash64("id")), "mix")
    chunks = max(1, -(-rows.count() // CHUNK))
    rows = rows.withColumn("chunk", F.shiftrightunsigned("hash", 1) % chunks)
    sums = stored(
        rows.groupBy("source", "chunk").agg(F.sum("size").alias("total")).withColumn("of", F.expr(f"chunk div {GROUP}")), "mix-sums"
    )
    # What comes before a chunk: the groups before its own, and in that the chunks before it.
    earlier = Window.partitionBy("source").orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    grouped = sums.groupBy("source", "of").agg(F.sum("total").alias("total"))
    ahead = grouped.select(F.col("source").alias("g"), F.col("of").alias("o"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead"))
    before = Window.partitionBy("source", "of").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("inside", F.coalesce(F.sum("total").over(before), F.lit(0))).join(
        ahead, F.col("source").eqNullSafe(F.col("g")) & (F.col("of") == F.col("o"))
    ).select(F.col("source").alias("s"), F.col("chunk").alias("c"), (F.col("ahead") + F.col("inside")).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Every row has its chunk, so a left join gives the same rows; it keeps the rows, small as their file is, from the driver.
    begun = summed.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")), "left")
    begin = F.col("base") + F.col("inside")
    blocked = begun.select(
        "id", "source", "size", F.expr(f"(base + inside) div {block_size}").alias("block"), (begin % block_size).alias("place")
    )
    sizes = {r.source: r.total for r in sums.groupBy("source").agg(F.sum("total").alias("total")).collect()}
    # A row of size 0 may stand behind all that has a size, so the block that begins there counts.
    places = _places(docs, source_col, shares, {s: n // block_size + 1 for s, n in sizes.items()})
    return blocked.join(places, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("k")), "left").select(
        "id", "source", "size", "block", "release", "deadline", "slot", "place"
    )


def in_mix_order(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of `docs`, its rows in the order of the mix, range by range of slots.

    Rows that repeat an id take the first place of that id; rows without an id come last.
    """
    mark, slot, place = fresh(docs, "gp_id", "gp_slot", "gp_place")
    order = F.struct(F.coalesce("slot", F.lit((1 << 62) - 1)).alias(slot), F.col("place").alias(place))
    first = mix.filter("id is not null").groupBy(F.col("id").alias(mark)).agg(F.min(order).alias(slot))
    rows = docs.join(first, col(id_col) == F.col(mark), "left")
    keys = [F.col(slot).isNull(), F.col(slot), col(id_col)]
    return rows.repartitionByRange(parts_for(docs), *keys).sortWithinPartitions(*keys).select(*[col(c) for c in docs.columns])
