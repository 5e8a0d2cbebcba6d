"""Documents packed into sequences of a fixed number of tokens, by sums of squares.

A piece goes where the sum over all gaps of the squared number of open sequences with
that gap becomes smallest, so the gaps stay varied and later pieces find one that fits.
Pieces are placed longest first, and a sequence is opened only if none has room, as the
last open sequences are what such a packing wastes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.common import col, fresh, map_arrow, stored
from gridpulse.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 0
#: Pieces that one task packs; each such share wastes less than a few sequences.
SHARE = 200_000
#: Where the input has an order, pieces that follow each other in it and are packed among themselves.
RUN = 4096
#: Positions that are counted together when runs are cut.
_STEP = 64
_TEXTS = 256


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE_TOKENS,
    stretch: Column | None = None, position: Column | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token ids of every document, cut where longer than `length`.

    A document is its text's ids (null: none) and the end id. The first piece of a
    longer one takes what is left over, the others are full. `stretch` adds a column
    of that name, a text that says to which part of the input a document belongs, and
    `position` one with its place (a long from 0) within that part.
    """
    kept = _PIECES if stretch is None else _PIECES.append(pa.field("stretch", pa.string()))
    kept = kept if position is None else kept.append(pa.field("position", pa.int64()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                some = batch.slice(at, _TEXTS)
                ids, counts = encoder(tokenizer).encode(some.column(1).to_pylist())
                raw = np.insert(ids, np.cumsum(counts), END_ID).astype("<u4").tobytes()
                out, first = [], 0
                for doc_id, n, *more in zip(some.column(0).to_pylist(), (counts + 1).tolist(), *(c.to_pylist() for c in some.columns[2:])):
                    start, size = 0, n % length or length
                    for piece in range(-(-n // length)):
                        here = 4 * (first + start)
                        out.append((doc_id, piece, start, size, zlib.crc32(raw[here : here + 4 * size]), *more))
                        start, size = start + size, length
                    first += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kept.types)], schema=kept)

    extra = [] if stretch is None else [stretch.cast("string").alias("stretch")]
    extra += [] if position is None else [position.cast("long").alias("position")]
    rows = docs.select(
        col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"), *extra
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_arrow(rows, cut, schema + ", stretch string" * (stretch is not None) + ", position long" * (position is not None))


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, all pieces being known."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        # Half of the change of the sum of squares when gap g becomes g - size; a gap of 0 is closed.
        change = counts[: capacity + 1 - size] - counts[size:] + 1.0
        change[0] = 0.5 - counts[size]
        change[counts[size:] == 0] = np.inf
        best = int(change.argmin())
        if change[best] == np.inf:
            number, gap, n = n, capacity, n + 1
        else:
            gap = best + size
            number = by_gap[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > size:
            by_gap[gap - size].append(number)
            counts[gap - size] += 1
    return sequence, offset


def _dealt(cut: DataFrame, share: int) -> tuple[DataFrame, int]:
    """`cut` with the number of the share of each piece, pieces dealt at random; and how many shares there are."""
    n = max(1, -(-cut.count() // share))
    return cut.withColumn("gp_share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("long")), n


def _runs(cut: DataFrame, run: int) -> tuple[DataFrame, int]:
    """`cut` with the run of each piece (`gp_share`) and how many pieces precede its step (`gp_before`); and how many runs there are.

    Stretches follow each other in the order of their names, and in them the positions, a step of
    them at a time. A run is as many pieces; those of a step that more than one run takes are dealt to
    them at random, so a step of any size is spread. One task sees a row per stretch, the driver none.
    """
    at = ["gp_stretch", "gp_step"]
    step = F.floor(F.col("gp_position") / _STEP) if "gp_position" in cut.columns else F.lit(0)
    cut = cut.withColumn(at[0], F.coalesce(at[0], F.lit(""))).withColumn(at[1], F.coalesce(step.cast("long"), F.lit(0)))
    counted = stored(cut.groupBy(*at).agg(F.count("*").alias("gp_many")), "steps")
    total = counted.agg(F.sum("gp_many")).first()[0] or 0
    ahead = Window.orderBy(at[0]).rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy(at[0]).agg(F.sum("gp_many").alias("gp_of_stretch"))
    bases = sums.select(at[0], F.coalesce(F.sum("gp_of_stretch").over(ahead), F.lit(0)).alias("gp_base"))
    earlier = Window.partitionBy(at[0]).orderBy(at[1]).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum("gp_many").over(earlier), F.lit(0))
    steps = counted.join(bases, at[0]).select(*at, "gp_many", (F.col("gp_base") + here).alias("gp_before"))
    # Pieces and steps take few bytes in a file and many in memory, so the planner is not to send them to the driver: every
    # piece has its step, so a left join gives the same rows; without positions there is but a step per stretch.
    steps = steps.hint("merge") if "gp_position" in cut.columns else steps
    placed = cut.withColumn("gp_dealt_by", F.monotonically_increasing_id()).join(steps, at, "left")
    dealt = F.pmod(F.xxhash64("gp_dealt_by"), F.col("gp_many"))
    return placed.withColumn("gp_share", F.floor((F.col("gp_before") + dealt) / run).cast("long")), max(1, -(-total // run))


def pack(cut: DataFrame, length: int = SEQUENCE_TOKENS, share: int = SHARE) -> DataFrame:
    """`cut` (as made by `pieces`, or any table with `length`) with sequence_id and offset.

    Pieces are dealt at random to shares of about `share` pieces, each packed by one task
    that holds its pieces' rows, never their tokens. With a column `stretch`, in which
    `position` may give an order, pieces are packed in runs of RUN that follow it, whatever the
    size of the input, and a task packs as many runs as a share holds. Sequence ids follow the runs, and
    within a run the mean place of a sequence's pieces; both columns are left out of the result. Sequence
    ids are unique, not dense. No pieces give no sequences; equal rows are packed each on its own. Other columns
    are carried, whatever their names; where `cut` has a sequence_id or an offset, the new ones get other names.
    """
    cut = stored(cut, "pieces")
    ordered = "stretch" in cut.columns
    out_names = fresh(cut, "sequence_id", "offset")
    # Inside, the carried columns go by number, so that none is called like a working column.
    inner = ["gp_" + f.name if f.name in ("stretch", "position") and ordered else f"c{i}" for i, f in enumerate(cut.schema)]
    size = inner[cut.columns.index("length")]
    kept = [f for f, name in zip(cut.schema, inner) if not name.startswith("gp_")]
    cut, names = cut.toDF(*inner), [name for name in inner if not name.startswith("gp_")]
    run = min(RUN, share)
    several = max(1, share // run) if ordered else 1
    numbered, shares = _runs(cut, run) if ordered else _dealt(cut, share)

    def run_of(whole: pa.Table) -> pa.Table:
        """One share or run, packed."""
        if ordered:  # from the order of the mix, as far as it is known
            by = [whole.column(c).to_numpy() for c in ("gp_dealt_by", "gp_at", "gp_before")]
            whole = whole.take(pa.array(np.lexsort(by)))
        sequence, offset = place(whole.column(size).to_numpy(), length)
        if ordered:
            mean = np.bincount(sequence, np.arange(len(sequence))) / np.bincount(sequence)
            rank = np.empty(len(mean), np.int64)
            rank[np.argsort(mean, kind="stable")] = np.arange(len(mean))
            sequence = rank[sequence]
        base = whole.column("gp_share")[0].as_py() << 32
        whole = whole.select(names).append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))
        return whole.rename_columns([f.name for f in out.fields])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if whole is None:
            return
        number = whole.column("gp_share").to_numpy()
        for one in np.unique(number):
            yield from run_of(whole.filter(pa.array(number == one))).to_batches(max_chunksize=20_000)

    out = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in out_names]])
    extra = ["gp_share"]
    if ordered:
        at = F.coalesce("gp_position", F.lit(0)) if "gp_position" in cut.columns else F.lit(0)
        extra += ["gp_dealt_by", "gp_before", at.cast("long").alias("gp_at")]
    rows = numbered.select(*names, *extra)
    dealt = rows.repartitionById(-(-shares // several), (F.col("gp_share") / several).cast("int"))
    return map_arrow(dealt, packed, out)
