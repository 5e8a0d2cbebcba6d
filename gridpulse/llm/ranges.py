"""Rows dealt out by ranges of an id, with the ids alone read to find the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col


def boundaries(df: DataFrame, id_col: str, parts: int) -> list[int]:
    """At most parts - 1 ids that cut the rows into about equal ranges; only ids are read."""
    if parts < 2:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(col(id_col), probabilities, max(1000, 20 * parts))).first()[0]
    return sorted(set(found or []))


def bucket(id_col: Column, cuts: list[int]) -> Column:
    """Number of the range of an id: how many cuts lie below it; null ids come first."""
    if not cuts:
        return F.lit(0)

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(id_col > cuts[mid], between(mid + 1, hi)).otherwise(between(lo, mid))

    return F.coalesce(F.when(id_col.isNull(), 0), between(0, len(cuts)))


def parts_for(df: DataFrame) -> int:
    """Number of ranges: as many as the session's shuffles have partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
