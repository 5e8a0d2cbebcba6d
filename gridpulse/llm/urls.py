"""URL filters: rules by host and path, and listed hosts kept in a cascade of Bloom filters.

The first filter of the cascade holds the listed keys. Among all other keys of the corpus some
pass it by chance; the second filter holds exactly those, the third the listed keys
that pass the second, and so on until none passes. For every key of the corpus the
first filter that it does not pass then tells, without error, whether it is listed, and
the filters are a few bits per listed key, so they travel in the plan and rows meet no join.
Where they would be too large for a plan, keys are dealt to parts by their hash and each part
has a cascade of its own; rows then meet the small row of filters of their part, never the list.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log, log2, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col, fresh, stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that all filters of a cascade may take in a plan; larger lists are cut into parts.
MOST_BYTES = 8 << 20
#: Listed keys that a part holds on average.
PART_KEYS = 1024
_BITMAP = 32768  # bits of one of Spark's bitmaps


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first `://`, to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule whose host is the host or a parent of it and whose path begins the path; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """One Bloom filter; its number salts the hashes."""

    number: int
    bits: int
    hashes: int
    data: bytes

    def passes(self, key: Column) -> Column:
        tests = [self._bit(_position(key, self.number, i, self.bits)) for i in range(self.hashes)]
        return reduce(lambda a, b: a & b, tests)

    def _bit(self, position: Column) -> Column:
        byte = F.hex(F.substring(F.lit(self.data), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1)))
        return F.getbit(F.conv(byte, 16, 10).cast("int"), (position % 8).cast("int")) == 1


def _position(key: Column, number: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits))


def _filled(keys: DataFrame, number: int, bits: int, hashes: int) -> Level:
    spots = F.explode(F.array(*[_position(F.col("key"), number, i, bits) + 1 for i in range(hashes)]))
    maps = (
        keys.select(spots.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("map")).collect()
    )
    data = bytearray(ceil(bits / _BITMAP) * _BITMAP // 8)
    for row in maps:  # at most MOST_BYTES in all
        data[(row.bucket - 1) * _BITMAP // 8 : row.bucket * _BITMAP // 8] = row.map
    return Level(number, bits, hashes, bytes(data[: ceil(bits / 8)]))


def cascade(universe: DataFrame) -> list[Level] | None:
    """Filters that tell for every `key` of the universe whether it is `listed`.

    `universe` has each key once, with whether it is listed; a null key is never listed.
    None if the filters would be larger than MOST_BYTES. The first filter lets so many of the
    other keys pass as make the second about as large as the first needs to be; the
    later ones let half of them pass.
    """
    keys = stored(universe.select("key", "listed").filter("key is not null"), "keys")
    inside, outside = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    levels: list[Level] = []
    size = 0
    while n := inside.count():
        passing = 0.5 if levels else min(0.5, sqrt(0.5) * n / max(1, outside.count()))
        bits = max(64, ceil(n * log2(1 / passing) / log(2)))
        size += bits // 8 + 1
        if size > MOST_BYTES:
            return None
        level = _filled(inside, len(levels) + 1, bits, max(1, round(log2(1 / passing))))
        levels.append(level)
        inside, outside = stored(outside.filter(level.passes(F.col("key"))), "passing"), inside
    return levels


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _positions(key: Column, number: Column, hashes: Column, bits: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), hashes - 1), lambda i: F.pmod(F.xxhash64(key, number, i), bits))


def _passes(key: Column, level: Column) -> Column:
    """Whether a key passes a filter of its part: all of its bits are set in the words."""
    spots = _positions(key, level["number"], level["hashes"], level["bits"])
    return F.forall(spots, lambda p: F.getbit(F.get(level["words"], F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1)


def _filters(inside: DataFrame, outside: DataFrame, number: int) -> DataFrame:
    """The filter of every part that has a key inside: part and level (number, bits, hashes, words of 64 bits)."""
    n, m = F.col("n"), F.coalesce(F.col("m"), F.lit(0))
    passing = F.least(F.lit(0.5), F.lit(sqrt(0.5)) * n / F.greatest(F.lit(1), m)) if number == 1 else F.lit(0.5)
    bits_of_key = -F.log2(passing)
    inner = inside.groupBy("part").agg(F.count("*").alias("n"))
    outer = outside.groupBy("part").agg(F.count("*").alias("m"))
    sizes = inner.join(outer, "part", "left").select(
        "part", F.lit(number).alias("number"), F.greatest(F.lit(64), F.ceil(n * bits_of_key / log(2))).cast("long").alias("bits"),
        F.greatest(F.lit(1), F.round(bits_of_key)).cast("int").alias("hashes"),
    )
    sizes = stored(sizes, "sizes")
    spots = F.explode(_positions(F.col("key"), F.col("number"), F.col("hashes"), F.col("bits")))
    found = inside.join(sizes, "part").select("part", spots.alias("spot"))
    masks = found.select(
        "part", F.shiftright("spot", 6).alias("place"), F.expr("shiftleft(1L, CAST(spot % 64 AS INT))").alias("mask")
    )
    empty = sizes.select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("bits") - 1, 6))).alias("place"))
    words = masks.unionByName(empty.withColumn("mask", F.lit(0).cast("long"))).groupBy("part", "place").agg(F.bit_or("mask").alias("mask"))
    row = words.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", "mask")))["mask"].alias("words"))
    return stored(sizes.join(row, "part").select("part", F.struct("number", "bits", "hashes", "words").alias("level")), "filters")


def cascades(universe: DataFrame) -> tuple[DataFrame, int]:
    """A cascade per part of the universe, for lists of any size: rows of part and levels, and the number of parts.

    Parts without a listed key have no row. Built by joins and groups of keys by part; nothing but counts reaches the driver.
    """
    keys = stored(universe.select("key", "listed").filter("key is not null"), "keys")
    parts = max(1, ceil(keys.filter("listed").count() / PART_KEYS))
    placed = keys.withColumn("part", _part(F.col("key"), parts))
    inside, outside = placed.filter("listed").select("part", "key"), placed.filter("not listed").select("part", "key")
    made: list[DataFrame] = []
    while not made or not inside.isEmpty():
        made.append(_filters(inside, outside, len(made) + 1))
        passed = outside.join(made[-1], "part").filter(_passes(F.col("key"), F.col("level"))).select("part", "key")
        inside, outside = stored(passed, "passing"), inside
    every = reduce(DataFrame.unionByName, made)
    # Numbers come first in a level, so sorting puts the levels in their order.
    return stored(every.groupBy("part").agg(F.array_sort(F.collect_list("level")).alias("levels")), "cascades"), parts


def is_listed_in_part(key: Column, levels: Column) -> Column:
    """As `is_listed`, for the levels of the key's part; a null key, or one of a part without levels, is not listed."""
    failed = F.array_position(F.transform(levels, lambda level: _passes(key, level)), F.lit(False))
    answer = F.when(failed > 0, failed % 2 == 0).otherwise(F.size(levels) % 2 == 1)
    return F.coalesce(answer & levels.isNotNull() & key.isNotNull(), F.lit(False))


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed: decided by the first level that it does not pass."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.passes(key), F.lit(level.number % 2 == 0)).otherwise(answer)
    return F.coalesce(answer, F.lit(False))


def judged(pages: DataFrame, rules: list[Rule], listed: Column | DataFrame, url_col: str = "url") -> tuple[DataFrame, list[str]]:
    """`pages` with host, path, rule and verdict; the names of the four.

    `listed` says which hosts are blocked where no rule fits: a condition on the column
    `key`, or a table with a column `key`. The cascade covers all hosts of `pages`.
    A null url, or one without `://`, has an empty host and path and is judged by these.
    Added columns get names that `pages` does not have; rows are judged one by one, so
    ties, repeats and nulls elsewhere have no effect; no rows give none.
    """
    names = fresh(pages, "host", "path", "rule", "verdict")
    host, path, rule, verdict = names
    url = col(url_col).cast("string")
    keys = pages.select(host_of(url).alias("key")).distinct()
    if isinstance(listed, DataFrame):
        blocked = listed.select(F.col("key").alias("other")).distinct()
        universe = keys.join(blocked, F.col("key") == F.col("other"), "left").select("key", F.col("other").isNotNull().alias("listed"))
    else:
        universe = keys.select("key", F.coalesce(listed, F.lit(False)).alias("listed"))
    levels = cascade(universe)
    parted = pages.withColumns({host: host_of(url), path: path_of(url)})
    best = best_rule(F.col(host), F.col(path), rules)
    if levels is None:  # too large for a plan: the filters of a row's part come to the row
        filters, parts = cascades(universe)
        extra = fresh(parted, "gp_part", "gp_levels")
        filters = filters.toDF(*extra)
        parted = parted.join(filters, _part(F.col(host), parts) == F.col(extra[0]), "left")
        member = is_listed_in_part(F.col(host), F.col(extra[1]))
    else:
        member, extra = is_listed(F.col(host), levels), []
    full = parted.withColumn(rule, best["rule"]).withColumn(
        verdict, F.coalesce(best["verdict"], F.when(member, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    )
    return full.drop(*extra), names
