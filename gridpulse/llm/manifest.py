"""A manifest of a dataset as a Merkle tree: a content-addressed graph that proofs descend.

Rows are leaves; every group has a tree of its own, and the groups' roots have one
above them. Six levels of a tree are a page: the node on top and, by digest, the children
of every node below it. Pages are built from the leaves up, one shuffle for a page's worth
of levels, and are written to the shared folder. A proof descends from the root: the digits
of a leaf's rank, to the base of the fan-out, say which child to take, and the others are
collected. Leaves of one page share the descent down to it, so what moves is a row per page.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import col, map_arrow, stored

FANOUT = 3
#: Levels in a page.
DEPTH = 6
PAGE = FANOUT**DEPTH

STEP = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(*values: Column) -> Column:
    """SHA-256 in hex of the values: each as the bytes of its text form and a colon before it, `-` if null."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one string, level by level from the leaf, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _height(leaves: int) -> int:
    """Levels above so many nodes."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def _ranked(items: DataFrame, order: list[str]) -> DataFrame:
    """`items` with `rank` (from 0) and `total` in their `tree`, ordered by `order`; equal rows in any order.

    Rows are sorted by ranges of tree and order into files. A file's first row of a tree and
    the rows of it in earlier files give the ranks, so nothing but a row per file and tree
    is counted up, and no tree is gathered.
    """
    items = stored(items, "manifest-items")
    tie = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    dealt = items.select("*", tie.alias("tie"))
    keys = ["tree", *order, "tie"]
    files = stored(dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie"), "manifest-sorted")
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    rows = files.select("*", number.alias("file"), F.col("_metadata.row_index").alias("row"))
    spans = rows.groupBy("tree", "file").agg(F.count("*").alias("many"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("many").over(tree.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = spans.select("tree", "file", (earlier - F.col("first")).alias("base"), F.sum("many").over(tree).alias("total"))
    ranked = rows.join(stored(bases, "manifest-bases"), ["tree", "file"])
    return ranked.withColumn("rank", F.col("row") + F.col("base")).drop("file", "row", "base")


def _pages(nodes: DataFrame) -> DataFrame:
    """(tree, page, total, digest, height, size, children): the pages over nodes (tree, rank, total, digest).

    `digest` is the node on top of `size` nodes, `height` levels below it; `children` holds
    those of every inner node, in order. A tree that ends in a page has no levels to spare.
    """
    grouped = nodes.groupBy("tree", F.expr(f"rank div {PAGE}").alias("page"), "total").agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("rows")
    ).select("tree", "page", "total", F.col("rows.digest").alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"tree": [], "page": [], "total": [], "digest": [], "height": [], "size": [], "children": []}
            for r in batch.to_pylist():
                level, height = r["rows"], DEPTH if r["total"] > PAGE else _height(r["total"])
                children: dict[str, list[str]] = {}
                for _ in range(height):
                    runs = [level[i : i + FANOUT] for i in range(0, len(level), FANOUT)]
                    level = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
                    children |= zip(level, runs)
                for name, value in (("tree", r["tree"]), ("page", r["page"]), ("total", r["total"]), ("digest", level[0]),
                                    ("height", height), ("size", len(r["rows"])), ("children", list(children.items()))):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([
        ("tree", pa.string()), ("page", pa.int64()), ("total", pa.int64()), ("digest", pa.string()), ("height", pa.int32()),
        ("size", pa.int32()), ("children", pa.map_(pa.string(), pa.list_(pa.string()))),
    ])
    return stored(map_arrow(grouped, run, (
        "tree string, page bigint, total bigint, digest string, height int, size int, children map<string, array<string>>"
    )), "manifest-pages")


def _descend(children: dict[str, list[str]], top: str, position: int, height: int) -> tuple[str, list[tuple[str, str]]]:
    """The node at a position below `top`, and what is left and right of the path on every level, the highest first."""
    at, path = top, []
    for level in reversed(range(height)):
        digit = position // FANOUT**level % FANOUT
        below = children[at]
        path.append(("".join(below[:digit]), "".join(below[digit + 1 :])))
        at = below[digit]
    return at, path


def _steps(paths: list[list[tuple[str, str]]]) -> pa.Array:
    """Lists of (before, after) as an Arrow array."""
    offsets = [0]
    for path in paths:
        offsets.append(offsets[-1] + len(path))
    flat = pa.StructArray.from_arrays(
        [pa.array([step[i] for path in paths for step in path], pa.string()) for i in (0, 1)], ["before", "after"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def _below(pages: DataFrame) -> DataFrame:
    """(tree, page, digest, path): every node at the foot of the pages, `path` grown by the steps that lead to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                known, prefix = dict(r["children"]), [(s["before"], s["after"]) for s in r["path"]]
                found = [_descend(known, r["digest"], i, r["height"]) for i in range(r["size"])]
                first = r["page"] * PAGE
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["tree"]] * len(found)), pa.array(range(first, first + len(found)), pa.int64()),
                    pa.array([at for at, _ in found]), _steps([prefix + path for _, path in found]),
                ], ["tree", "page", "digest", "path"])

    picked = pages.select("tree", "page", "digest", "height", "size", "children", "path")
    return map_arrow(picked, run, f"tree string, page bigint, digest string, path {STEP}")


def _grown(nodes: DataFrame) -> list[DataFrame]:
    """Pages over the nodes, over the tops of these, and so on until every tree has one page."""
    levels = [_pages(nodes)]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > PAGE:
        last = levels[-1].filter(F.col("total") > PAGE)
        total = F.ceil(F.col("total") / PAGE).cast("long")
        levels.append(_pages(last.select("tree", F.col("page").alias("rank"), total.alias("total"), "digest")))
    return levels


def _descended(levels: list[DataFrame], entries: DataFrame) -> DataFrame:
    """The lowest pages with the path down to them, from `entries` (tree, page, digest, path): the trees' roots.

    A tree enters at the level of its own last page. Requests find a page by the digest
    that they hold for it and by the rank they look for: equal subtrees have equal digests.
    """
    below = None
    for level, pages in reversed(list(enumerate(levels))):
        tops = pages.filter(F.col("total") <= PAGE).select("tree", "page", "digest").join(entries, ["tree", "page", "digest"])
        asked = tops if below is None else tops.unionByName(below)
        found = pages.join(asked, ["tree", "page", "digest"])
        if level:
            below = stored(_below(found), "manifest-frontier")
    return found


@dataclass(frozen=True)
class Manifest:
    """Root of a dataset, its groups' roots, and the pages of the trees.

    `members` has the leaves of every page in their order: (tree, page, members of struct
    of id, group, carried columns). `root` is None for no rows.
    """

    root: str | None
    groups: DataFrame
    members: DataFrame
    levels: list[DataFrame]
    above: list[DataFrame]


def build(
    docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source", carried: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of `docs`: a leaf per row over `fields`, trees per group in order of `id_col`.

    Null ids come before others and ties are ordered by leaf, so equal rows give equal
    manifests in any order of the input; repeated rows are leaves of their own; the null
    group comes first, others by the bytes of their names. `carried` columns stay with
    their leaf. Texts of any length are hashed whole where they are read; no rows have no root.
    """
    group = col(group_col).cast("string")
    leaves = docs.select(
        # Trees are named so that they sort as the groups do and are never null.
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"),
        col(id_col).alias("id"), digest(*[col(f) for f in fields]).alias("digest"),
        F.struct(*[value.alias(name) for name, value in (carried or {"_": F.lit(None).cast("string")}).items()]).alias("carried"),
    )
    ranked = stored(_ranked(leaves, ["id", "digest"]), "manifest-leaves")
    levels = _grown(ranked)
    members = ranked.groupBy("tree", F.expr(f"rank div {PAGE}").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "carried"))).alias("members")
    )
    tops = None
    for pages in levels:
        top = pages.filter(F.col("total") <= PAGE).select("tree", "digest")
        tops = top if tops is None else tops.union(top)
    groups = stored(tops, "manifest-groups")
    whole = groups.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above = _grown(ranked_groups := stored(_ranked(whole, ["name"]), "manifest-tops"))
    top = above[-1].select("digest").first()
    return Manifest(top and top[0], ranked_groups.select(F.col("name").alias("tree"), "rank", "digest"), members, levels, above)


def proofs(manifest: Manifest) -> DataFrame:
    """(id, grouping, leaf, subroot, root, proof, carried) of every leaf; the proof's steps go from the leaf to the root.

    A step has the digests before and after the path's node in its run, each of 64 digits;
    both are empty for a node that is alone. `folded(leaf, proof)` gives the root.
    """
    spark = manifest.groups.sparkSession
    none = F.array().cast(STEP)
    start = spark.range(1 if manifest.root else 0).select(
        F.lit("").alias("tree"), F.lit(0).cast("long").alias("page"), F.lit(manifest.root).cast("string").alias("digest"), none.alias("path")
    )
    tops = _below(_descended(manifest.above, start)).select(F.col("page").alias("rank"), "digest", "path")
    entries = stored(manifest.groups.join(tops, ["rank", "digest"]).select(
        "tree", F.lit(0).cast("long").alias("page"), "digest", "path"
    ), "manifest-entries")
    lowest = _descended(manifest.levels, entries).select("tree", "page", "digest", "height", "size", "children", "path")
    asked = lowest.join(manifest.members, ["tree", "page"]).join(entries.select("tree", F.col("digest").alias("subroot")), "tree")
    kind = dict(manifest.members.select(F.col("members")[0]["id"].alias("id"), F.col("members")[0]["carried"].alias("carried")).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in ("tree", "digest", "height", "children", "path", "subroot")}
                members = batch.column("members")[i].values
                known, prefix = dict(r["children"]), [(s["before"], s["after"]) for s in reversed(r["path"])]
                found = [_descend(known, r["digest"], at, r["height"]) for at in range(len(members))]
                yield pa.RecordBatch.from_arrays([
                    members.field("id"), pa.array([r["tree"]] * len(found)), pa.array([leaf for leaf, _ in found]),
                    pa.array([r["subroot"]] * len(found)), _steps([path[::-1] + prefix for _, path in found]), members.field("carried"),
                ], ["id", "tree", "leaf", "subroot", "proof", "carried"])

    schema = f"id {kind['id']}, tree string, leaf string, subroot string, proof {STEP}, carried {kind['carried']}"
    found = map_arrow(asked, run, schema)
    grouping = F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30))
    return found.select("id", grouping.alias("grouping"), "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof", "carried")
