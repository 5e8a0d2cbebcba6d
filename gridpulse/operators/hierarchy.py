"""The equipment tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.session import checkpointed


def _walk(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """All devices below the roots, one row per way up from a device to its root.

    Every row knows a part of its way, from the device to `top`. A round joins the parts
    that do not end in a root to those that begin where they end, so their length doubles
    and a tree of depth d takes about log2(d) rounds. What is longer than all edges
    together runs in a cycle, which is an error.
    """
    ends = roots.select(F.col("device_id").alias("top"), "site_id", F.lit(True).alias("ended"))
    links = edges.select("device_id", "parent_device_id", F.col("parent_device_id").alias("top"), F.lit(1).alias("steps"))
    ways, longest, most = checkpointed(links.join(ends, "top", "left")), 1, None
    while True:
        open_ways = ways.filter("ended IS NULL")
        stuck = open_ways.select("device_id").first()
        if stuck is None:
            break
        if most is None:
            most = edges.count()
        if longest > most:
            raise ValueError(f"the device hierarchy has a cycle: device {stuck.device_id} is below itself or below one that is")
        further = ways.select(
            F.col("device_id").alias("top"), F.col("top").alias("next"), F.col("steps").alias("more"), "site_id", "ended"
        )
        grown = open_ways.select("device_id", "parent_device_id", "top", "steps").join(further, "top").select(
            F.col("next").alias("top"), "device_id", "parent_device_id", (F.col("steps") + F.col("more")).alias("steps"), "site_id", "ended"
        )
        ways, longest = checkpointed(ways.filter("ended").unionByName(grown)), 2 * longest
    below = ways.select("site_id", "device_id", "parent_device_id", (F.col("steps") + 1).alias("depth"))
    names = edges.select("device_id", "name", "device_type_id").distinct()
    top = roots.select(
        "site_id", "device_id", F.lit(None).cast(edges.schema["parent_device_id"].dataType).alias("parent_device_id"),
        F.lit(1).alias("depth"), "name", "device_type_id",
    )
    return top.unionByName(below.join(names, "device_id"))


def device_point_tree(
    devices: DataFrame,
    hierarchy: DataFrame,
    device_types: DataFrame,
    device_points: DataFrame,
    points: DataFrame,
    site_id: object = None,
) -> DataFrame:
    """Devices below the roots of a site, then the points attached to them.

    A root has no parent. Without `site_id` the trees of all sites are returned,
    with the root's `site_id`. A device with two parents appears under both; a
    tree may be of any depth. The ways to the roots are found when the function is called,
    in rounds that double their length, and are kept in the shared folder.
    """
    children = hierarchy.select(F.col("child_device_id").alias("device_id"))
    roots = devices.join(children, "device_id", "left_anti")
    edges = hierarchy.join(devices, F.col("child_device_id") == F.col("device_id")).select(
        "parent_device_id", "device_id", "name", "device_type_id"
    )
    tree = _walk(roots, edges)
    if site_id is not None:
        tree = tree.filter(F.col("site_id") == site_id)
    types = device_types.select("device_type_id", F.col("name").alias("device_type"))
    as_device = tree.join(types, "device_type_id").select(
        "site_id",
        F.lit("device").alias("node_type"),
        "depth",
        "device_id",
        "parent_device_id",
        "name",
        "device_type",
        F.lit(None).cast(points.schema["point_id"].dataType).alias("point_id"),
        F.lit(None).cast("string").alias("uom"),
        F.lit(None).cast("boolean").alias("is_analog"),
    )
    label = F.coalesce("display_name", "name") if "display_name" in points.columns else F.col("name")
    analog = F.col("is_analog") if "is_analog" in points.columns else F.lit(True)
    catalog = points.select("point_id", label.alias("_label"), "uom", analog.alias("is_analog"))
    attached = device_points.select("device_id", "point_id").join(catalog, "point_id")
    as_point = tree.select("site_id", "depth", "device_id").join(attached, "device_id").select(
        "site_id",
        F.lit("point").alias("node_type"),
        (F.col("depth") + 1).alias("depth"),
        F.lit(None).cast("string").alias("device_id"),
        F.col("device_id").alias("parent_device_id"),
        F.col("_label").alias("name"),
        F.lit(None).cast("string").alias("device_type"),
        "point_id",
        "uom",
        "is_analog",
    )
    nodes = as_device.unionByName(as_point)
    return nodes if site_id is None else nodes.drop("site_id")
