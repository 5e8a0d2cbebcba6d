import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from gridpulse.operators.hierarchy import device_point_tree
from gridpulse.operators.integrity import audit_constraints
from gridpulse.plans.reports import plant_tree


@pytest.fixture
def tree(spark):
    devices = spark.createDataFrame(
        [("A", "s", "a", 1), ("B", "s", "b", 1), ("C", "s", "c", 1), ("Z", "t", "z", 1)],
        "device_id string, site_id string, name string, device_type_id int",
    )
    edges = spark.createDataFrame([("A", "B"), ("B", "C")], "parent_device_id string, child_device_id string")
    types = spark.createDataFrame([(1, "inverter")], "device_type_id int, name string")
    mapping = spark.createDataFrame([("C", "p")], "device_id string, point_id string")
    points = spark.createDataFrame([("p", "P", None, "kW", True)], "point_id string, name string, display_name string, uom string, is_analog boolean")
    return devices, edges, types, mapping, points


def test_tree_depths(tree):
    out = device_point_tree(*tree, site_id="s")
    assert rows(out, "node_type", "depth", "name", "parent_device_id", "point_id") == [
        ("device", 1, "a", None, None), ("device", 2, "b", "A", None), ("device", 3, "c", "B", None), ("point", 4, "P", "C", "p")
    ]
    assert ("      P",) in rows(plant_tree(out), "plant")
    assert "site_id" not in out.columns


def test_all_sites(tree):
    assert rows(device_point_tree(*tree).filter("depth = 1"), "site_id", "name") == [("s", "a"), ("t", "z")]


def test_second_parent_repeats_the_device(spark, tree):
    devices, edges, *rest = tree
    more = edges.unionByName(spark.createDataFrame([("A", "C")], edges.schema))
    out = device_point_tree(devices, more, *rest, site_id="s").filter("device_id = 'C'")
    assert rows(out, "depth") == [(2,), (3,)]


def test_a_tree_of_any_depth(spark, tree):
    devices, _, types, mapping, points = tree
    chain = [(f"d{i:03}", "s", f"n{i}", 1) for i in range(115)]
    devices = spark.createDataFrame(chain, devices.schema).coalesce(1)
    edges = spark.createDataFrame([(a[0], b[0]) for a, b in zip(chain, chain[1:])], "parent_device_id string, child_device_id string").coalesce(1)
    out = device_point_tree(devices, edges, types, mapping, points)
    assert out.agg({"depth": "max"}).first()[0] == 115


def test_a_chain_of_ten_thousand_devices(spark, tree):
    devices, _, types, mapping, points = tree
    n = 10_000
    name = F.format_string("d%05d", F.col("id"))
    devices = spark.range(n).select(name.alias("device_id"), F.lit("s").alias("site_id"), name.alias("name"), F.lit(1).alias("device_type_id"))
    edges = spark.range(n - 1).select(name.alias("parent_device_id"), F.format_string("d%05d", F.col("id") + 1).alias("child_device_id"))
    out = device_point_tree(devices, edges, types, mapping, points).filter("node_type = 'device'")
    wrong = out.filter(F.col("depth") != F.substring("name", 2, 5).cast("int") + 1).count()
    assert (out.count(), wrong) == (n, 0)


@pytest.mark.parametrize("size", [2, 3, 5, 8])
def test_cycles_of_any_length_are_reported(spark, tree, size):
    devices, edges, *rest = tree
    ring = [f"r{i}" for i in range(size)]
    more = spark.createDataFrame([(a, "s", a, 1) for a in ring], devices.schema)
    loop = spark.createDataFrame([("C", ring[0]), *zip(ring, [*ring[1:], ring[0]])], edges.schema)
    with pytest.raises(ValueError, match="cycle"):
        device_point_tree(devices.union(more), edges.union(loop), *rest)


def test_a_parent_that_is_no_device_has_no_tree(spark, tree):
    devices, edges, *rest = tree
    more = edges.unionByName(spark.createDataFrame([("gone", "Z")], edges.schema))
    assert rows(device_point_tree(devices, more, *rest).filter("depth = 1"), "name") == [("a",)]


def test_a_cycle_is_reported(spark, tree):
    devices, edges, *rest = tree
    loop = edges.unionByName(spark.createDataFrame([("C", "B")], edges.schema))
    with pytest.raises(ValueError, match="cycle"):
        device_point_tree(devices, loop, *rest, site_id="s")


def test_clean_tables_have_no_violations(spark, tree, readings):
    devices, edges, _, mapping, points = tree
    tables = {"device_hierarchy": edges, "devices": devices, "device_points": mapping, "points": points,
              "point_readings": readings((at("10:00"), "p", 1.0))}
    assert audit_constraints(tables).count() == 0


def test_every_rule_finds_its_violation(spark, readings, tree):
    devices = tree[0]
    t = {
        "value_maps": spark.createDataFrame([("m", ["a"], [0, 1])], "value_map_id string, display_values array<string>, int_values array<int>"),
        "points": spark.createDataFrame([("p", "s", 5, 1), ("q", "none", 0, 1), ("q", "s", 0, 1)], "point_id string, site_id string, eng_low int, eng_high int"),
        "sites": spark.createDataFrame([("s",)], "site_id string"),
        "device_hierarchy": spark.createDataFrame([("A", "A"), ("A", "gone"), ("gone2", "B")], "parent_device_id string, child_device_id string"),
        "devices": devices,
        "device_points": spark.createDataFrame([("A", "p"), ("A", "p"), ("gone", "r")], "device_id string, point_id string"),
        "outages": spark.createDataFrame([(1, at("10:00"), at("10:00"))], "outage_id int, start_at timestamp_ntz, end_at timestamp_ntz"),
        "retention_settings": spark.createDataFrame([("x", -1), ("x", 1)], "table_name string, retention_days int"),
        "settings": spark.createDataFrame([("s", "n"), ("s", "n")], "site_id string, setting_name string"),
        "point_readings": readings((at("10:00"), "p", 1.0), (at("10:00"), "p", 2.0), (at("10:00"), "orphan", 2.0)),
        "control_requests": spark.createDataFrame([("r", at("10:00")), ("r", at("10:00"))], "control_request_id string, created_at timestamp_ntz"),
    }
    found = {r[0]: r[1] for r in rows(audit_constraints(t), "rule", "key")}
    assert found == {
        "value_maps_parallel_arrays": "m", "points_eng_range": "p", "points_key": "q", "points_site": "none",
        "hierarchy_no_self": "A", "hierarchy_parent": "gone2", "hierarchy_child": "gone", "outages_order": "1",
        "retention_not_negative": "x", "retention_table": "x", "settings_site_name": "s|n",
        "readings_key": "2024-01-05 10:00:00|p", "readings_point": "orphan", "requests_key": "2024-01-05 10:00:00|r",
        "device_points_key": "A|p", "device_points_point": "r", "device_points_device": "gone",
    }
    with pytest.raises(ValueError):
        audit_constraints({})
