"""Which members an index, a box, a walk or a set of coordinates needs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import ordering
from cubeweave.operators import catalog, edit, virtual
from cubeweave.runtime import new_dir, settings
from cubeweave.sources import inventory, sinks, substrate
from cubeweave.suite import indexes


def files_read(df):
    """Files that a query's scans of the cube opened, once it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append((node.toString(), node.metrics().get("numFiles").get().value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_an_index_range_opens_only_the_folders_it_meets(spark, sf_dir):
    path = os.path.join(new_dir(spark, "test"), "cube")
    sinks.write_cube(substrate.grid(spark, sf_dir), path)
    cube = spark.read.parquet(path)
    steps = cube.groupBy("realization", "year").agg(F.count_distinct("time").alias("ncoords"))
    kept = os.path.join(new_dir(spark, "test"), "offsets")
    virtual.member_offsets(steps, ["realization"], order=["year"]).write.parquet(kept)
    offsets = spark.read.parquet(kept)
    hit = virtual.members_of_range(offsets, 10, 12).select("realization", "year").collect()
    rows = virtual.index_range(cube, offsets, ["realization", "year"], "time", 10, 12, F.trunc("time", "month"))
    assert {r[0] for r in rows.select("index").distinct().collect()} == {10, 11, 12}
    every = {(r.realization, r.year) for r in offsets.collect()}
    opened = [n for plan, n in files_read(rows) if "tas" in plan]
    assert 0 < len(hit) < len(every) and opened and max(opened) <= len(hit)


def test_a_box_opens_only_the_tiles_it_touches(spark, sf_dir):
    opened = [n for plan, n in files_read(indexes.tile_box(spark, sf_dir)) if "tas" in plan]
    assert opened and max(opened) == 4


def test_cover_of_tiles_by_counting_cells(spark):
    sections = ["0:3,0:3", "2:5,2:5", "0:9,8:9", "9:9,0:0"]
    tiles = virtual.tile_bounds(spark.createDataFrame([(s,) for s in sections], "section string"), "section", ["y", "x"])
    got = {(r.y_block, r.x_block): (r.n_cells, r.n_missing, r.n_overlapping) for r in virtual.tile_cover(tiles, ["y", "x"], {"y": 10, "x": 10}, {"y": 4, "x": 4}).collect()}
    bounds = [[tuple(map(int, p.split(":"))) for p in s.split(",")] for s in sections]
    want = {}
    for y in range(10):
        for x in range(10):
            n = sum(a <= y <= b and c <= x <= d for (a, b), (c, d) in bounds)
            cell = want.setdefault((y // 4, x // 4), [0, 0, 0])
            cell[0] += 1
            cell[1] += n == 0
            cell[2] += n > 1
    assert got == {k: tuple(v) for k, v in want.items()}
    assert {r.section for r in virtual.tiles_of_box(tiles, {"y": (3, 3), "x": (4, 8)}).collect()} == {"2:5,2:5", "0:9,8:9"}


def test_members_are_ordered_by_their_coordinates(spark):
    at = lambda d: dt.datetime(2000, 1, 1) + dt.timedelta(days=d)
    rows = []
    for name, members in {
        "ok": {"z": (0, 3), "a": (3, 6), "m": (6, 9)}, "overlap": {"a": (0, 4), "b": (3, 6)}, "same": {"a": (0, 3), "b": (0, 3)}, "apart": {"a": (0, 3), "b": (0, 2)},
    }.items():
        rows += [(name, m, at(d), x) for m, (lo, hi) in members.items() for d in range(lo, hi) for x in (0.0, 1.0)]
    rows += [("two", m, at(d), x) for m, d, x in [("nw", 0, 0.0), ("ne", 0, 1.0), ("sw", 1, 0.0), ("se", 1, 1.0)]]
    df = spark.createDataFrame(rows, "dataset string, member string, time timestamp_ntz, x double")
    got = {(r.dataset, r.dim, r.member): (r.position, r.verdict) for r in virtual.coordinate_order(df, ["dataset"], "member", ["time", "x"]).collect()}
    assert {k[2]: v for k, v in got.items() if k[0] == "ok"} == {"z": (0, "ordered"), "a": (1, "ordered"), "m": (2, "ordered")}
    assert {v[1] for k, v in got.items() if k[0] == "overlap"} == {"overlapping"} and {v[1] for k, v in got.items() if k[0] == "apart"} == {"differing"}
    assert not any(k[0] == "same" for k in got)
    # a grid of members: each dimension has its own order
    assert {k[1:]: v[0] for k, v in got.items() if k[0] == "two"} == {("time", "nw"): 0, ("time", "ne"): 0, ("time", "sw"): 1, ("time", "se"): 1, ("x", "nw"): 0, ("x", "ne"): 1, ("x", "sw"): 0, ("x", "se"): 1}


def test_a_walk_to_any_depth_ends_in_cycles(spark):
    edges = [("r", "a"), ("a", "b"), ("b", "r"), ("r", "b"), ("b", "c")] + [(f"n{i}", f"n{i + 1}") for i in range(30)] + [("c", "n0")]
    df = spark.createDataFrame(edges, "parent string, child string")
    got = {r.node: r.depth for r in inventory.walk_all(df, spark.createDataFrame([("r",)], "node string")).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, **{f"n{i}": 2 + i for i in range(31)}}
    assert {r.node: r.depth for r in inventory.walk(df, spark.createDataFrame([("n20",)], "node string"), depth=None).collect()} == {f"n{i}": i - 21 for i in range(21, 31)}


def test_places_in_a_table_need_no_single_task(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.lit(1).alias("b"))
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        placed = ordering.place(df, ["a"], "place")
        got = [r.place for r in placed.orderBy("a").collect()]
    assert got == list(range(5000))
    assert ordering.place(df.limit(0), ["a"], "place").collect() == []


def test_dimensions_of_one_value(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 3)], "g string, x int, y int")
    assert {r.g: r.single for r in edit.single_dimensions(df, ["g"], ["x", "y"]).collect()} == {"a": ["x"], "b": ["x", "y"]}
    assert edit.drop_single(df, ["x"]).columns == ["g", "y"]
    with pytest.raises(Exception, match="more than one value along y"):
        edit.drop_single(df, ["x", "y"]).collect()


def test_plugged_collections(spark):
    kinds = catalog.Collections()

    @kinds.register("mine", facets=("title",), takes=lambda c: c["title"] == "t1")
    def mine(c):
        return [c["title"], F.lit("!")]

    with pytest.raises(ValueError, match="takes no datasets"):
        kinds.register("other")(mine)
    attrs = spark.createDataFrame([(i, "global", None, 1, "title", f"t{i}") for i in range(8)], "dataset bigint, scope string, variable string, pos int, name string, value string")
    assets = spark.createDataFrame([(1, "/p")], "dataset bigint, path string")
    got = {r.dataset: (r.collection, r.cells) for r in kinds.entries(attrs, assets).collect()}
    assert got[1] == ("mine", ["t1", "!"]) and sum(c == "mine" for c, _ in got.values()) == 1
    common = {r.dataset: (r.collection, r.cells) for r in catalog.all_entries(attrs, assets).collect()}
    assert {k: v for k, v in got.items() if k != 1} == {k: v for k, v in common.items() if k != 1}
