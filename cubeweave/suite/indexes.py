"""Which members an index, a box or a set of coordinates needs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cubeweave.functions import numeric
from cubeweave.operators import virtual
from cubeweave.registry import query
from cubeweave.runtime import new_dir
from cubeweave.sources import sinks, substrate
from cubeweave.suite.views import with_views

#: Yearly members told apart by what their dataset is called: whole years, half a year too long, and odd or even months.
_SETS = ["years", "overlaps", "months", "places"]


def member_rows(spark, sf):
    """The points of the cube as members of four datasets; their labels do not tell the order."""
    points = substrate.points(spark, sf).select("realization", "time", "lat", "lon")
    year, month = F.year("time"), F.month("time")
    shuffled = lambda c: F.concat(F.lit("m"), F.pmod(c * 7, F.lit(11)).cast("string"))
    part = lambda s, c: F.struct(F.lit(s).alias("dataset"), c.alias("member"))
    both = F.filter(
        F.array(
            part("years", shuffled(year)),
            part("overlaps", shuffled(year)),
            F.when((month <= 6) & (year > 1995), part("overlaps", shuffled(year - 1))),
            part("months", F.when(month % 2 == 0, "even").otherwise("odd")),
            part("places", F.when(F.col("lon") < -75, "west").otherwise("east")),
        ),
        lambda s: s.isNotNull(),
    )
    return points.select("realization", "time", "lat", "lon", F.inline(both))


_MEMBERS = """m AS (SELECT *, unnest([
      {{'dataset': 'years', 'member': concat('m', (year(time) * 7) % 11)}}, {{'dataset': 'overlaps', 'member': concat('m', (year(time) * 7) % 11)}},
      CASE WHEN month(time) <= 6 AND year(time) > 1995 THEN {{'dataset': 'overlaps', 'member': concat('m', ((year(time) - 1) * 7) % 11)}} END,
      {{'dataset': 'months', 'member': CASE WHEN month(time) % 2 = 0 THEN 'even' ELSE 'odd' END}},
      {{'dataset': 'places', 'member': CASE WHEN lon < -75 THEN 'west' ELSE 'east' END}}]) AS s FROM points),
  r AS (SELECT s.dataset AS dataset, s.member AS member, {dim} AS v FROM m WHERE s IS NOT NULL)"""


@query(
    "combine_order",
    with_views(
        "points",
        f"""WITH {_MEMBERS.format(dim="epoch_us(time)::DOUBLE")}, e AS (SELECT dataset, member, min(v) AS first, max(v) AS last FROM r GROUP BY 1, 2),
          w AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY first) - 1 AS position, max(last) OVER (PARTITION BY dataset ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= first AS late FROM e)
        SELECT dataset, 'time' AS dim, member, first, last, position, CASE WHEN bool_or(coalesce(late, false)) OVER (PARTITION BY dataset) THEN 'overlapping' ELSE 'ordered' END AS verdict
        FROM w WHERE dataset <> 'places'
        UNION ALL SELECT 'places', 'lon', CASE WHEN lon < -75 THEN 'west' ELSE 'east' END AS member, min(lon), max(lon), CASE WHEN lon < -75 THEN 0 ELSE 1 END, 'ordered' FROM points GROUP BY ALL""",
    ),
)
def combine_order(spark, sf):
    """Members in the order of their coordinates, in one read; those that overlap or interleave are refused."""
    found = virtual.coordinate_order(member_rows(spark, sf), ["dataset"], "member", ["time", "lon"])
    # a few days or places may be missing at random from a member; such differences are not what tells members apart
    split = F.when(F.col("dataset") == "places", "lon").otherwise("time")
    return found.where(F.col("dim") == split)


@query(
    "index_range",
    with_views(
        "grid",
        """WITH a AS (SELECT DISTINCT realization, time FROM grid), i AS (SELECT *, row_number() OVER (PARTITION BY realization ORDER BY time) - 1 AS index FROM a)
        SELECT realization, year(time)::BIGINT AS year, min(index) AS first, max(index) AS last, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas
        FROM grid JOIN i USING (realization, time) WHERE index BETWEEN 100 AND 250 GROUP BY 1, 2""",
    ),
)
def index_range(spark, sf):
    """Time steps 100 to 250 of every realization of a published cube: folders of other years stay closed."""
    path = os.path.join(new_dir(spark, "indexed"), "cube")
    sinks.write_cube(substrate.grid(spark, sf), path)
    cube = spark.read.parquet(path)
    steps = cube.groupBy("realization", "year").agg(F.count_distinct("time").alias("ncoords"))
    offsets = virtual.member_offsets(steps, ["realization"], order=["year"])
    rows = virtual.index_range(cube, offsets, ["realization", "year"], "time", 100, 250, F.trunc("time", "month"))
    return rows.groupBy("realization", F.col("year").cast("bigint").alias("year")).agg(
        F.min("index").alias("first"), F.max("index").alias("last"), F.count("*").alias("n"), numeric.total("tas").alias("tas")
    )


#: Extent of a tile in the two dimensions, and the shape of the grid.
_TILE, _SHAPE = {"y": 8, "x": 16}, {"y": 31, "x": 61}


def _tiles(spark, sf):
    """Cells with the section of the tile that holds them: those of three centres are missing, and a tile repeats two rows of the one below."""
    y, x = ((F.col("lat") - 40) * 2).cast("int"), ((F.col("lon") + 90) * 2).cast("int")
    cells = substrate.grid(spark, sf).select(y.alias("y"), x.alias("x"), "tas")
    top, left = F.col("y") - F.col("y") % _TILE["y"], F.col("x") - F.col("x") % _TILE["x"]
    span = lambda a, b: F.concat(a.cast("string"), F.lit(":"), b.cast("string"))
    section = F.concat(span(top - F.when(top > 0, 2).otherwise(0), top + _TILE["y"] - 1), F.lit(","), span(left, left + _TILE["x"] - 1))
    return cells.where("not (y < 8 and x >= 48)").withColumn("section", section)


@query(
    "tile_cover",
    with_views(
        "grid",
        """WITH c AS (SELECT CAST((lat - 40) * 2 AS INT) AS y, CAST((lon + 90) * 2 AS INT) AS x FROM grid),
          t AS (SELECT DISTINCT y // 8 AS ty, x // 16 AS tx FROM c WHERE NOT (y < 8 AND x >= 48)),
          s AS (SELECT *, ty * 8 - CASE WHEN ty > 0 THEN 2 ELSE 0 END AS y_low, ty * 8 + 7 AS y_high, tx * 16 AS x_low, tx * 16 + 15 AS x_high FROM t),
          g AS (SELECT a.y, b.x FROM (SELECT unnest(range(0, 31)) AS y) a, (SELECT unnest(range(0, 61)) AS x) b),
          n AS (SELECT g.y, g.x, count(s.ty) AS k FROM g LEFT JOIN s ON g.y BETWEEN y_low AND y_high AND g.x BETWEEN x_low AND x_high GROUP BY 1, 2)
        SELECT (y // 16)::BIGINT AS y_block, (x // 32)::BIGINT AS x_block, count(*) AS n_cells, count(*) FILTER (k = 0) AS n_missing, count(*) FILTER (k > 1) AS n_overlapping FROM n GROUP BY 1, 2""",
    ),
)
def tile_cover(spark, sf):
    """Cells that no tile or several tiles hold."""
    tiles = virtual.tile_bounds(_tiles(spark, sf).select("section").distinct(), "section", ["y", "x"])
    return virtual.tile_cover(tiles, ["y", "x"], _SHAPE, {"y": 16, "x": 32})


@query(
    "tile_box",
    with_views(
        "grid",
        """WITH c AS (SELECT CAST((lat - 40) * 2 AS INT) AS y, CAST((lon + 90) * 2 AS INT) AS x, tas FROM grid)
        SELECT concat(y // 8 * 8 - CASE WHEN y >= 8 THEN 2 ELSE 0 END, ':', y // 8 * 8 + 7, ',', x // 16 * 16, ':', x // 16 * 16 + 15) AS section, count(*) AS n,
          CAST(sum(tas) AS DOUBLE) AS tas FROM c WHERE NOT (y < 8 AND x >= 48) AND y BETWEEN 5 AND 9 AND x BETWEEN 20 AND 40 GROUP BY 1""",
    ),
)
def tile_box(spark, sf):
    """A box of a cube that is laid out in a folder for each tile: only tiles that it touches are read."""
    path = os.path.join(new_dir(spark, "tiles"), "cube")
    _tiles(spark, sf).hint("rebalance", "section").write.partitionBy("section").parquet(path)
    cube = spark.read.parquet(path)
    box = {"y": (5, 9), "x": (20, 40)}
    hit = virtual.tiles_of_box(virtual.tile_bounds(cube.select("section").distinct(), "section", ["y", "x"]), box).select("section")
    inside = [F.col(d).between(a, b) for d, (a, b) in box.items()]
    return cube.join(hit, "section", "left_semi").where(inside[0] & inside[1]).groupBy("section").agg(F.count("*").alias("n"), numeric.total("tas").alias("tas"))
