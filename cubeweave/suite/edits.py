"""Projection and metadata edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeweave.functions import numeric, ordering, times
from cubeweave.operators import edit
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views


def _variable_rows(attrs, *extra):
    return attrs.where(F.col("scope") == "variable").select("dataset", "variable", "name", "value", *extra)


@query(
    "add_var_attr",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, variable, name,
          CASE WHEN variable = 'tas' AND name = 'units' THEN 'kelvin' ELSE value END AS value FROM attrs WHERE scope = 'variable'
        UNION ALL SELECT p_partkey, 'tas', 'units', 'kelvin' FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 = 0""",
    ),
)
def add_var_attr(spark, sf):
    return _variable_rows(edit.set_attribute(substrate.attrs(spark, sf), "variable", "tas", "units", F.lit("kelvin")))


@query(
    "remove_var_attr",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, variable, name, value FROM attrs a JOIN part p ON p_partkey = dataset
        WHERE scope = 'variable' AND NOT (variable = 'tas' AND name = CASE WHEN p_size % 2 = 0 THEN 'units' ELSE 'long_name' END)""",
    ),
)
def remove_var_attr(spark, sf):
    part = substrate.table(spark, sf, "part")

    def call(i, name):
        return F.struct(F.lit("tas").alias("variable"), F.lit(name).alias("name"), F.lit(i).alias("call"))

    # a second call on the same variable, for some datasets, takes the place of the first
    made = F.when(F.col("p_size") % 2 == 0, F.array(call(1, "long_name"), call(2, "units"))).otherwise(F.array(call(1, "long_name")))
    calls = part.select(F.col("p_partkey").alias("dataset"), F.inline(made))
    return _variable_rows(edit.remove_variable_attributes(substrate.attrs(spark, sf), calls))


@query(
    "rename_var",
    with_views(
        "grid",
        """SELECT realization, 't2m' AS variable, 'tas' AS org_name, CAST(sum(tas) AS DOUBLE) AS total FROM grid GROUP BY 1
        UNION ALL SELECT realization, 'pr', 'pr', CAST(sum(pr) AS DOUBLE) FROM grid GROUP BY 1""",
    ),
)
def rename_var(spark, sf):
    cube = edit.rename_variable(substrate.grid(spark, sf), "tas", "t2m")
    # a name the cube does not have is skipped with a warning
    if "zg" in cube.columns:
        cube = edit.rename_variable(cube, "zg", "height")
    variables = [c for c in cube.columns if c not in substrate.COORDS]
    wide = cube.groupBy("realization").agg(*[numeric.total(v).alias(v) for v in variables])
    origin = F.create_map(*[F.lit(x) for v in variables for x in (v, edit.original_name(cube, v))])
    return wide.unpivot("realization", variables, "variable", "total").withColumn("org_name", origin[F.col("variable")])


@query(
    "remove_var",
    with_views(
        "grid",
        """SELECT realization, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas, 'pr' AS removed, 'zg' AS absent FROM grid GROUP BY 1""",
    ),
)
def remove_var(spark, sf):
    full = substrate.grid(spark, sf)
    asked = ["pr", "zg"]
    present = [v for v in asked if v in full.columns]
    cube = full
    for v in present:
        cube = edit.remove_variable(cube, v)
    left = [c for c in cube.columns if c not in substrate.COORDS]
    return cube.groupBy("realization").agg(
        F.count("*").alias("n"),
        *[numeric.total(v).alias(v) for v in left],
        F.lit(",".join(present)).alias("removed"),
        F.lit(",".join(v for v in asked if v not in present)).alias("absent"),
    )


@query(
    "rename_var_attr",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, variable, value,
          CASE WHEN variable = 'tas' AND name = 'long_name' THEN 'description' ELSE name END AS name,
          CASE WHEN variable = 'tas' AND name = 'long_name' THEN 'long_name' END AS org_name FROM attrs WHERE scope = 'variable'""",
    ),
)
def rename_var_attr(spark, sf):
    changed = edit.rename_variable_attribute(substrate.attrs(spark, sf), "tas", "long_name", "description")
    return _variable_rows(changed, "org_name")


@query(
    "rename_dim",
    with_views("grid", "SELECT lat AS rlat, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas FROM grid GROUP BY 1"),
)
def rename_dim(spark, sf):
    cube = edit.rename_dimension(substrate.grid(spark, sf), "lat", "rlat")
    return cube.groupBy("rlat").agg(F.count("*").alias("n"), numeric.total("tas").alias("tas"))


def _global_rows(attrs):
    return attrs.where(F.col("scope") == "global").select("dataset", "name", "value")


@query(
    "add_ds_attr",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, name, CASE WHEN name = 'type' THEN 'reanalysis' ELSE value END AS value
        FROM attrs WHERE scope = 'global' UNION ALL SELECT p_partkey, 'history', 'edited' FROM part""",
    ),
)
def add_ds_attr(spark, sf):
    given = substrate.attrs(spark, sf)
    replaced = edit.set_attribute(given, "global", None, "type", F.lit("reanalysis"))
    return _global_rows(edit.set_attribute(replaced, "global", None, "history", F.lit("edited")))


@query(
    "remove_ds_attr",
    with_views(
        "attrs",
        "SELECT CAST(dataset AS BIGINT) AS dataset, name, value FROM attrs WHERE scope = 'global' AND name <> 'title'",
    ),
)
def remove_ds_attr(spark, sf):
    once = edit.remove_dataset_attribute(substrate.attrs(spark, sf), "title")
    return _global_rows(edit.remove_dataset_attribute(once, "title"))


@query(
    "bulk_attrs",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, CASE WHEN name = 'institute' THEN 'institution_id' ELSE name END AS name,
          CASE WHEN name = 'license_type' THEN 'restricted' ELSE value END AS value FROM attrs WHERE scope = 'global'
        UNION ALL SELECT p_partkey, 'project_id', 'P1' FROM part""",
    ),
)
def bulk_attrs(spark, sf):
    given = {"license_type": {"value": "restricted"}, "institution_id": {"orgName": "institute"}, "project_id": {"value": "P1"}}
    return _global_rows(edit.apply_attributes(substrate.attrs(spark, sf), given))


@query(
    "bulk_remove",
    with_views(
        "attrs grid",
        """SELECT scope, coalesce(variable, '') AS variable, name, count(*) AS n FROM attrs
        WHERE NOT (scope = 'global' AND name IN ('type', '_hidden')) AND NOT (scope = 'variable' AND variable = 'pr') GROUP BY 1, 2, 3
        UNION ALL SELECT 'cube', 'tas', realization, count(tas) FROM grid GROUP BY 3""",
    ),
)
def bulk_remove(spark, sf):
    items = {"type": "attribute", "_hidden": "attribute", "pr": "variable", "time_bnds": "variable"}
    left = edit.remove_items(substrate.attrs(spark, sf), items)
    rows = left.groupBy("scope", F.coalesce("variable", F.lit("")).alias("variable"), "name").agg(F.count("*").alias("n"))
    cube = edit.drop_items(substrate.grid(spark, sf), items)
    kept = [c for c in cube.columns if c not in substrate.COORDS]
    cells = cube.groupBy(F.col("realization").alias("name")).agg(*[F.count(v).alias(v) for v in kept])
    cells = cells.unpivot("name", kept, "variable", "n").withColumn("scope", F.lit("cube"))
    return rows.unionByName(cells)


@query(
    "scenario_prefix",
    with_views(
        "records",
        "SELECT center, year, "
        + ", ".join(
            f"CAST(sum(value) FILTER (exp = '{e}' AND variable = '{v}') AS DOUBLE) AS {e}_{v}"
            for e in ("ssp245", "ssp585")
            for v in ("tas", "pr")
        )
        + ", CAST(sum(value) FILTER (exp = 'ssp245' AND variable = 'tas') AS DOUBLE) AS tas"
        " FROM records WHERE exp <> 'historical' GROUP BY 1, 2",
    ),
)
def scenario_prefix(spark, sf):
    future = substrate.records(spark, sf).where(F.col("exp") != "historical")
    wide = edit.scenario_columns(future, ["center", "year"], ["ssp245", "ssp585"], ["tas", "pr"])
    wide = wide.select("center", F.col("year").cast("bigint"), *[F.col(c).cast("double") for c in wide.columns[2:]])
    alone = edit.without_prefix(wide.select("center", "year", "ssp245_tas"), "ssp245").columns[-1]
    return wide.withColumn(alone, F.col("ssp245_tas"))


@query(
    "cond_attr",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, name,
          CASE WHEN p_brand = 'Brand#13' AND name = 'institute' THEN 'NCC'
               WHEN p_brand = 'Brand#13' AND name = 'license_type' THEN 'open' ELSE value END AS value
        FROM attrs JOIN part ON p_partkey = dataset WHERE scope = 'global'""",
    ),
)
def cond_attr(spark, sf):
    given = substrate.attrs(spark, sf).where(F.col("scope") == "global")
    brand = given.where(F.col("name") == "institute").select("dataset", F.col("value").alias("brand"))
    known = given.join(brand, "dataset")
    changed = edit.override_for(known, F.col("brand") == "Brand#13", {"institute": "NCC", "license_type": "open"})
    return changed.select("dataset", "name", "value")


@query(
    "delta_expand",
    with_views(
        "members",
        """SELECT DISTINCT center, concat(exp, '_', variable, s.suffix) AS name FROM members,
          (VALUES (''), ('_delta_1971_2000'), ('_delta_1991_2020'), ('_delta_1971_2000_delta_1991_2020')) s(suffix)
        WHERE exp <> 'historical'""",
    ),
)
def delta_expand(spark, sf):
    held = substrate.records(spark, sf).where(F.col("exp") != "historical").select("center", "exp", "variable").distinct()
    return held.select("center", F.explode(edit.with_deltas(F.concat_ws("_", "exp", "variable"))).alias("name"))


_INDEXED = """i AS (SELECT *, dense_rank() OVER (ORDER BY lat) - 1 AS ilat, dense_rank() OVER (ORDER BY lon) - 1 AS ilon,
          dense_rank() OVER (ORDER BY time) - 1 AS itime FROM grid)"""


@query(
    "logical_section",
    with_views(
        "grid",
        f"""WITH {_INDEXED} SELECT realization, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas, min(lat) AS lat_min,
          max(lon) AS lon_max, strftime(min(time), '%Y-%m-%d') AS first FROM i
        WHERE ilat BETWEEN 2 AND 20 AND ilon BETWEEN 5 AND 40 AND itime BETWEEN 100 AND 1500 GROUP BY 1""",
    ),
)
def logical_section(spark, sf):
    ranges = {"lat": (2, 20), "lon": (5, 40), "time": (100, 1500)}
    cut = edit.cut(substrate.grid(spark, sf), substrate.points(spark, sf), ranges)
    return cut.groupBy("realization").agg(
        F.count("*").alias("n"),
        numeric.total("tas").alias("tas"),
        F.min("lat").alias("lat_min"),
        F.max("lon").alias("lon_max"),
        times.day_text(F.min("time")).alias("first"),
    )


@query(
    "logical_slice",
    with_views(
        "grid",
        f"""WITH {_INDEXED} SELECT realization, lon, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas FROM i WHERE ilat = 3 GROUP BY 1, 2""",
    ),
)
def logical_slice(spark, sf):
    cut = edit.cut(substrate.grid(spark, sf), substrate.points(spark, sf), {"lat": (3, 3)}).drop("lat")
    by = [c for c in cut.columns if c in ("realization", "lat", "lon")]
    return cut.groupBy(*by).agg(F.count("*").alias("n"), numeric.total("tas").alias("tas"))


@query(
    "logical_reduce",
    with_views(
        "grid",
        f"""WITH {_INDEXED}, s AS (SELECT * FROM i WHERE ilat = 3),
          d AS (SELECT realization, concat_ws(',', CASE WHEN min(lat) = max(lat) THEN 'lat' END, CASE WHEN min(lon) = max(lon) THEN 'lon' END) AS reduced FROM s GROUP BY 1)
        SELECT realization, lon, reduced, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas FROM s JOIN d USING (realization) GROUP BY 1, 2, 3""",
    ),
)
def logical_reduce(spark, sf):
    """One latitude of every realization, without the dimensions that have one value in it."""
    row = edit.cut(substrate.grid(spark, sf), substrate.points(spark, sf), {"lat": (3, 3)})
    single = edit.single_dimensions(row, ["realization"], ["lat", "lon"])
    left = edit.drop_single(row, ["lat"]).join(single, "realization")
    return left.groupBy("realization", "lon", F.array_join("single", ",").alias("reduced")).agg(F.count("*").alias("n"), numeric.total("tas").alias("tas"))


@query(
    "values_sequence",
    """SELECT p_partkey AS dataset, count(*) AS npts, CAST(max(v) AS DOUBLE) AS last, CAST(sum(v) AS DOUBLE) AS total FROM (
      SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) + i * CAST(0.5 AS DECIMAL(3,2)) AS v
      FROM part, range(0, 50) r(i) WHERE i < p_size) GROUP BY 1""",
)
def values_sequence(spark, sf):
    step = F.lit("0.5").cast("decimal(3,2)")
    made = edit.generated(substrate.money("p_retailprice"), step, F.col("p_size"))
    points = substrate.table(spark, sf, "part").select(F.col("p_partkey").alias("dataset"), F.explode(made).alias("v"))
    return points.groupBy("dataset").agg(
        F.count("*").alias("npts"), F.max("v").cast("double").alias("last"), numeric.total("v").alias("total")
    )


@query(
    "values_list",
    """SELECT CAST(pos AS BIGINT) AS pos, v AS value, CAST(TRY_CAST(v AS INTEGER) AS BIGINT) AS number, count(*) AS n FROM (
      SELECT unnest(string_split(o_orderpriority, '-')) AS v, generate_subscripts(string_split(o_orderpriority, '-'), 1) - 1 AS pos
      FROM orders) GROUP BY 1, 2, 3""",
)
def values_list(spark, sf):
    values = substrate.table(spark, sf, "orders").select(F.posexplode(edit.split_values("o_orderpriority", "-")).alias("pos", "value"))
    number = F.col("value").try_cast("int").cast("bigint").alias("number")
    return values.groupBy(F.col("pos").cast("bigint").alias("pos"), "value", number).agg(F.count("*").alias("n"))


@query(
    "enum_decode",
    """SELECT l_returnflag AS code, label, count(*) AS n FROM lineitem
    LEFT JOIN (VALUES ('A', 'accepted'), ('N', 'none')) e(code, label) ON code = l_returnflag GROUP BY 1, 2""",
)
def enum_decode(spark, sf):
    label = edit.decode_enum(F.col("l_returnflag"), {"A": "accepted", "N": "none"})
    return (
        substrate.table(spark, sf, "lineitem")
        .groupBy(F.col("l_returnflag").alias("code"))
        .agg(F.count("*").alias("n"), F.first(label).alias("label"))
    )


@query(
    "explicit_schema",
    with_views(
        "grid",
        """SELECT realization, year(time) AS year, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas, 3::BIGINT AS n_columns
        FROM grid GROUP BY 1, 2""",
    ),
)
def explicit_schema(spark, sf):
    declared = edit.explicit(substrate.grid(spark, sf), ["time", "realization", "tas", "not_there"])
    return declared.groupBy("realization", F.year("time").cast("bigint").alias("year")).agg(
        F.count("*").alias("n"),
        numeric.total("tas").alias("tas"),
        F.lit(len(declared.columns)).cast("bigint").alias("n_columns"),
    )


@query(
    "enhance_unpack",
    with_views(
        "grid",
        """SELECT realization, count(*) AS n, count(*) FILTER (tas % 7 = 0) AS n_missing,
          CAST(sum(tas + 273) FILTER (tas % 7 <> 0) AS DOUBLE) AS tas FROM grid GROUP BY 1""",
    ),
)
def enhance_unpack(spark, sf):
    # hundredths as whole numbers; every value divisible by seven is missing
    packed = F.when(F.col("tas") % 7 == 0, F.lit(-32768)).otherwise((F.col("tas") * 100).cast("bigint"))
    stored = substrate.grid(spark, sf).select("realization", packed.alias("packed"))
    value = edit.unpack(
        F.col("packed").cast("decimal(18,0)"), F.lit("0.01").cast("decimal(3,2)"), F.lit("273").cast("decimal(5,2)"), F.lit(-32768)
    )
    return stored.select("realization", value.alias("tas")).groupBy("realization").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("tas").isNull()).alias("n_missing"),
        numeric.total("tas").alias("tas"),
    )


@query(
    "unsigned_promote",
    """SELECT l_returnflag AS code, CAST(sum(l_partkey % 256) AS BIGINT) AS total, CAST(max(l_partkey % 256) AS BIGINT) AS largest
    FROM lineitem GROUP BY 1""",
)
def unsigned_promote(spark, sf):
    signed = ((F.col("l_partkey") + 128) % 256 - 128).cast("tinyint")
    stored = substrate.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("code"), signed.alias("v"))
    promoted = stored.withColumn("v", edit.as_unsigned(F.col("v"), "tinyint"))
    return promoted.groupBy("code").agg(
        F.sum("v").cast("bigint").alias("total"), F.max("v").cast("bigint").alias("largest")
    )


@query(
    "group_flatten",
    """SELECT p_partkey AS id, p_name AS station_name, CAST(p_size AS BIGINT) AS station_site_size, p_brand AS station_site_brand FROM part""",
)
def group_flatten(spark, sf):
    site = F.struct(F.col("p_size").cast("bigint").alias("size"), F.col("p_brand").alias("brand"))
    nested = substrate.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.struct(F.col("p_name").alias("name"), site.alias("site")).alias("station")
    )
    return edit.flatten_groups(nested)


@query(
    "sequence_explode",
    """WITH o AS (SELECT *, o_orderkey % 4 AS n FROM orders)
    SELECT o_orderkey AS id, CAST(i AS BIGINT) AS step, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * i AS DOUBLE) AS level
    FROM o LEFT JOIN range(1, 4) r(i) ON i <= n""",
)
def sequence_explode(spark, sf):
    steps = F.when(F.col("o_orderkey") % 4 > 0, F.sequence(F.lit(1).cast("bigint"), F.col("o_orderkey") % 4))
    profile = F.transform(
        F.coalesce(steps, F.array().cast("array<bigint>")),
        lambda i: F.struct(i.alias("step"), (substrate.money("o_totalprice") * i).cast("double").alias("level")),
    )
    nested = substrate.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), profile.alias("profile"))
    return edit.unnest(nested, "profile")


@query(
    "canonical_order",
    with_views(
        "grid",
        """WITH r AS (SELECT *, row_number() OVER (ORDER BY realization, time, lat, lon) - 1 AS place FROM grid)
        SELECT realization, 'realization,time,lat,lon,tas,pr' AS columns, min(place) AS first_place, max(place) AS last_place,
          CAST(sum(place * (lat - 39)) AS DOUBLE) AS checksum FROM r GROUP BY 1""",
    ),
)
def canonical_order(spark, sf):
    cube = edit.canonical(substrate.grid(spark, sf), ["realization", "time", "lat", "lon"])
    columns = ",".join(cube.columns)
    placed = ordering.place(cube, ["realization", "time", "lat", "lon"], "place")
    return placed.groupBy("realization").agg(
        F.lit(columns).alias("columns"),
        F.min("place").alias("first_place"),
        F.max("place").alias("last_place"),
        F.sum(F.col("place") * (F.col("lat") - 39)).alias("checksum"),
    )
