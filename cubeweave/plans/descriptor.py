"""From descriptor documents to the rows they describe, for many documents at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.sources import descriptors


def member_files(found: DataFrame, inventory: DataFrame, key: str = "doc_id") -> DataFrame:
    """The files of every document: key, path, label, and whether the inventory has them.

    label is the ``coordValue`` of the innermost member that the file's scan or
    list stands in, null where no level is stacked. Listed files that do not
    exist stay, as not found.
    """
    listed = descriptors.resolve(found, inventory, key).withColumn("_at", F.monotonically_increasing_id())
    labels = found.where((F.col("kind") == "member") & F.col("coord_value").isNotNull()).select(
        key, F.concat("node_path", F.lit("/netcdf["), F.col("ordinal").cast("string"), F.lit("]")).alias("_under"), "coord_value"
    )
    # a document has a handful of members with a label
    under = (F.col("node_path") == F.col("_under")) | F.startswith("node_path", F.concat("_under", F.lit("/")))
    labelled = listed.join(labels, key, "left").groupBy(key, "path", "_at").agg(
        F.max_by(F.when(under, F.col("coord_value")), F.when(under, F.length("_under"))).alias("label")
    )
    held = inventory.select("path", F.lit(True).alias("found"))
    return labelled.join(held, "path", "left").select(key, "path", "label", F.coalesce("found", F.lit(False)).alias("found"))


def renamed(found: DataFrame, kind: str, key: str = "doc_id") -> DataFrame:
    """Renames of one kind (variable, dimension) on the outermost level: key, org_name, name."""
    return found.where((F.col("kind") == kind) & F.col("org_name").isNotNull() & (F.col("node_path") == "/netcdf")).select(key, "org_name", "name")


def cells(
    found: DataFrame, inventory: DataFrame, rows: DataFrame, file: list[str], coords: list[str], key: str = "doc_id",
    held: DataFrame | None = None, value: Column | None = None,
) -> DataFrame:
    """The values of every document: key, label, coordinates, variable (renamed), value.

    ``rows`` holds stored values (file facets, coords, variable, value) and is
    read once for all documents. Values at the same coordinates of the same
    variable are added up; variables that a document removes at any level are left out.
    ``held`` is ``member_files`` if it is there already. Rows that hold all variables side by side come
    without variable and value, and ``value`` takes the value from them.
    """
    held = member_files(found, inventory, key) if held is None else held
    of = list(dict.fromkeys([*file, "variable"]))
    files = held.where("found").join(inventory.select("path", *of), "path")
    removed = found.where((F.col("kind") == "remove") & (F.col("type") == "variable")).select(key, F.col("name").alias("variable")).distinct()
    members = files.select(key, "label", *of).distinct().join(removed, [key, "variable"], "left_anti")
    read = members.join(rows, file).withColumn("value", F.col("value") if value is None else value)
    values = read.groupBy(key, "label", *coords, "variable").agg(F.sum("value").alias("value"))
    names = renamed(found, "variable", key).select(key, F.col("org_name").alias("variable"), F.col("name").alias("_new"))
    given = values.join(names, [key, "variable"], "left")
    return given.select(key, "label", *coords, F.coalesce("_new", "variable").alias("variable"), "value")
