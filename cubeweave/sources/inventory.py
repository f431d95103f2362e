"""File inventories: scans, members, facets, snapshots, catalogue walks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeweave.functions import names
from cubeweave.runtime import new_dir, released


def list_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """The files below ``root``: path, length, mtime. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select(
            F.regexp_replace("path", "^file:(//)?", "").alias("path"),
            "length",
            F.col("modificationTime").alias("mtime"),
        )
    )


def scan(
    inventory: DataFrame,
    location: str | Column,
    suffix: str | None = None,
    regexp: str | None = None,
    subdirs: bool | str = True,
    older_than: Column | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """The files a directory scan finds.

    ``suffix`` may be a glob and is matched as ``*<suffix>``; ``regexp`` must
    match the whole path as well; ``subdirs`` is a boolean or its text in any
    case; ``older_than`` is an interval before ``as_of``.
    """
    place = F.lit(location) if isinstance(location, str) else location
    deep = subdirs if isinstance(subdirs, bool) else subdirs.strip().lower() == "true"
    inside = F.col("path").startswith(F.concat(place, F.lit("/"))) if deep else names.parent("path") == place
    found = inventory.where(inside)
    if suffix is not None:
        found = found.where(ends_like(F.col("path"), suffix))
    if regexp is not None:
        found = found.where(F.col("path").rlike(f"^(?:{regexp.removesuffix('$')})$"))
    if older_than is not None:
        found = found.where(F.col("mtime") <= as_of - older_than)
    return found


def ends_like(path: Column, suffix: str) -> Column:
    """Whether a path ends in a suffix, which may be a glob."""
    if not any(c in suffix for c in "*?"):
        return path.endswith(suffix)
    return path.rlike(names.glob_to_regex("*" + suffix.lstrip("*")))


def date_mark(path: str | Column, pattern: str, date_format: str) -> Column:
    """A time taken from the file name: group 1 of ``pattern``, null when it does not parse."""
    return F.try_to_timestamp(F.regexp_extract(names.file_name(path), pattern, 1), F.lit(date_format))


def common_path(files: DataFrame, group: list[str], path: str = "path") -> DataFrame:
    """The deepest directory shared by all files of a group.

    What the first and the last path in component order share is shared by
    all between them, so a minimum and a maximum are enough.
    """
    shared = F.expr(
        "filter(transform(_low, (p, i) -> struct(i AS i, p AS p)), "
        "e -> slice(_low, 1, e.i + 1) = slice(_high, 1, e.i + 1))"
    )
    parts = F.split(F.col(path), "/")
    return (
        files.groupBy(*group)
        .agg(F.min(parts).alias("_low"), F.max(parts).alias("_high"), F.count("*").alias("n_files"))
        .select(
            *group,
            "n_files",
            F.when(F.col("_low") == F.col("_high"), F.array_join(names.dirs(F.array_join("_low", "/")), "/"))
            .otherwise(F.array_join(F.transform(shared, lambda e: e["p"]), "/"))
            .alias("common_path"),
        )
    )


def appeared(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the newer snapshot whose key the older one lacks."""
    return new.join(old.select(*key), key, "left_anti")


def walk(edges: DataFrame, roots: DataFrame, depth: int | None = 1) -> DataFrame:
    """Children of ``roots`` down to ``depth`` levels below the first; all levels when None.

    One join per level. Levels of a bounded walk form one lazy plan. An
    unbounded walk visits a node once for each root, at its least depth, so a
    cycle ends it; every level is kept in the shared folder, and the first empty one
    is the last.
    """
    level = roots.select(F.col("node").alias("root"), "node", F.lit(0).alias("depth"))
    if depth is None:
        return _levels(edges, level, level.limit(0))
    levels = []
    for d in range(depth + 1):
        level = _descend(level, edges, d)
        levels.append(level)
    return reduce(DataFrame.unionByName, levels) if levels else level.limit(0)


def walk_all(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Everything below ``roots`` at its least depth: root, node, depth. For any depth, number of levels and rows.

    The shortest way down to a node never comes to one of its own nodes again, so it is
    found without the other ways, whose number has no bound where nodes have several parents: each
    node is taken once for each root. A root is not below itself.
    """
    level = roots.select(F.col("node").alias("root"), "node", F.lit(0).alias("depth")).distinct()
    return _levels(edges, level, level)


def _descend(level: DataFrame, edges: DataFrame, d: int) -> DataFrame:
    return level.join(edges, level["node"] == edges["parent"]).select("root", F.col("child").alias("node"), F.lit(d).alias("depth"))


def _levels(edges: DataFrame, level: DataFrame, known: DataFrame) -> DataFrame:
    """All levels below ``level``, each without what is ``known`` and what the levels above hold."""
    spark, path, done = edges.sparkSession, new_dir(edges.sparkSession, "walk"), []
    known = known.select("root", "node")
    while True:
        found = _descend(level, edges, len(done)).dropDuplicates(["root", "node"])
        held = lambda *paths: spark.read.schema(found.schema).parquet(*paths)  # noqa: E731, B023
        above = known.unionByName(held(*done).select("root", "node")) if done else known
        found.join(above, ["root", "node"], "left_anti").write.parquet(f"{path}/{len(done)}")
        level = held(f"{path}/{len(done)}")
        if level.isEmpty():
            return held(*done) if done else level
        done.append(f"{path}/{len(done)}")


# fixed values: access services and the column each of them fills
SERVICES = {
    "httpserver": "http_url",
    "opendap": "odap_url",
    "ncml": "ncml_url",
    "uddc": "uddc_url",
    "iso": "iso_url",
    "wcs": "wcs_url",
    "wms": "wms_url",
}


def service_columns(urls: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, service, url) as one row per key; a missing service is the empty text."""
    wide = urls.groupBy(*key).pivot("service", list(SERVICES)).agg(F.first("url", ignorenulls=True))
    return wide.select(*key, *[F.coalesce(s, F.lit("")).alias(c) for s, c in SERVICES.items()])


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Read the snapshot at ``path``; make it from ``df`` first when there is none."""
    return kept(df.sparkSession, lambda: df, path)


def kept(spark: SparkSession, make: Callable[[], DataFrame], path: str, schema: str | None = None) -> DataFrame:
    """The same for rows that are not even planned when there is a snapshot.

    A mark is written after the rows. Rows without it are left over from a
    write that was broken off, and are written again.
    """
    try:
        # naming the columns saves a look into the files
        spark.read.schema("id bigint").parquet(f"{path}/done")
    except AnalysisException:
        rows = make()
        with released(spark):
            rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/done")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/rows")
