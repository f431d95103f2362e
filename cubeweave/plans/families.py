"""Dataset families: one pipeline from a file inventory to the members of virtual datasets.

A family is a row of configuration. The pipeline excludes files, tests
completeness, gathers members, names datasets and attaches fixed fields;
what differs between families is which facets it does that with. The result
is the content of the descriptors: one row per scan or listed file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.functions import names
from cubeweave.operators import select, virtual
from cubeweave.sources import inventory as inv


@dataclass(frozen=True)
class Family:
    """How the datasets of one family are put together."""

    # facets whose values make one dataset
    dataset: tuple[str, ...]
    # variables a dataset must have, in output order; empty: those found
    variables: tuple[str, ...] = ()
    # facets of the level at which the variables are tested; None: no test
    gate: tuple[str, ...] | None = None
    # scenario chains such as "historical+ssp245"; empty: each scenario for itself
    chains: tuple[str, ...] = ()
    # directories | pattern | common | regexp | files | first
    members: str = "directories"
    # facets joined by ":" into the label of a stacked member
    realization: tuple[str, ...] = ()
    # files left out, by facet values and by fragments of the name
    skip: dict[str, list[str]] = field(default_factory=dict)
    fragments: tuple[str, ...] = ()
    # a fragment files must have (True) or must lack (False)
    token: tuple[str, bool] | None = None
    # allowed number of files per dataset and variable; rows of others carry their ``problem``
    bounds: tuple[int, int | None] | None = None
    # the variable that comes first, and the one that stands in for it
    primary: tuple[str, str] | None = None
    # where fixed fields go: "first" | "last"
    fixed: str | None = None
    # variables removed from members inside the aggregation
    removed: tuple[str, ...] = ()
    # whether variables carry their scenario as a prefix
    prefix: bool = False
    # whether listed files are numbered, and the coarse order key for datasets with many files
    ordered: bool = True
    coarse: str | None = None


def build(files: DataFrame, family: Family, fixed: DataFrame | None = None) -> DataFrame:
    """The member table of a family. ``files`` has facet columns, ``path`` and ``ncoords``;
    ``fixed`` has the dataset facets it applies to and ``path``."""
    kept = select.exclude(files, family.skip, list(family.fragments))
    if family.token is not None:
        kept = select.by_token(kept, "path", *family.token)
    if family.variables:
        kept = kept.where(F.col("variable").isin(*family.variables))
    rows = _MEMBERS[family.members](kept, family)
    rows = _gated(rows, kept, family)
    if family.bounds is not None:
        outside = select.outside_bounds(kept, [*family.dataset, "variable"], *family.bounds)
        rows = rows.join(outside.select(*family.dataset, "variable", "problem"), [*family.dataset, "variable"], "left")
    if family.realization:
        rows = rows.withColumn("realization", F.concat_ws(":", *family.realization))
    if family.primary is not None:
        places = select.primary_first(kept, list(family.dataset), *family.primary)
        rows = rows.join(places, [*family.dataset, "variable"])
    if family.prefix:
        bare = F.col("variable")
        named = F.when(F.contains(bare, F.col("exp")), bare).otherwise(F.concat_ws("_", "exp", bare))
        rows = rows.withColumns({"org_name": bare, "variable": named})
    if family.removed:
        rows = rows.withColumn("removed", F.lit(",".join(family.removed)))
    if fixed is not None and family.fixed is not None:
        rows = _with_fixed(rows, fixed, family)
    return rows


def _gated(rows: DataFrame, files: DataFrame, family: Family) -> DataFrame:
    if family.gate is None:
        return rows
    level = list(family.gate)
    if not family.chains:
        return rows.join(select.all_variables(files, level, list(family.variables)), level, "left_semi")
    passed = reduce(
        DataFrame.unionByName,
        [select.surviving_runs(files, level, c, list(family.variables)) for c in family.chains],
    )
    return rows.join(passed, [*level, "chain"], "left_semi")


def _directories(files: DataFrame, family: Family) -> DataFrame:
    """One scan per variable directory and part of the chain. Directories are
    those of the first part; the others differ in the name of the part only."""
    first = family.chains[0].split("+")[0]
    facets = [c for c in files.columns if c in (*family.dataset, *family.realization, *(family.gate or ()))]
    found = files.where(F.col("exp") == first).select(
        *dict.fromkeys([*facets, "variable"]), names.parent("path").alias("_dir")
    ).distinct()
    parts = F.array(
        *[
            F.struct(F.lit(c).alias("chain"), F.lit(i).alias("part"), F.lit(p).alias("exp"))
            for c in family.chains
            for i, p in enumerate(c.split("+"))
        ]
    )
    spread = found.drop("exp").select("*", F.inline(parts))
    place = F.replace(F.col("_dir"), F.lit(f"/{first}/"), F.concat(F.lit("/"), F.col("exp"), F.lit("/")))
    return spread.withColumn("location", place).drop("_dir")


def _groups(files: DataFrame, family: Family) -> list[str]:
    facets = [*family.dataset, *family.realization, *(family.gate or ())]
    return list(dict.fromkeys([*facets, *(["exp"] if family.prefix else []), "variable"]))


def _pattern(files: DataFrame, family: Family) -> DataFrame:
    """One scan per variable over a directory that holds them all."""
    grouped = files.groupBy(*_groups(files, family)).agg(F.count("*").alias("n_files"), F.min("path").alias("_any"))
    up_two = names.parent(names.parent(names.parent("_any")))
    return grouped.withColumns(
        {"location": up_two, "suffix": F.concat(F.col("variable"), F.lit("_*.nc"))}
    ).drop("_any")


def _common(files: DataFrame, family: Family) -> DataFrame:
    """One scan per variable over the deepest directory its files share."""
    shared = inv.common_path(files, _groups(files, family)).withColumnRenamed("common_path", "location")
    return shared.withColumn("suffix", F.concat(F.col("variable"), F.lit("_*.nc")))


def _regexp(files: DataFrame, family: Family) -> DataFrame:
    """One scan per variable by a regular expression; the plus sign of names is escaped."""
    counted = files.groupBy(*_groups(files, family)).agg(F.count("*").alias("n_files"), F.min("path").alias("_any"))
    facets = [F.replace(F.col(c), F.lit("+"), F.lit(r"\+")) for c in family.dataset if c in ("exp", "run")]
    pattern = F.concat(F.lit(".*"), F.col("variable"), F.lit("_.*"), F.concat_ws(".*", *facets), F.lit(".*"))
    top = F.array_join(F.slice(F.split("_any", "/"), 1, 5), "/")
    return counted.withColumns({"location": top, "regexp": pattern, "suffix": F.lit(".nc")}).drop("_any")


def _files(files: DataFrame, family: Family) -> DataFrame:
    """The files themselves, with their step counts; in name order when that matters."""
    group = _groups(files, family)
    coarse = [family.coarse] if family.coarse else []
    listed = files.select(*dict.fromkeys([*group, *coarse, "path", "ncoords"]))
    if family.ordered:
        listed = virtual.member_list(listed, group, ["path"], coarse=family.coarse)
    return listed.withColumnRenamed("path", "location")


def _first(files: DataFrame, family: Family) -> DataFrame:
    """The first file by name."""
    return select.first_match(files, _groups(files, family)).withColumnRenamed("path", "location")


_MEMBERS = {
    "directories": _directories, "pattern": _pattern, "common": _common, "regexp": _regexp, "files": _files, "first": _first,
}


def _with_fixed(rows: DataFrame, fixed: DataFrame, family: Family) -> DataFrame:
    """Fixed-field files before or after the members of every dataset they apply to."""
    on = [c for c in fixed.columns if c in family.dataset]
    datasets = rows.select(*family.dataset).distinct()
    extra = datasets.join(fixed, on).select(*family.dataset, F.lit("fx").alias("variable"), F.col("path").alias("location"))
    block = {"first": 0, "last": 2}[family.fixed]
    return rows.withColumn("block", F.lit(1)).unionByName(extra.withColumn("block", F.lit(block)), allowMissingColumns=True)


def name_of(files: DataFrame, family: Family, characters: int | None = None) -> DataFrame:
    """Dataset names: the middle of the first file's name, and the period of the first variable's files."""
    group = list(family.dataset)
    first = files
    if family.primary is not None:
        # files of the primary variable, or of the second choice where there are none
        places = select.primary_first(files, group, *family.primary).where(F.col("place") == 0)
        first = files.join(places.select(*group, "variable"), [*group, "variable"], "left_semi")
    elif family.variables:
        first = files.where(F.col("variable") == family.variables[0])
    parts = F.split(names.stem("path"), "_")
    middle = F.array_join(F.slice(parts, 2, F.size(parts) - 2), "_")
    span = F.split(F.element_at(parts, -1), "-")
    start, end = F.element_at(span, 1), F.element_at(span, -1)
    if characters is not None:
        start, end = F.left(start, F.lit(characters)), F.left(end, F.lit(characters))
    dated = first.select(*group, "path", middle.alias("_middle"), start.alias("_start"), end.alias("_end"))
    return dated.groupBy(*group).agg(
        F.concat_ws("_", F.min_by("_middle", "path"), select.period("_start", "_end", "path")).alias("dataset")
    )


def run_token(path: str | Column, exp: str | Column) -> Column:
    """The part of a file name that follows its scenario."""
    marker = F.concat(names.col(exp), F.lit("_"))
    after = F.call_function("substring_index", names.stem(path), marker, F.lit(-1))
    return F.substring_index(after, "_", 1)
