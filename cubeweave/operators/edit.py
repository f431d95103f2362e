"""Metadata edits, on cubes (columns) and on attribute tables (rows).

An attribute table has the columns dataset, scope, variable, pos, name, value.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.functions import ordering

# fixed values: scenario names that never become a prefix
NO_PREFIX = ("allrcps", "nrcan")
# fixed values: suffixes of change-from-period variables
DELTAS = ("_delta_1971_2000", "_delta_1991_2020")


def _same(scope: str, variable: str | None, name: str) -> Column:
    return (F.col("scope") == scope) & F.col("variable").eqNullSafe(F.lit(variable)) & (F.col("name") == name)


def set_attribute(attrs: DataFrame, scope: str, variable: str | None, name: str, value: Column) -> DataFrame:
    """Add or replace one attribute of every dataset.

    A variable attribute is added where the dataset has variables, and makes
    the variable when it is missing; a dataset without variables stays as it is.
    """
    same = _same(scope, variable, name)
    # one row per dataset, from a partial aggregate
    state = attrs.groupBy("dataset").agg(
        F.bool_or(same).alias("_has"),
        F.bool_or(F.col("scope") == scope).alias("_any"),
        F.max("pos").alias("_pos"),
    )
    new = state.where(~F.col("_has") & (F.col("_any") | F.lit(scope == "global")))
    added = new.select(
        "dataset",
        F.lit(scope).alias("scope"),
        F.lit(variable).cast("string").alias("variable"),
        (F.col("_pos") + 1).alias("pos"),
        F.lit(name).alias("name"),
        value.alias("value"),
    )
    return attrs.withColumn("value", F.when(same, value).otherwise(F.col("value"))).unionByName(added)


def remove_variable_attributes(attrs: DataFrame, calls: DataFrame) -> DataFrame:
    """Remove attributes of variables. ``calls`` is (dataset, variable, name, call);
    a variable keeps one removal, that of the last call."""
    kept = calls.groupBy("dataset", "variable").agg(F.max_by("name", "call").alias("name"))
    return attrs.join(kept, ["dataset", "variable", "name"], "left_anti")


def remove_dataset_attribute(attrs: DataFrame, name: str) -> DataFrame:
    return attrs.where(~_same("global", None, name))


def rename_variable(cube: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a variable; its first name stays in the column's metadata."""
    if old not in cube.columns:
        warnings.warn(f"no variable {old}, nothing renamed", stacklevel=2)
        return cube
    metadata = {**cube.schema[old].metadata, "orgName": cube.schema[old].metadata.get("orgName", old)}
    return cube.withColumnRenamed(old, new).withMetadata(new, metadata)


def original_name(cube: DataFrame, variable: str) -> str:
    return cube.schema[variable].metadata.get("orgName", variable)


def rename_dimension(cube: DataFrame, old: str, new: str) -> DataFrame:
    return rename_variable(cube, old, new)


def remove_variable(cube: DataFrame, name: str) -> DataFrame:
    if name not in cube.columns:
        warnings.warn(f"no variable {name}, nothing removed", stacklevel=2)
    return cube.drop(name)


def rename_variable_attribute(attrs: DataFrame, variable: str, old: str, new: str) -> DataFrame:
    """Rename an attribute of a variable and keep its first name in ``org_name``."""
    same = _same("variable", variable, old)
    have = F.col("org_name") if "org_name" in attrs.columns else F.lit(None).cast("string")
    return attrs.withColumn("org_name", F.when(same, F.lit(old)).otherwise(have)).withColumn(
        "name", F.when(same, F.lit(new)).otherwise(F.col("name"))
    )


def apply_attributes(attrs: DataFrame, given: dict[str, dict[str, str]]) -> DataFrame:
    """A set of dataset attributes: ``{"value": v}`` sets one, ``{"orgName": n}`` renames one."""
    name, top = F.col("name"), F.col("scope") == "global"
    renames = {how["orgName"]: target for target, how in given.items() if "value" not in how and "orgName" in how}
    changed = attrs
    if renames:
        new = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])[name]
        changed = changed.withColumn("name", F.when(top, F.coalesce(new, name)).otherwise(name))
    for target, how in given.items():
        if "value" in how:
            changed = set_attribute(changed, "global", None, target, F.lit(how["value"]))
    return changed


def remove_items(attrs: DataFrame, items: dict[str, str]) -> DataFrame:
    """Rows left after a removal list: attributes of the dataset, whole variables, whole groups."""
    left = attrs
    for name, kind in items.items():
        if kind == "attribute":
            left = left.where(~_same("global", None, name))
        elif kind == "variable":
            left = left.where(~((F.col("scope") == "variable") & (F.col("variable") == name)))
        elif kind == "group":
            left = left.where(~((F.col("scope") == "group") & (F.col("variable") == name)))
    return left


def drop_items(cube: DataFrame, items: dict[str, str]) -> DataFrame:
    """Columns left after a removal list; absent names are ignored."""
    return cube.drop(*[n for n, kind in items.items() if kind in ("variable", "dimension")])


def prefixed(exp: str, variable: str) -> str:
    """Name of a variable that carries its scenario."""
    return variable if exp in variable or exp in NO_PREFIX else f"{exp}_{variable}"


def scenario_columns(rows: DataFrame, keys: list[str], exps: list[str], variables: list[str], value: str = "value") -> DataFrame:
    """One column per scenario and variable, from long rows (exp, variable, value)."""
    cells = [
        F.sum(F.when((F.col("exp") == e) & (F.col("variable") == v), F.col(value))).alias(prefixed(e, v))
        for e in exps
        for v in variables
    ]
    return rows.groupBy(*keys).agg(*cells)


def without_prefix(cube: DataFrame, exp: str) -> DataFrame:
    """The variables of one scenario under their own names."""
    return cube.withColumnsRenamed({c: c.removeprefix(f"{exp}_") for c in cube.columns if c.startswith(f"{exp}_")})


def override_for(attrs: DataFrame, where: Column, values: dict[str, str]) -> DataFrame:
    """Attributes of the rows that meet a condition get fixed values."""
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    hit = where & pairs[F.col("name")].isNotNull()
    return attrs.withColumn("value", F.when(hit, pairs[F.col("name")]).otherwise(F.col("value")))


def with_deltas(variable: str | Column) -> Column:
    """A name and its change variables; the second suffix covers the first one's results."""
    v = F.col(variable) if isinstance(variable, str) else variable
    first, second = DELTAS
    names = [v, F.concat(v, F.lit(first))]
    return F.array(*names, *[F.concat(n, F.lit(second)) for n in names])


def section(cube: DataFrame, axes: dict[str, DataFrame], ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Keep an index range, both ends inclusive, of each dimension.

    ``axes`` holds the index of every value of a dimension.
    """
    picked = [
        (dim, axes[dim].where(F.col("index").between(a, b)).select(dim)) for dim, (a, b) in ranges.items()
    ]
    return reduce(lambda df, p: df.join(p[1], p[0], "left_semi"), picked, cube)


def slice_at(cube: DataFrame, axis: DataFrame, dim: str, index: int) -> DataFrame:
    """Fix one dimension at an index and drop it."""
    return section(cube, {dim: axis}, {dim: (index, index)}).drop(dim)


def coarse(rows: DataFrame, dim: str) -> Column:
    """A part of a dimension's order that many of its values share."""
    kind = rows.schema[dim].dataType.typeName()
    if kind.startswith(("timestamp", "date")):
        return F.year(dim)
    whole = kind in ("byte", "short", "integer", "long")
    return F.floor(F.col(dim) / F.lit(1024)) if whole else F.floor(dim)


def axis(rows: DataFrame, dim: str) -> DataFrame:
    """The 0-based index of every value of a dimension."""
    return ordering.axis_index(rows.select(dim), dim, coarse(rows, dim))


def _is_time(rows: DataFrame, dim: str) -> bool:
    return rows.schema[dim].dataType.typeName().startswith("timestamp")


def index_bounds(rows: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """The values at both ends of an index range of each dimension, as one row: <dim>_low, <dim>_high.

    One pass over ``rows`` gives the axes of all dimensions. Times count in microseconds.
    """
    number = {d: F.unix_micros(F.col(d).cast("timestamp")).cast("double") if _is_time(rows, d) else F.col(d).cast("double") for d in ranges}
    parts = F.array(*[F.struct(F.lit(d).alias("dim"), number[d].alias("value"), coarse(rows, d).cast("bigint").alias("coarse")) for d in ranges])
    axes = rows.select(F.inline(parts)).distinct()
    placed = ordering.position(axes, ["dim"], "coarse", ["value"], "index")
    mine = {d: F.when((F.col("dim") == d) & F.col("index").between(a, b), F.col("value")) for d, (a, b) in ranges.items()}
    ends = [f(mine[d]).alias(f"{d}_{n}") for d in ranges for f, n in ((F.min, "low"), (F.max, "high"))]
    return placed.agg(*ends)


def cut(cube: DataFrame, rows: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """``section`` as a comparison of values: index ranges of the axes of ``rows`` become bounds.

    The bounds are scalars known before the cube is read, so no join is needed.
    """
    ends = index_bounds(rows, ranges)

    def bound(d: str, n: str) -> Column:
        value = ends.select(f"{d}_{n}").scalar()
        return F.timestamp_micros(value.cast("bigint")).cast("timestamp_ntz") if _is_time(cube, d) else value

    return reduce(lambda df, d: df.where(F.col(d).between(bound(d, "low"), bound(d, "high"))), ranges, cube)


def single_dimensions(cube: DataFrame, group: list[str], dims: list[str]) -> DataFrame:
    """Which dimensions have one value in each group: the group, single (in the order of ``dims``)."""
    one = F.array_compact(F.array(*[F.when(F.min(d) == F.max(d), F.lit(d)) for d in dims]))
    return cube.groupBy(*group).agg(one.alias("single"))


def generated(start: Column, increment: Column, npts: Column) -> Column:
    """``start + i * increment`` for i below ``npts``."""
    steps = F.when(npts > 0, F.sequence(F.lit(0), npts - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: start + i * increment)


def split_values(text: str | Column, separator: str = " ") -> Column:
    """Literal values of a variable or a multi-value attribute."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(t, F.lit(separator.replace("|", r"\|") if separator == "|" else separator))


def decode_enum(code: Column, labels: dict) -> Column:
    """Label of a code, null when it has none."""
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[code]


def explicit(cube: DataFrame, declared: list[str]) -> DataFrame:
    """Only what the document declares."""
    return cube.select(*[c for c in declared if c in cube.columns])


def unpack(packed: Column, scale: Column, offset: Column, missing: Column) -> Column:
    return F.when(packed != missing, packed * scale + offset)


# fixed values: number of values of the signed integer types
SPANS = {"tinyint": 256, "smallint": 65536, "int": 4294967296}


def as_unsigned(value: Column, dtype: str) -> Column:
    """A signed value that stands for an unsigned one, in the next wider type."""
    wider = {"tinyint": "smallint", "smallint": "int", "int": "bigint"}[dtype]
    v = value.cast("bigint")
    return F.when(v < 0, v + SPANS[dtype]).otherwise(v).cast(wider)


def flatten_groups(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested groups (structs, at any depth) as prefixed columns."""

    def leaves(schema, path: list[str]):
        for field in schema.fields:
            here = [*path, field.name]
            if field.dataType.typeName() == "struct":
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path)) for path in leaves(df.schema, [])])


def unnest(df: DataFrame, sequence: str) -> DataFrame:
    """A sequence (array of structs) as rows; rows with an empty one stay, with nulls."""
    rest = [c for c in df.columns if c != sequence]
    return df.select(*rest, F.inline_outer(sequence))


def canonical(cube: DataFrame, dims: list[str]) -> DataFrame:
    """Dimensions first, in the order given, then the variables; rows sorted inside partitions."""
    order = [d for d in dims if d in cube.columns]
    return cube.select(*order, *[c for c in cube.columns if c not in order]).sortWithinPartitions(*order)


def drop_single(cube: DataFrame, dims: list[str]) -> DataFrame:
    """Drop dimensions of length one. Reading fails if one of them is longer; no job runs before that."""
    ends = cube.agg(*[F.struct(F.min(d).alias("low"), F.max(d).alias("high")).alias(d) for d in dims])
    single = ends.select(F.array_compact(F.array(*[F.when(~F.col(f"{d}.low").eqNullSafe(F.col(f"{d}.high")), F.lit(d)) for d in dims])).alias("long")).scalar()
    error = F.raise_error(F.concat(F.lit("more than one value along "), F.array_join(single, ", "))).cast("boolean")
    return cube.where(F.when(F.size(single) > 0, error).otherwise(True)).drop(*dims)


def along(cube: DataFrame, dim: str, name: str, value: Column) -> DataFrame:
    """A variable along one dimension, made from the ``index`` of its values; under the dimension's name it takes its place."""
    made = axis(cube, dim).select(F.col(dim).alias("_at"), value.alias("_value"))
    rest = [c for c in cube.columns if c != name]
    return cube.join(made, F.col(dim) == F.col("_at"), "left").select(*rest, F.col("_value").alias(name))
