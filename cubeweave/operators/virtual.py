"""Virtual aggregation: concatenate, merge, stack, attach, tile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeweave.functions import names, ordering
from cubeweave.runtime import new_dir


def member_list(members: DataFrame, dataset: list[str], order: list[str], coarse: str | None = None) -> DataFrame:
    """Members with their ordinal in the dataset.

    Give a coarse order key unless a dataset has few members by construction.
    """
    return ordering.position(members, dataset, coarse, order, "ordinal")


def member_offsets(
    members: DataFrame, dataset: list[str], order: list[str], coarse: str | None = None, steps: str = "ncoords"
) -> DataFrame:
    """Ordinal, first and last global index of every member along the concatenated dimension."""
    placed = ordering.running_totals(members, dataset, coarse, order, {"ordinal": F.lit(1), "first_index": F.col(steps)})
    return placed.withColumn("last_index", F.col("first_index") + F.col(steps) - 1)


def member_steps(rows: DataFrame, file: list[Column], dim: str = "time") -> DataFrame:
    """Steps along a dimension per file."""
    return rows.groupBy(*file).agg(F.count_distinct(dim).alias("ncoords"))


def join_existing(members: list[DataFrame], ordinal: str | None = None) -> DataFrame:
    """Concatenate a few members along a dimension they have, in the order given.

    Meant for members that are separate tables. Members that are files of one
    table are read at once and told apart by their path or facet columns.
    """
    tagged = [m if ordinal is None else m.withColumn(ordinal, F.lit(i)) for i, m in enumerate(members)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def join_existing_parts(rows: DataFrame, ordinal: Column, name: str = "ordinal") -> DataFrame:
    """The same for members that are parts of one table: one read, their place as a column."""
    return rows.withColumn(name, ordinal)


def join_new(members: dict[str, DataFrame], dim: str, variables: list[str], coords: list[str]) -> DataFrame:
    """Stack members along a new dimension, labelled by literals, so that a
    filter on the label leaves only the branches it names.

    Variables that are not listed come from the first member alone.
    """
    branches = []
    for i, (label, df) in enumerate(members.items()):
        kept = df if i == 0 else df.select(*coords, *variables)
        branches.append(kept.withColumn(dim, F.lit(label)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def join_new_parts(rows: DataFrame, dim: str, label: Column, first: str, variables: list[str], coords: list[str]) -> DataFrame:
    """The same for members that are parts of one table: one read, the label as a column.

    Variables that are not listed are kept for the member labelled ``first`` alone.
    """
    rest = [c for c in rows.columns if c not in coords and c not in variables]
    labelled = rows.withColumn(dim, label)
    return labelled.withColumns({c: F.when(F.col(dim) == first, F.col(c)) for c in rest})


def union_variables(members: list[DataFrame], coords: list[str]) -> DataFrame:
    """Variables of all members side by side on shared coordinates.

    The first member that has a name gives it. One exchange for any number of
    members: rows are stacked and grouped by their coordinates instead of
    being joined pair by pair.
    """
    taken: set[str] = set()
    parts = []
    for df in members:
        new = [c for c in df.columns if c not in coords and c not in taken]
        taken.update(new)
        parts.append(df.select(*coords, *new))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    variables = [c for c in stacked.columns if c not in coords]
    return stacked.groupBy(*coords).agg(*[F.max(v).alias(v) for v in variables])


def merge_records(rows: DataFrame, coords: list[str], variables: list[str], value: str = "value") -> DataFrame:
    """The same for members read as one long table (coords, variable, value)."""
    return rows.groupBy(*coords).agg(
        *[F.sum(F.when(F.col("variable") == v, F.col(value))).alias(v) for v in variables]
    )


def merge_cells(cells: DataFrame, coords: list[str], variables: list[str], value: str = "value") -> DataFrame:
    """The same for a long table that has one row at most for each place and variable."""
    return cells.groupBy(*coords).agg(*[F.max(F.when(F.col("variable") == v, F.col(value))).alias(v) for v in variables])


def merge_outer(members: list[DataFrame], coords: list[str], helpers: tuple[str, ...] = ()) -> DataFrame:
    """Outer merge: all coordinates, the first non-null value of each variable.

    ``<variable>_conflict`` tells where non-null values disagree. Helper
    variables are dropped where present.
    """
    tagged = [m.drop(*helpers).withColumn("_member", F.lit(i)) for i, m in enumerate(members)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    variables = [c for c in stacked.columns if c not in coords and c != "_member"]
    merged = []
    for v in variables:
        present = F.col(v).isNotNull()
        merged.append(F.min_by(F.when(present, F.col(v)), F.when(present, F.col("_member"))).alias(v))
        merged.append((F.coalesce(F.min(v) != F.max(v), F.lit(False))).alias(f"{v}_conflict"))
    return stacked.groupBy(*coords).agg(*merged)


def conflicts(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys of a concatenation with a flag for keys that hold unequal non-null values."""
    return rows.groupBy(*key).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.min(value) != F.max(value), F.lit(False)).alias("conflict")
    )


def attach_fixed(cube: DataFrame, fixed: DataFrame, on: list[str]) -> DataFrame:
    """Attach time-less variables to every step.

    The fixed side is grouped by its key, so it can not multiply rows and is
    not joined at all when none of its variables is used. Whether it is small
    enough to be broadcast is left to the planner's size check.
    """
    variables = [c for c in fixed.columns if c not in on]
    one = fixed.groupBy(*on).agg(*[F.max(v).alias(v) for v in variables])
    return cube.join(one, on, "left")


def chain(inventory: DataFrame, chains: list[str], exp: str = "exp") -> DataFrame:
    """Files of each scenario chain (``historical+ssp245``), with the position of their part."""
    found = F.array(
        *[
            F.struct(F.lit(c).alias("chain"), F.array_position(names.scenario_parts(F.lit(c)), F.col(exp)).alias("part"))
            for c in chains
        ]
    )
    return inventory.select("*", F.inline(F.filter(found, lambda s: s["part"] > 0)))


def last_but_one(members: DataFrame, dataset: list[str], order: str) -> DataFrame:
    """The member whose attributes the concatenated dataset takes: the last but
    one, or the only one.

    The rank filter keeps at most two rows per dataset in every task before
    anything is moved.
    """
    rank = F.row_number().over(Window.partitionBy(*dataset).orderBy(F.col(order).desc()))
    last = members.withColumn("_rank", rank).where(F.col("_rank") <= 2)
    rest = [c for c in members.columns if c not in dataset]
    return last.groupBy(*dataset).agg(*[F.max_by(c, "_rank").alias(c) for c in rest])


def first_of(attributes: DataFrame, group: list[str], ordinal: str) -> DataFrame:
    """Attributes of the first member of every merged dataset; those of the others are lost."""
    first = attributes.groupBy(*group).agg(F.min(ordinal).alias(ordinal))
    return attributes.join(first, [*group, ordinal], "left_semi")


def override(inner: DataFrame, outer: DataFrame, key: list[str], order: str = "pos") -> DataFrame:
    """Attributes of both levels; the outer one wins, then the last one given."""
    both = inner.withColumn("_level", F.lit(0)).unionByName(outer.withColumn("_level", F.lit(1)))
    return both.groupBy(*key).agg(F.max_by("value", F.struct("_level", order)).alias("value"))


def promote(rows: DataFrame, attributes: DataFrame, file: list[str]) -> DataFrame:
    """A global attribute of each member as a column along the aggregated dimension."""
    return rows.join(attributes, file, "left")


def section_start(section: str | Column, dim: int) -> Column:
    """Start of one range of ``a:b,c:d``."""
    return F.split(F.element_at(F.split(names.col(section), ","), dim), ":")[0].cast("int")


def section_end(section: str | Column, dim: int) -> Column:
    return F.split(F.element_at(F.split(names.col(section), ","), dim), ":")[1].cast("int")


def place_tiles(tiles: DataFrame, section: str, indices: list[str]) -> DataFrame:
    """Local indices of tiled members as global ones, with a flag for those outside their section."""
    placed = tiles
    inside = F.lit(True)
    for d, index in enumerate(indices, start=1):
        placed = placed.withColumn(index, F.col(index) + section_start(section, d))
        inside = inside & F.col(index).between(section_start(section, d), section_end(section, d))
    return placed.withColumn("inside", inside)


def forecast_matrix(rows: DataFrame, run: str = "reftime", valid: str = "time") -> DataFrame:
    """Two-dimensional time: rows per (run, valid), with the lead in hours."""
    # zone-less times are subtracted as they are: no hour is lost or gained in spring and autumn
    lead = F.col(valid) - F.col(run)
    hours = F.extract(F.lit("DAY"), lead) * 24 + F.extract(F.lit("HOUR"), lead)
    return rows.groupBy(run, valid).agg(F.count("*").alias("n_values")).withColumn("lead_hours", hours.cast("bigint"))


def best_series(rows: DataFrame, key: list[str], run: str, value: Column) -> DataFrame:
    """Per valid time the value of the latest run, totals of a run first."""
    per_run = rows.groupBy(*key, run).agg(value.alias("value"))
    return per_run.groupBy(*key).agg(F.max(run).alias(run), F.max_by("value", run).alias("value"))


def cache_variable(cube: DataFrame, coords: list[str], variable: str) -> DataFrame:
    """One variable with its coordinates, kept for several uses.

    It is a table in the shared folder: nothing has to be released, and a lost
    executor does not lose it.
    """
    path = new_dir(cube.sparkSession, "variable")
    cube.select(*coords, variable).write.parquet(path)
    return cube.sparkSession.read.parquet(path)


def by_coords(members: list[DataFrame], coords: list[str]) -> DataFrame:
    """Members in any order, put in the order of their coordinates, with the number of members per cell."""
    stacked = reduce(DataFrame.unionByName, members)
    variables = [c for c in stacked.columns if c not in coords]
    return stacked.groupBy(*coords).agg(*[F.max(v).alias(v) for v in variables], F.count("*").alias("n_members"))


def stack_labels(model: str | Column, run: str | Column) -> Column:
    """Label of a stacked realization."""
    return F.concat_ws(":", names.col(model), names.col(run))


def coordinate_order(rows: DataFrame, dataset: list[str], member: str, dims: list[str]) -> DataFrame:
    """How members given in any order are put together by their coordinates.

    rows: one table with the members of every dataset. Returns one row for each
    dataset, member and dimension along which the members differ: first, last,
    position (members with the same beginning share one) and verdict of the
    dataset and dimension: ``ordered``; ``overlapping`` if a member begins
    before an earlier one ends; ``differing`` if two begin alike but have different coordinates. Dimensions
    that all members share have no row. Times count in microseconds.

    Coordinates are reduced to an axis of each member, and axes to their ends,
    size and a digest; the window is over the members of a dataset, not its rows.
    """

    def number(d: str) -> Column:
        time = rows.schema[d].dataType.typeName().startswith(("timestamp", "date"))
        return F.unix_micros(F.col(d).cast("timestamp")).cast("double") if time else F.col(d).cast("double")

    axes = rows.select(*dataset, member, F.inline(F.array(*[F.struct(F.lit(d).alias("dim"), number(d).alias("value")) for d in dims]))).distinct()
    by = [*dataset, "dim"]
    ends = axes.groupBy(*by, member).agg(
        F.min("value").alias("first"), F.max("value").alias("last"), F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("value")).alias("digest")).alias("axis")
    )
    # members that begin alike are one step; the next one must begin after all of them
    steps = ends.groupBy(*by, "first").agg(F.max("last").alias("_end"), (F.min("axis") != F.max("axis")).alias("_apart"))
    window = Window.partitionBy(*by).orderBy("first")
    placed = steps.withColumns({
        "position": F.row_number().over(window) - 1,
        "_late": F.max("_end").over(window.rowsBetween(Window.unboundedPreceding, -1)) >= F.col("first"),
    })
    verdict = F.when(F.bool_or("_apart"), "differing").when(F.bool_or(F.coalesce("_late", F.lit(False))), "overlapping").otherwise("ordered")
    told = placed.groupBy(*by).agg(verdict.alias("verdict"), F.count("*").alias("_steps"))
    whole = ends.groupBy(*by).agg((F.min("axis") == F.max("axis")).alias("_one"))
    # one step of members with one axis: the dimension is shared
    differs = told.join(whole, by).where(~((F.col("_steps") == 1) & F.col("_one"))).select(*by, "verdict")
    found = ends.join(placed.select(*by, "first", "position"), [*by, "first"]).join(differs, by)
    return found.select(*by, member, "first", "last", F.col("position").cast("bigint").alias("position"), "verdict")


def members_of_range(offsets: DataFrame, first: int, last: int) -> DataFrame:
    """The members that a range of global indices meets, ends included."""
    return offsets.where((F.col("first_index") <= last) & (F.col("last_index") >= first))


def index_range(cube: DataFrame, offsets: DataFrame, member: list[str], dim: str, first: int, last: int, coarse: Column) -> DataFrame:
    """The rows of a published cube whose global index along ``dim`` is in a range, with that index.

    ``offsets`` is the interval table of its members (``member_offsets``, with
    the columns ``member`` by which the cube is laid out in folders). Only folders of members that the range
    meets are read: the join prunes them while it runs. Inside a member an index is the place of a value on its axis.
    """
    hit = members_of_range(offsets, first, last).select(*member, "first_index")
    rows = cube.join(hit, member).withColumn("_coarse", coarse)
    axis = ordering.position(rows.select(*member, "first_index", "_coarse", dim).distinct(), member, "_coarse", [dim], "_local")
    axis = axis.select(*member, dim, (F.col("first_index") + F.col("_local")).alias("index")).where(F.col("index").between(first, last))
    return rows.drop("first_index", "_coarse").join(axis, [*member, dim])


def tile_bounds(tiles: DataFrame, section: str, dims: list[str]) -> DataFrame:
    """Tiles with <dim>_low and <dim>_high, from their sections."""
    ends = {f"{d}_{n}": f(section, i) for i, d in enumerate(dims, start=1) for n, f in (("low", section_start), ("high", section_end))}
    return tiles.withColumns(ends)


def tiles_of_box(tiles: DataFrame, box: dict[str, tuple[int, int]]) -> DataFrame:
    """The tiles (of ``tile_bounds``) that a box of global indices touches."""
    touches = [(F.col(f"{d}_low") <= b) & (F.col(f"{d}_high") >= a) for d, (a, b) in box.items()]
    return tiles.where(reduce(lambda x, y: x & y, touches))


def tile_cover(tiles: DataFrame, dims: list[str], shape: dict[str, int], block: dict[str, int]) -> DataFrame:
    """How often each cell of a grid is covered, by blocks: <dim>_block, n_cells, n_missing, n_overlapping.

    Tiles are dealt to the blocks that they touch and cut there. A block's
    cells are counted in one group of at most a block's size, whatever the size of the grid.
    """
    dealt = tiles
    for d in dims:
        blocks = F.sequence(F.floor(F.col(f"{d}_low") / block[d]), F.floor(F.col(f"{d}_high") / block[d]))
        dealt = dealt.withColumn(f"{d}_block", F.explode(blocks))
    for d in dims:
        low, size = F.col(f"{d}_block") * block[d], F.lit(block[d])
        dealt = dealt.withColumn(d, F.explode(F.sequence(F.greatest(F.col(f"{d}_low"), low), F.least(F.col(f"{d}_high"), low + size - 1, F.lit(shape[d] - 1)))))
    names_ = [f"{d}_block" for d in dims]
    cells = dealt.groupBy(*names_, *dims).agg(F.count("*").alias("_n"))
    every = tiles.sparkSession.range(1).select(*[F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((shape[d] - 1) // block[d]).cast("bigint"))).alias(n) for d, n in list(zip(dims, names_))[:1]])
    for d, n in list(zip(dims, names_))[1:]:
        every = every.withColumn(n, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((shape[d] - 1) // block[d]).cast("bigint"))))
    sizes = reduce(lambda x, y: x * y, [F.least(F.lit(block[d]), F.lit(shape[d]) - F.col(f"{d}_block") * block[d]) for d in dims])
    covered = cells.groupBy(*names_).agg(F.count("*").alias("_covered"), F.count_if(F.col("_n") > 1).alias("n_overlapping"))
    return every.join(covered, names_, "left").select(
        *names_, sizes.cast("bigint").alias("n_cells"), (sizes - F.coalesce("_covered", F.lit(0))).cast("bigint").alias("n_missing"), F.coalesce("n_overlapping", F.lit(0)).alias("n_overlapping")
    )
