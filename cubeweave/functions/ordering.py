"""Order-dependent results without one task per hot group.

A plain window sends a whole group to one task. Where the order key has a
coarse part (a year, a month, a day) the work is done twice: over the coarse
totals of the group, which are few, and inside each (group, coarse) slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeweave.runtime import new_dir


def running_totals(
    df: DataFrame, group: list[str], coarse: str | None, order: list[str], values: dict[str, Column]
) -> DataFrame:
    """For each named value, add its sum over the rows that come before, per group.

    Without a coarse key one window does it, in one pass: that is for groups
    with a known bound, such as one file per year.
    """
    before = (Window.unboundedPreceding, -1)

    def earlier(value: Column, window) -> Column:
        return F.coalesce(F.sum(value).over(window.rowsBetween(*before)), F.lit(0))

    if coarse is None:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumns({n: earlier(v, window).cast("bigint") for n, v in values.items()})
    over_coarse = Window.partitionBy(*group).orderBy(coarse)
    over_slice = Window.partitionBy(*group, coarse).orderBy(*order)
    totals = df.groupBy(*group, coarse).agg(*[F.sum(v).alias(f"_total_{n}") for n, v in values.items()])
    base = totals.select(*group, coarse, *[earlier(F.col(f"_total_{n}"), over_coarse).alias(f"_base_{n}") for n in values])
    inner = df.withColumns({f"_inner_{n}": earlier(v, over_slice) for n, v in values.items()}).join(base, [*group, coarse])
    return inner.withColumns(
        {n: (F.col(f"_base_{n}") + F.col(f"_inner_{n}")).cast("bigint") for n in values}
    ).drop(*[f"_{k}_{n}" for k in ("base", "inner") for n in values])


def position(df: DataFrame, group: list[str], coarse: str | None, order: list[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in its group."""
    return running_totals(df, group, coarse, order, {name: F.lit(1)})


def place(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in the whole table.

    Rows are dealt by ranges of the order and sorted in them; a range's first
    position is the number of rows in the ranges before it. One row for each range is all that
    is gathered. The dealt table is kept in the shared folder, so both passes see the same ranges.
    """
    path = new_dir(df.sparkSession, "placed")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the number of a row: its range above the lowest 33 bits, its place in it below
    dealt.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    part = F.shiftright("_row", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_first"))
    numbered = kept.withColumn("_part", part).join(F.broadcast(firsts), "_part")
    return numbered.select(*df.columns, (F.col("_first") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def axis_index(df: DataFrame, dim: str, coarse: Column, name: str = "index") -> DataFrame:
    """The distinct values of one dimension with their 0-based index."""
    axis = df.select(F.col(dim), coarse.alias("_coarse")).distinct()
    return position(axis, [], "_coarse", [dim], name).drop("_coarse")


def previous_time(df: DataFrame, group: list[str], coarse: Column, time: str, name: str) -> DataFrame:
    """Add the time before, per group; the first row gets null.

    Inside a slice it is a lag; for the first row of a slice it is the last
    time of the nearest earlier slice.
    """
    sliced = df.withColumn("_coarse", coarse)
    edges = sliced.groupBy(*group, "_coarse").agg(F.max(time).alias("_last"))
    over_edges = Window.partitionBy(*group).orderBy("_coarse")
    edges = edges.select(*group, "_coarse", F.lag("_last").over(over_edges).alias("_edge"))
    over_slice = Window.partitionBy(*group, "_coarse").orderBy(time)
    return (
        sliced.withColumn("_lag", F.lag(time).over(over_slice))
        .join(edges, [*group, "_coarse"])
        .withColumn(name, F.coalesce("_lag", "_edge"))
        .drop("_coarse", "_lag", "_edge")
    )
