"""Comparison of a virtual dataset with its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimals that must agree with and without a time axis; decimals and
# factor for precipitation rates; coordinates and variables that are not compared.
DECIMALS = 3
DECIMALS_NO_TIME = 6
RATE_VARIABLES = ("pr", "prsn")
RATE_UNITS = "kg m-2 s-1"
RATE_FACTOR = 86400
RATE_DECIMALS = 2
SKIPPED_COORDS = ("height", "horizon", "time_bnds")
SKIPPED_VARIABLES = ("time_bnds", "time_vectors", "lat", "lon")
SCENARIOS = ["rcp26", "rcp45", "rcp85", "ssp126", "ssp245", "ssp370", "ssp585"]


def label_differences(left: DataFrame, right: DataFrame, dims: list[str], group: list[str] | None = None) -> DataFrame:
    """Labels of every dimension held by both sides or by one, for each group; equal when no side has its own."""
    group = group or []

    def labels(df: DataFrame, side: str) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("label")) for d in dims if d not in SKIPPED_COORDS])
        return df.select(*group, F.inline(rows)).distinct().withColumn("side", F.lit(side))

    both = labels(left, "l").unionByName(labels(right, "r")).groupBy(*group, "dim", "label").agg(
        F.bool_or(F.col("side") == "l").alias("_l"), F.bool_or(F.col("side") == "r").alias("_r")
    )
    return both.groupBy(*group, "dim").agg(
        F.count_if(F.col("_l") & F.col("_r")).alias("n_common"),
        F.count_if(~F.col("_r")).alias("n_left"),
        F.count_if(~F.col("_l")).alias("n_right"),
    ).withColumn("equal", (F.col("n_left") == 0) & (F.col("n_right") == 0))


def _tolerance(decimals: int) -> Column:
    # fixed value: one and a half units of the last decimal
    return F.lit(f"{1.5 * 10 ** -decimals:.{decimals + 1}f}").cast("decimal(12,8)")


def agrees(variable: str, a: Column, b: Column, timed: bool = True, units: str | None = None) -> Column:
    """Whether two values are equal to the precision of their variable; nulls match nulls."""
    if timed and variable in RATE_VARIABLES and units == RATE_UNITS:
        near = F.abs(a - b) * RATE_FACTOR < _tolerance(RATE_DECIMALS)
    else:
        near = F.abs(a - b) < _tolerance(DECIMALS if timed else DECIMALS_NO_TIME)
    return F.coalesce(near, a.isNull() & b.isNull())


def compare_values(
    virtual: DataFrame, raw: DataFrame, coords: list[str], group: list[str], units: dict[str, str] | None = None
) -> DataFrame:
    """Per group and shared variable: cells of the raw side, cells the virtual side
    lacks, and cells that differ.

    Both sides are stacked and grouped by their coordinates: one exchange, and
    no cell meets more than its counterpart.
    """
    names = [c for c in raw.columns if c in virtual.columns and c not in coords and c not in SKIPPED_VARIABLES]
    stacked = (
        virtual.select(*coords, *names).withColumn("_raw", F.lit(False))
        .unionByName(raw.select(*coords, *names).withColumn("_raw", F.lit(True)))
    )
    sides = []
    for n in names:
        sides += [F.max(F.when(~F.col("_raw"), F.col(n))).alias(f"_v_{n}"), F.max(F.when(F.col("_raw"), F.col(n))).alias(f"_r_{n}")]
    cells = stacked.groupBy(*coords).agg(F.bool_or(~F.col("_raw")).alias("_in_virtual"), F.bool_or("_raw").alias("_in_raw"), *sides)
    timed = "time" in coords
    checks = F.array(
        *[
            F.struct(
                F.lit(n).alias("variable"),
                agrees(n, F.col(f"_v_{n}"), F.col(f"_r_{n}"), timed, (units or {}).get(n)).alias("ok"),
            )
            for n in names
        ]
    )
    checked = cells.where("_in_raw").select(*group, "_in_virtual", F.inline(checks))
    return checked.groupBy(*group, "variable").agg(
        F.count("*").alias("n_cells"),
        F.count_if(~F.col("_in_virtual")).alias("n_absent"),
        F.count_if(F.col("_in_virtual") & ~F.col("ok")).alias("n_failed"),
    )


def scenario_in(path: str | Column) -> Column:
    """The scenarios a path names, from a fixed list."""
    p = F.col(path) if isinstance(path, str) else path
    return F.filter(F.array(*[F.lit(s) for s in SCENARIOS]), lambda s: F.contains(p, s))


def differing_keys(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Attributes that two sets do not share: rows (key, name, left, right)."""
    sides = left.withColumn("_side", F.lit("l")).unionByName(right.withColumn("_side", F.lit("r")))
    wide = sides.groupBy(*key, "name").agg(
        F.max(F.when(F.col("_side") == "l", F.col("value"))).alias("left"),
        F.max(F.when(F.col("_side") == "r", F.col("value"))).alias("right"),
    )
    return wide.where(~F.col("left").eqNullSafe(F.col("right")))

