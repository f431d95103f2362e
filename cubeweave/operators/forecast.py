"""Forecast ingest: expected files, gates, retention, combination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.operators import virtual

# Sources with the raw and the published name of their variable, hours
# of the daily cycles, lead times, expected leads, share that may be missing, days kept.
VARIABLES = {"TMP_TGL_2m": {"t2m": "tas"}, "APCP_SFC_0": {"paramId_0": "pr"}}
FALLBACK = ("APCP_SFC_0", "unknown", "pr")
CYCLE_HOURS = [0, 12]
CYCLE_DAYS = 3
LEADS = [*range(0, 192, 3), *range(192, 390, 6)]
EXPECTED_LEADS = 96
TOLERANCE = 0.1
KEEP_DAYS = 21
HELPERS = ("surface", "heightAboveGround", "step")
POINTER = "GEPS_latest.nc"


def past_cycles(as_of: str | Column, days: int = CYCLE_DAYS) -> Column:
    """The cycles of the last days that lie before ``as_of``, as an array of zone-less times."""
    now = F.col(as_of) if isinstance(as_of, str) else as_of
    today = now.cast("date")
    starts = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(days - 1)),
            lambda d: F.array(
                *[F.date_sub(today, d).cast("timestamp_ntz") + F.expr(f"INTERVAL '{h}' HOUR") for h in CYCLE_HOURS]
            ),
        )
    )
    return F.filter(starts, lambda c: c < now)


def lead_array() -> Column:
    return F.array(*[F.lit(h) for h in LEADS])


def lead_label(lead: str | Column) -> Column:
    return F.lpad((F.col(lead) if isinstance(lead, str) else lead).cast("string"), 3, "0")


def expected_files(cycles: DataFrame) -> DataFrame:
    """Every (cycle, source, lead); sources and leads are short constant lists."""
    return cycles.select(
        "cycle", F.explode(F.array(*[F.lit(s) for s in VARIABLES])).alias("source")
    ).select("cycle", "source", F.explode(lead_array()).alias("lead"))


def missing_files(cycles: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files that have not landed."""
    key = ["cycle", "source", "lead"]
    return expected_files(cycles).join(present.select(*key), key, "left_anti")


def updated_cycles(attempts: list[DataFrame]) -> DataFrame:
    """Cycles that got a file in any attempt."""
    return virtual.join_existing([a.select("cycle") for a in attempts]).distinct()


def young(day: Column, as_of: Column, days: int = KEEP_DAYS) -> Column:
    """Whether something is kept: it is less than ``days`` old."""
    return F.datediff(as_of, day) < days


def required_leads(expected: int = EXPECTED_LEADS) -> int:
    """The number of leads a variable must exceed."""
    return expected - round(TOLERANCE * expected)


def lead_counts(rows: DataFrame) -> DataFrame:
    """Distinct leads per cycle, one column per source, and whether the cycle is complete."""
    held = rows.select("cycle", "source", "lead").distinct()
    counts = held.groupBy("cycle").agg(*[F.count_if(F.col("source") == s).alias(s) for s in VARIABLES])
    complete = F.lit(True)
    for s in VARIABLES:
        complete = complete & (F.col(s) > required_leads())
    return counts.withColumn("complete", complete)


def combine_decision(counts: DataFrame, outputs: DataFrame, updated: DataFrame) -> DataFrame:
    """What to do with every cycle: complete and (no output yet or new files) -> combine."""
    flagged = (
        counts.join(outputs.select("cycle", F.lit(True).alias("has_output")), "cycle", "left")
        .join(updated.select("cycle", F.lit(True).alias("updated")), "cycle", "left")
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_output", "updated")})
    )
    action = (
        F.when(~F.col("complete"), "wait").when(~F.col("has_output") | F.col("updated"), "combine").otherwise("nothing to do")
    )
    return flagged.withColumn("action", action)


def published_name(source: str | Column, raw: str | Column) -> Column:
    """Name of a raw variable; ``unknown`` stands for precipitation in its own files only; null is an error."""
    s = F.col(source) if isinstance(source, str) else source
    r = F.col(raw) if isinstance(raw, str) else raw
    name = F.when((s == FALLBACK[0]) & (r == FALLBACK[1]), F.lit(FALLBACK[2]))
    for src, renames in VARIABLES.items():
        for old, new in renames.items():
            name = name.when((s == src) & (r == old), F.lit(new))
    return name


def fill_first_step(
    cube: DataFrame, group: list[str], time: str, variable: str, rows: DataFrame | None = None
) -> DataFrame:
    """Null becomes zero on the first step of every group, and stays null later.

    ``rows``, what the cube was made from, is a cheaper place to look for the
    first step: its minimum is found map-side, before the cube's exchange.
    """
    first = (cube if rows is None else rows).groupBy(*group).agg(F.min(time).alias("_first"))
    at_first = F.col(time) == F.col("_first")
    filled = F.when(at_first, F.coalesce(F.col(variable), F.lit(0))).otherwise(F.col(variable))
    return cube.join(first, group).withColumn(variable, filled.cast(cube.schema[variable].dataType)).drop("_first")


def combine(rows: DataFrame, cycles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The combined forecast of some cycles, and the rows whose variable has no known name.

    Variables are concatenated by lead and merged on (cycle, reftime, member,
    time) in one grouping; the first value wins, differing ones are flagged.
    Cycles are picked after that, from cells: raw rows combine map-side and are
    never moved for the choice of cycles.
    """
    mine = cycles.select("cycle")
    named = rows.withColumn("variable", published_name("source", "raw"))
    errors = named.where(F.col("variable").isNull()).join(mine, "cycle", "left_semi")
    coords = ["cycle", "reftime", "member", "time"]
    order = F.struct(F.col("landed").cast("date"), F.col("value"))
    cells = []
    for v in ("tas", "pr"):
        held = (F.col("variable") == v) & F.col("value").isNotNull()
        value = F.when(held, F.col("value"))
        cells.append(F.min_by(value, F.when(held, order)).alias(v))
        cells.append(F.coalesce(F.min(value) != F.max(value), F.lit(False)).alias(f"{v}_conflict"))
    known = named.where(F.col("variable").isNotNull())
    merged = known.groupBy(*coords).agg(*cells).drop(*HELPERS).join(mine, "cycle", "left_semi")
    filled = fill_first_step(merged, ["cycle"], "time", "pr", rows=known)
    celsius = (F.col("tas") - F.lit("273.15").cast("decimal(5,2)")).alias("tas", metadata={"units": "degC"})
    depth = F.col("pr").alias("pr", metadata={"units": "mm"})
    return filled.select("cycle", "reftime", "member", "time", celsius, depth, "tas_conflict", "pr_conflict"), errors


def combined_name(cycle: str | Column) -> Column:
    c = F.col(cycle) if isinstance(cycle, str) else cycle
    return F.concat(F.lit("CMC_geps-raw_latlon0p5x0p5_"), c, F.lit("_allP_allmbrs.nc"))


def latest(files: DataFrame, name: str = "name") -> DataFrame:
    """The file the pointer names: the greatest by name, the pointer itself left out."""
    return files.where(F.col(name) != POINTER).agg(F.max(name).alias("target")).select(F.lit(POINTER).alias("pointer"), "target")


def publication_check(cube: DataFrame) -> DataFrame:
    """Whether a published cycle starts at its own reference time."""
    start = F.to_timestamp_ntz("cycle", F.lit("yyyyMMddHH"))
    return cube.groupBy("cycle").agg(F.min("time").alias("_t"), F.min("reftime").alias("_r")).select(
        "cycle", (F.col("_r") == start).alias("reftime_ok"), (F.col("_t") == start).alias("time_ok")
    )


def not_converted(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input files without an output of the same stem."""
    done = outputs.select(F.regexp_replace("name", r"\.nc$", ".grib2").alias("name"))
    return inputs.join(done, "name", "left_anti")


def split_errors(df: DataFrame, value: Column, reason: str) -> DataFrame:
    """Convert row by row; a row that fails gets a reason instead of stopping the job."""
    return df.withColumn("value", value).withColumn("error", F.when(F.col("value").isNull(), F.lit(reason)))

