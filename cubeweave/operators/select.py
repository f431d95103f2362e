"""Completeness gates, lists, guards, subsets, samples."""

from __future__ import annotations

import calendar
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeweave.functions import names, ordering

# Boxes tried in this order until one holds data, as (name, lon, lat).
REGIONS = [
    ("main", (-80.0, -70.0), (45.0, 50.0)),
    ("ghcn", (-80.0, -70.0), (25.0, 50.0)),
    ("none", (-150.0, -50.0), (20.0, 88.0)),
]

# File-name tokens of each frequency code.
FREQUENCIES = {
    "YS": ["YS"],
    "MS": [f"{m:02d}{calendar.month_name[m]}" for m in range(1, 13)],
    "QS-DEC": ["winterDJF", "springMAM", "summerJJA", "fallSON"],
}


# Fixed value: the largest sample of a group's files.
SAMPLE_CAP = 15


def every(df: DataFrame, group: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One boolean per condition and group: whether any row of the group meets it."""
    return df.groupBy(*group).agg(*[F.bool_or(c).alias(n) for n, c in conditions.items()])


def all_variables(inventory: DataFrame, group: list[str], required: list[str], variable: str = "variable") -> DataFrame:
    """Groups that hold every required variable. Partial flags meet, no lists are gathered."""
    flags = {f"_{v}": F.col(variable) == v for v in required}
    met = reduce(lambda a, b: a & b, [F.col(n) for n in flags])
    return every(inventory, group, flags).where(met).select(*group)


def surviving_runs(
    inventory: DataFrame, run: list[str], chain: str, required: list[str], exp: str = "exp", variable: str = "variable"
) -> DataFrame:
    """Runs that hold every required variable in every part of a scenario chain."""
    flags = {
        f"_{p}_{v}": (F.col(exp) == p) & (F.col(variable) == v) for p in chain.split("+") for v in required
    }
    met = reduce(lambda a, b: a & b, [F.col(n) for n in flags])
    return every(inventory, run, flags).where(met).select(*run, F.lit(chain).alias("chain"))


def exclude(
    inventory: DataFrame, lists: dict[str, list[str]], fragments: list[str] = (), path: str = "path"
) -> DataFrame:
    """Rows left after exclusion lists per column and fragments of the file name."""
    left = inventory
    for column, values in lists.items():
        left = left.where(~F.col(column).isin(*values))
    for f in fragments:
        left = left.where(~names.file_name(path).contains(f))
    return left


def by_token(df: DataFrame, column: str, token: str, include: bool) -> DataFrame:
    """Rows whose text has a token, or those that lack it."""
    has = F.col(column).contains(token)
    return df.where(has if include else ~has)


def frequency_tokens(code: Column) -> Column:
    """Tokens of a frequency code; null for an unknown one."""
    table = F.create_map(
        *[x for k, v in FREQUENCIES.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))]
    )
    return F.try_element_at(table, code)


def token_of(code: Column, day: Column) -> Column:
    """The token of a frequency that a date falls under."""
    months = F.array(*[F.lit(t) for t in FREQUENCIES["MS"]])
    seasons = F.array(*[F.lit(t) for t in FREQUENCIES["QS-DEC"]])
    month = F.month(day)
    return (
        F.when(code == "YS", F.lit("YS"))
        .when(code == "MS", F.element_at(months, month))
        .when(code == "QS-DEC", F.element_at(seasons, (F.floor((month % 12) / 3) + 1).cast("int")))
    )


def product(df: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """Every combination of some short lists, for every row of ``df``.

    The lists are configuration: they are exploded in place, row by row.
    """
    out = df
    for name, values in lists.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def first_match(inventory: DataFrame, group: list[str], path: str = "path") -> DataFrame:
    """The first file by name of every group."""
    return inventory.groupBy(*group).agg(F.min(path).alias(path))


def outside_bounds(inventory: DataFrame, group: list[str], minimum: int = 1, maximum: int | None = None) -> DataFrame:
    """Groups with fewer or more files than allowed."""
    n = inventory.groupBy(*group).agg(F.count("*").alias("n_files"))
    low = F.col("n_files") < minimum
    high = F.lit(False) if maximum is None else F.col("n_files") > maximum
    return n.where(low | high).withColumn("problem", F.when(low, "too few").otherwise("too many"))


def check_bounds(inventory: DataFrame, group: list[str], minimum: int = 1, maximum: int | None = None) -> DataFrame:
    """The strict form: reading the result fails when a group is out of bounds."""
    n = inventory.groupBy(*group).agg(F.count("*").alias("n_files"))
    ok = (F.col("n_files") >= minimum) & (F.lit(True) if maximum is None else F.col("n_files") <= maximum)
    text = F.concat_ws(" ", F.lit("unexpected number of files:"), F.col("n_files").cast("string"))
    return n.withColumn("n_files", F.when(ok, F.col("n_files")).otherwise(F.raise_error(text).cast("bigint")))


def primary_first(inventory: DataFrame, group: list[str], primary: str, second: str, variable: str = "variable") -> DataFrame:
    """Variables of a group in output order: the primary one, or the second choice
    when it is missing, then the others by name.

    The window runs over the distinct variables of a group.
    """
    held = inventory.select(*group, variable).distinct()
    over = Window.partitionBy(*group)
    has = F.max((F.col(variable) == primary).cast("int")).over(over) == 1
    lead = (F.col(variable) == primary) | ((F.col(variable) == second) & ~has)
    ranked = held.withColumn("_lead", F.when(lead, 0).otherwise(1))
    place = F.row_number().over(over.orderBy("_lead", variable)) - 1
    return ranked.select(*group, variable, place.cast("bigint").alias("place"))


def period(start: str | Column, end: str | Column, order: str | Column) -> Column:
    """First file's start to last file's end, as an aggregate."""
    return F.concat_ws("-", F.min_by(start, order), F.max_by(end, order))


def output_name(*parts: str | Column) -> Column:
    """A dataset name from its parts, tidied, with the document extension."""
    return names.tidy(F.concat(F.concat_ws("_", *parts), F.lit(".ncml")))


def in_box(lon: tuple[float, float], lat: tuple[float, float]) -> Column:
    return F.col("lon").between(*lon) & F.col("lat").between(*lat)


def first_region(rows: DataFrame, group: list[str]) -> DataFrame:
    """The first of the fixed boxes that holds data, and how much; one pass for all boxes."""
    counts = rows.groupBy(*group).agg(*[F.count_if(in_box(lon, lat)).alias(n) for n, lon, lat in REGIONS])
    held = [F.when(F.col(n) > 0, F.struct(F.lit(n).alias("region"), F.col(n).alias("n"))) for n, _, _ in REGIONS]
    return counts.select(*group, F.coalesce(*held).alias("_first")).select(*group, "_first.region", "_first.n")


def years_of(rows: DataFrame, other: DataFrame, time: str = "time") -> DataFrame:
    """Rows from the first to the last year of another dataset.

    The bounds are times, not years, so that the comparison with the stored
    column can reach the file reader once they are known.
    """
    first = F.trunc(F.min(time).cast("date"), "year")
    last = F.add_months(F.trunc(F.max(time).cast("date"), "year"), 12)
    ends = other.agg(first.cast("timestamp_ntz").alias("first"), last.cast("timestamp_ntz").alias("last"))
    return rows.where(
        (F.col(time) >= ends.select("first").scalar()) & (F.col(time) < ends.select("last").scalar())
    )


def nearest(rows: DataFrame, targets: dict[str, float], source: DataFrame | None = None) -> DataFrame:
    """Rows of the cell nearest to a point, axis by axis; the smaller coordinate wins a tie."""
    given = rows if source is None else source
    cell = given.agg(
        *[F.min_by(d, F.struct(F.abs(F.col(d) - t), F.col(d))).alias(d) for d, t in targets.items()]
    )
    out = rows
    for d in targets:
        out = out.where(F.col(d) == cell.select(d).scalar())
    return out


def match_labels(paths: DataFrame, labels: DataFrame, path: str = "path", label: str = "realization") -> DataFrame:
    """Files with the label whose model and run are both directories of the path.

    The containment is an equality of the model with an exploded directory, so
    it is a hash join; a path has a handful of directories. Labels are one row
    for each run of a model, so they are the side that is sent to the tasks, and files stay
    where they are, also those of a model that holds most of them. The planner
    must not choose: it takes the compressed size of the paths for that of their exploded rows.
    """
    parts = F.split(label, ":")
    known = labels.select(label, parts[0].alias("_model"), parts[1].alias("_run"))
    exploded = paths.select("*", names.dirs(path).alias("_dirs")).withColumn("_model", F.explode(F.array_distinct("_dirs")))
    return exploded.join(F.broadcast(known), "_model").where(F.array_contains("_dirs", F.col("_run"))).drop("_dirs", "_model", "_run")


def draw_key(key: str | Column, seed: int) -> Column:
    """A sort key that looks random and depends on the row and the seed only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), names.col(key)))


def sample(df: DataFrame, group: list[str], key: str, fraction: float, cap: int = SAMPLE_CAP, seed: int = 0) -> DataFrame:
    """A part of every group, without replacement: a fraction rounded half to
    even, at least one row, at most ``cap``.

    The constant rank bound lets every task drop all but ``cap`` rows of a
    group before the shuffle.
    """
    size = df.groupBy(*group).agg(
        F.greatest(F.lit(1), F.least(F.lit(cap), F.bround(F.count("*") * F.lit(fraction)).cast("int"))).alias("_k")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(draw_key(key, seed), key))
    ranked = df.withColumn("_rank", rank).where(F.col("_rank") <= cap)
    return ranked.join(size, group).where(F.col("_rank") <= F.col("_k")).drop("_rank", "_k")


def sample_with_ends(df: DataFrame, group: list[str], key: str, k: int, seed: int) -> DataFrame:
    """``k`` rows of every group plus its first and last; all rows of a group that has no more than ``k``."""
    ends = df.groupBy(*group).agg(F.count("*").alias("_n"), F.min(key).alias("first"), F.max(key).alias("last"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(draw_key(key, seed), key))
    drawn = (
        df.select(*group, key, rank.alias("_rank"))
        .where(F.col("_rank") <= k)
        .join(ends.select(*group, "_n"), group)
        .select(*group, key, F.when(F.col("_n") <= k, "all").otherwise("drawn").alias("role"))
    )
    edges = ends.where(F.col("_n") > k).unpivot(group, ["first", "last"], "role", key)
    return drawn.unionByName(edges)


def sample_steps(steps: DataFrame, series: list[str], time: str, draws: int, threshold: int, seed: int) -> DataFrame:
    """Steps of every series: ``draws`` of them, with replacement, when it has
    ``threshold`` or more, else all."""
    one = steps.select(*series, time).distinct()
    size = one.groupBy(*series).agg(F.count("*").alias("_n"))
    placed = ordering.position(
        one.withColumn("_year", F.year(time)), series, "_year", [time], "_place"
    ).drop("_year")
    # fixed values: multiplier of the draw sequence
    picks = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), lambda d: (d * 7919 + seed) % F.col("_n"))
    drawn = (
        size.where(F.col("_n") >= threshold)
        .select(*series, F.explode(picks).alias("_place"))
        .groupBy(*series, "_place")
        .agg(F.count("*").alias("n_drawn"))
    )
    known = placed.join(size, series)
    long_series = known.where(F.col("_n") >= threshold).join(drawn, [*series, "_place"])
    short = known.where(F.col("_n") < threshold).withColumn("n_drawn", F.lit(1).cast("bigint"))
    return long_series.unionByName(short, allowMissingColumns=True).select(*series, time, "n_drawn")


def common_step(series: DataFrame, key: list[str], time: str, coarse: Column) -> DataFrame:
    """The most common step of every series in days; the smallest wins a tie."""
    stepped = ordering.previous_time(series.select(*key, time).distinct(), key, coarse, time, "_before")
    steps = stepped.where(F.col("_before").isNotNull()).select(*key, F.datediff(time, "_before").alias("_step"))
    counted = steps.groupBy(*key, "_step").agg(F.count("*").alias("_n"))
    return counted.groupBy(*key).agg(
        F.max_by("_step", F.struct("_n", -F.col("_step"))).cast("bigint").alias("step"), F.sum("_n").alias("n_steps")
    )


# fixed values: names of months and days in names of frequencies
_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def frequency(series: DataFrame, key: list[str], time: str, coarse: Column) -> DataFrame:
    """The calendar frequency of every series: key, freq, n_times, months and seconds (of its step; one of them), origin.

    A series has a frequency only if all of its steps agree: starts or ends of
    months a fixed number of months apart (``MS``, ``2MS``, ``QS-OCT``,
    ``YS-JAN``; ``ME``, ``QE-DEC``, ``YE-DEC``), or a fixed number of weeks (``W-MON``), days, hours,
    minutes or seconds. Others, and series of fewer than three times, have a null one.
    """
    stepped = ordering.previous_time(series.select(*key, time).distinct(), key, coarse, time, "_before")
    t = F.col(time).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("_before").cast("timestamp_ntz"), t)
    months = (F.year(time) * 12 + F.month(time)) - (F.year("_before") * 12 + F.month("_before"))
    of_day = F.timestamp_diff("SECOND", F.date_trunc("day", t).cast("timestamp_ntz"), t)
    found = stepped.groupBy(*key).agg(
        F.count("*").alias("n_times"),
        F.min(seconds).alias("_least"),
        F.max(seconds).alias("_most"),
        F.min(months).alias("_from"),
        F.max(months).alias("_to"),
        (F.bool_and(F.dayofmonth(time) == 1) & (F.min(of_day) == F.max(of_day))).alias("_starts"),
        (F.bool_and(F.dayofmonth(time) == F.dayofmonth(F.last_day(time))) & (F.min(of_day) == F.max(of_day))).alias("_ends"),
        F.min(t).alias("origin"),
    )
    even = (F.col("_from") == F.col("_to")) & (F.col("_from") > 0) & (F.col("_starts") | F.col("_ends"))
    n = F.when(even, F.col("_from"))
    step = F.when(~even & (F.col("_least") == F.col("_most")), F.col("_least"))
    month = F.month("origin")
    names_ = F.array(*[F.lit(m) for m in _MONTHS])
    times_ = lambda count: F.when(count == 1, "").otherwise(count.cast("string"))
    edge = F.when(F.col("_starts"), "S").otherwise("E")
    # quarters are named by the last of the months in which one of them begins, or ends
    quarter = F.element_at(names_, F.lit(10) + F.pmod(month - 1, F.lit(3)))
    by_month = (
        F.when(n % 12 == 0, F.concat(times_(F.expr("_from div 12")), F.lit("Y"), edge, F.lit("-"), F.element_at(names_, month)))
        .when(n % 3 == 0, F.concat(times_(F.expr("_from div 3")), F.lit("Q"), edge, F.lit("-"), quarter))
        .otherwise(F.concat(times_(n), F.lit("M"), edge))
    )
    fixed = F.when((step % (7 * 86400) == 0), F.concat(times_((step / (7 * 86400)).cast("bigint")), F.lit("W-"), F.upper(F.date_format("origin", "EEE"))))
    for size, unit in ((86400, "D"), (3600, "h"), (60, "min"), (1, "s")):
        fixed = fixed.when(step % size == 0, F.concat(times_((step / size).cast("bigint")), F.lit(unit)))
    known = F.col("n_times") >= 3
    return found.select(
        *key,
        F.when(known & n.isNotNull(), by_month).when(known & step.isNotNull(), fixed).alias("freq"),
        "n_times",
        F.when(known, n).cast("bigint").alias("months"),
        F.when(known, step).cast("bigint").alias("seconds"),
        "origin",
    )


def bucket(time: str | Column, months: Column, seconds: Column, origin: Column) -> Column:
    """Beginning of the step of a frequency (of ``frequency``) that a time falls in; null without a frequency."""
    t = names.col(time).cast("timestamp_ntz")
    number = lambda c: F.year(c) * 12 + F.month(c) - 1
    first = number(origin) + F.floor((number(t) - number(origin)) / months) * months
    by_month = F.make_date(F.floor(first / 12).cast("int"), (F.pmod(first, F.lit(12)) + 1).cast("int"), F.lit(1)).cast("timestamp_ntz")
    day = F.date_trunc("day", origin).cast("timestamp_ntz")
    passed = F.floor(F.timestamp_diff("SECOND", day, t) / seconds) * seconds
    return F.when(months.isNotNull(), by_month).when(seconds.isNotNull(), day + F.make_dt_interval(secs=passed.cast("decimal(18,6)")))


def align_inferred(left: DataFrame, right: DataFrame, group: list[str], time: str, value: str, coarse: Column) -> DataFrame:
    """Both sides beside each other on exact times, or on steps of the right side's frequency where it lacks a time of the left side.

    Series are told apart by ``group`` on both sides. Returns the group, exact,
    freq, bucket, left_value and right_value; a series that needs a frequency and
    has none gives one row without a bucket.
    """
    a = left.select(*group, time, F.col(value).alias("left_value"))
    b = right.select(*group, time, F.col(value).alias("right_value"), F.lit(True).alias("_held"))
    met = a.join(b, [*group, time], "left")
    absent = met.groupBy(*group).agg(F.count_if(F.col("_held").isNull()).alias("_absent"))
    known = absent.join(frequency(right, group, time, coarse), group, "left")
    out = [*group, "exact", "freq", "bucket", "left_value", "right_value"]
    same = met.join(known.where("_absent = 0"), group).select(
        *group, F.lit(True).alias("exact"), "freq", F.col(time).cast("timestamp_ntz").alias("bucket"), "left_value", "right_value"
    )
    apart = known.where("_absent > 0 and freq is not null")
    at = bucket(time, F.col("months"), F.col("seconds"), F.col("origin")).alias("bucket")
    total = lambda df, name: df.join(apart, group).groupBy(*group, "freq", at).agg(F.sum(value).alias(name))
    steps = total(left, "left_value").join(total(right, "right_value").drop("freq"), [*group, "bucket"]).withColumn("exact", F.lit(False))
    none = F.lit(None)
    lost = known.where("_absent > 0 and freq is null").select(
        *group, F.lit(False).alias("exact"), "freq", none.cast("timestamp_ntz").alias("bucket"), none.cast("double").alias("left_value"), none.cast("double").alias("right_value")
    )
    return same.select(*out).unionByName(steps.select(*out)).unionByName(lost)


def align(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """All labels of the left side with whether the right side has them."""
    have = right.select(*key).distinct().withColumn("found", F.lit(True))
    return left.join(have, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def bucket_align(left: DataFrame, right: DataFrame, key: list[str], time: str, unit: str, value: str) -> DataFrame:
    """Both sides totalled by time bucket and joined on it."""
    bucket = F.date_trunc(unit, F.col(time)).cast("date").alias("bucket")
    a = left.groupBy(*key, bucket).agg(F.sum(value).alias("left_value"))
    b = right.groupBy(*key, bucket).agg(F.sum(value).alias("right_value"))
    return a.join(b, [*key, "bucket"])


def pairs(rows: DataFrame, key: list[str], label: str, labels: list[str], value: Column) -> DataFrame:
    """Compare every two of a few sources cell by cell.

    Sources become columns in one grouping; pairs are pairs of columns, so no
    row meets another row in a join.
    """
    wide = rows.groupBy(*key).agg(
        *[F.sum(F.when(F.col(label) == s, value)).alias(f"_{i}") for i, s in enumerate(labels)]
    )
    made = F.array(
        *[
            F.struct(F.lit(labels[i]).alias("left"), F.lit(labels[j]).alias("right"), F.col(f"_{i}").alias("a"), F.col(f"_{j}").alias("b"))
            for i, j in combinations(range(len(labels)), 2)
        ]
    )
    return wide.select(*key, F.inline(made))
