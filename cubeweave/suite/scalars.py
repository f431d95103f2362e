"""Scalar functions that have a query of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeweave.functions import calendars, names, numeric, ordering, times
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views

_GLOBS = ["*/tas_*.nc", "*/pr_day_NAM+QC_*.nc", "*_ssp245_r?_*", "*.ncml", "/data/vdb/C1/*"]


@query(
    "glob_to_regex",
    with_views(
        "members",
        """SELECT g AS glob, count(path) AS n FROM (VALUES ('*/tas_*.nc'), ('*/pr_day_NAM+QC_*.nc'), ('*_ssp245_r?_*'), ('*.ncml'),
          ('/data/vdb/C1/*')) v(g) LEFT JOIN members ON path GLOB g GROUP BY 1""",
    ),
)
def glob_to_regex(spark, sf):
    """All patterns in one pass over the inventory."""
    counts = substrate.members(spark, sf).agg(
        *[F.count_if(F.col("path").rlike(names.glob_to_regex(g))).alias(f"g{i}") for i, g in enumerate(_GLOBS)]
    )
    globs = F.create_map(*[F.lit(x) for i, g in enumerate(_GLOBS) for x in (f"g{i}", g)])
    return counts.unpivot([], [f"g{i}" for i in range(len(_GLOBS))], "key", "n").select(globs[F.col("key")].alias("glob"), "n")


@query(
    "calendar_convert",
    with_views(
        "grid",
        """WITH d AS (SELECT DISTINCT year(time) AS y, month(time) AS m, day(time) AS d FROM grid),
          c AS (SELECT y, m, d FROM d WHERE d <= 30 UNION SELECT DISTINCT y, m, 30 FROM d),
          s AS (SELECT y, m, TRY_CAST(concat(y, '-', lpad(CAST(m AS VARCHAR), 2, '0'), '-', lpad(CAST(d AS VARCHAR), 2, '0')) AS DATE) AS day FROM c)
        SELECT y AS year, count(*) AS n_360, count(day) AS n_valid, count(*) - count(day) AS n_dropped, CAST(max(day) AS VARCHAR) AS last
        FROM s GROUP BY 1""",
    ),
)
def calendar_convert(spark, sf):
    days = substrate.points(spark, sf).select(
        F.year("time").alias("y"), F.month("time").alias("m"), F.dayofmonth("time").alias("d")
    ).distinct()
    # on a 360-day calendar every month has exactly thirty days
    in_360 = days.where(F.col("d") <= 30).unionByName(days.select("y", "m", F.lit(30).alias("d"))).distinct()
    back = in_360.withColumn("day", times.from_calendar(F.col("y"), F.col("m"), F.col("d")))
    return back.groupBy(F.col("y").cast("bigint").alias("year")).agg(
        F.count("*").alias("n_360"),
        F.count("day").alias("n_valid"),
        F.count_if(F.col("day").isNull()).alias("n_dropped"),
        F.max("day").cast("string").alias("last"),
    )


@query(
    "time_rebase",
    with_views(
        "grid",
        """SELECT realization, strftime(time, '%Y-%m-%d') AS day,
          CAST(row_number() OVER (PARTITION BY realization, year(time) ORDER BY time) - 1 AS BIGINT) AS value,
          concat('days since ', year(time), '-01-01 00:00:00') AS units FROM (SELECT DISTINCT realization, time FROM grid)""",
    ),
)
def time_rebase(spark, sf):
    steps = substrate.points(spark, sf).select("realization", F.col("time").cast("date").alias("day")).distinct()
    filed = steps.withColumns({"_year": F.year("day"), "_month": F.month("day")})
    placed = ordering.position(filed, ["realization", "_year"], "_month", ["day"], "value")
    return placed.select(
        "realization", F.col("day").cast("string"), "value", times.units_text(F.trunc("day", "year")).alias("units")
    )


@query(
    "unit_convert",
    with_views(
        "grid",
        """SELECT realization, CAST(sum(tas - 273.15) AS DOUBLE) AS tas_sum, CAST(max(pr * 86400) AS DOUBLE) AS pr_max,
          'degC' AS tas_units, 'mm' AS pr_units FROM grid GROUP BY 1""",
    ),
)
def unit_convert(spark, sf):
    cube = times.to_daily_depth(times.to_celsius(substrate.grid(spark, sf), "tas"), "pr")
    units = {v: cube.schema[v].metadata["units"] for v in ("tas", "pr")}
    return cube.groupBy("realization").agg(
        numeric.total("tas").alias("tas_sum"),
        F.max("pr").cast("double").alias("pr_max"),
        *[F.lit(u).alias(f"{v}_units") for v, u in units.items()],
    )


#: Months of the calendars, as the reference side counts them.
_LENGTHS = """CASE WHEN cal = '360_day' THEN 30 WHEN m IN (4, 6, 9, 11) THEN 30 WHEN m <> 2 THEN 31
  WHEN cal = 'all_leap' OR (cal = 'julian' AND y % 4 = 0) OR (cal = 'proleptic_gregorian' AND y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0)) THEN 29 ELSE 28 END"""


@query(
    "calendar_decode",
    f"""WITH named(k, cal) AS (VALUES (0, 'noleap'), (1, 'all_leap'), (2, '360_day'), (3, 'julian'), (4, 'proleptic_gregorian')),
      days AS (SELECT cal, k, y, m, unnest(range(1, ({_LENGTHS}) + 1)) AS d FROM named, (SELECT unnest(range(1893, 1908)) AS y), (SELECT unnest(range(1, 13)) AS m)),
      numbered AS (SELECT *, row_number() OVER (PARTITION BY cal ORDER BY y, m, d) - 1 AS n FROM days),
      steps AS (SELECT l_orderkey % 5 AS k, date_diff('day', DATE '1995-01-01', l_shipdate::DATE) * 24 + l_linenumber AS hours FROM lineitem),
      dated AS (SELECT cal, y, m, d, s.hours % 24 AS h, TRY_CAST(concat(y, '-', lpad(m::VARCHAR, 2, '0'), '-', lpad(d::VARCHAR, 2, '0')) AS DATE) AS day
        FROM steps s JOIN numbered USING (k) WHERE n = (s.hours // 24))
    SELECT cal AS calendar, y::BIGINT AS year, m::BIGINT AS month, count(*) AS n, count(day) AS n_valid, min(d)::BIGINT AS first_day, max(d)::BIGINT AS last_day,
      strftime(max(day + to_hours(h)), '%Y-%m-%d %H') AS last, count(*) AS n_back FROM dated GROUP BY 1, 2, 3""",
)
def calendar_decode(spark, sf):
    """Hours since a date counted in five calendars, and back. Years around 1900 tell the two kinds of leap years apart."""
    names_ = [calendars.NOLEAP, calendars.ALL_LEAP, calendars.DAYS_360, calendars.JULIAN, calendars.GREGORIAN]
    line = substrate.table(spark, sf, "lineitem")
    which = F.element_at(F.array(*[F.lit(n) for n in names_]), (F.col("l_orderkey") % 5 + 1).cast("int"))
    hours = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")) * 24 + F.col("l_linenumber")
    steps = line.select(which.alias("calendar"), hours.cast("double").alias("hours"), F.lit("hours since 1893-01-01 00:00:00").alias("units"))
    seconds = times.unit_seconds("units")
    dated = steps.withColumn("date", calendars.decode("hours", "units", seconds, F.col("calendar")))
    both = dated.withColumns({
        "time": times.decode("hours", "units", F.col("calendar")), "back": calendars.encode(F.col("date"), "units", seconds, F.col("calendar")),
    })
    return both.groupBy("calendar", F.col("date.year").alias("year"), F.col("date.month").cast("bigint").alias("month")).agg(
        F.count("*").alias("n"),
        F.count("time").alias("n_valid"),
        F.min("date.day").cast("bigint").alias("first_day"),
        F.max("date.day").cast("bigint").alias("last_day"),
        F.date_format(F.max("time"), "yyyy-MM-dd HH").alias("last"),
        F.count_if(F.col("back") == F.col("hours")).alias("n_back"),
    )
