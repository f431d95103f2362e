"""Forecast ingest as batch jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeweave.functions import literals, numeric
from cubeweave.operators import forecast
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views

_LEADS = "leads AS (SELECT unnest(range(0, 192, 3)) AS lead UNION ALL SELECT unnest(range(192, 390, 6)))"
_COUNTS = """counts AS (SELECT cycle, count(DISTINCT lead) FILTER (source = 'TMP_TGL_2m') AS n_tas,
          count(DISTINCT lead) FILTER (source = 'APCP_SFC_0') AS n_pr FROM arrivals GROUP BY 1)"""


@query(
    "cycle_grid",
    """WITH a AS (SELECT DISTINCT last_day(l_shipdate) + INTERVAL 6 HOUR AS as_of FROM lineitem)
    SELECT strftime(as_of, '%Y-%m-%d %H') AS as_of, strftime(c, '%Y%m%d%H') AS cycle FROM (
      SELECT as_of, date_trunc('day', as_of) - to_days(CAST(d AS INTEGER)) + to_hours(h) AS c FROM a, range(0, 3) r(d), (VALUES (0), (12)) v(h))
    WHERE c < as_of""",
)
def cycle_grid(spark, sf):
    ends = F.last_day("l_shipdate").cast("timestamp_ntz") + F.expr("INTERVAL '6' HOUR")
    as_of = substrate.table(spark, sf, "lineitem").select(ends.alias("as_of")).distinct()
    cycles = as_of.select("as_of", F.explode(forecast.past_cycles("as_of")).alias("cycle"))
    return cycles.select(
        F.date_format("as_of", "yyyy-MM-dd HH").alias("as_of"), F.date_format("cycle", "yyyyMMddHH").alias("cycle")
    )


@query(
    "lead_grid",
    with_views(
        "arrivals",
        f"""WITH {_LEADS} SELECT lpad(CAST(l.lead AS VARCHAR), 3, '0') AS label, CAST(l.lead AS BIGINT) AS lead, count(a.cycle) AS n
        FROM leads l LEFT JOIN arrivals a ON a.lead = l.lead GROUP BY 1, 2""",
    ),
)
def lead_grid(spark, sf):
    landed = substrate.arrivals(spark, sf).groupBy("lead").agg(F.count("*").alias("n"))
    leads = spark.range(1).select(F.explode(forecast.lead_array()).alias("lead"))
    return leads.join(landed, "lead", "left").select(
        forecast.lead_label("lead").alias("label"), F.col("lead").cast("bigint").alias("lead"), F.coalesce("n", F.lit(0)).alias("n")
    )


@query(
    "missing_files",
    with_views(
        "arrivals",
        f"""WITH {_LEADS}, e AS (SELECT DISTINCT cycle, s.source, lead FROM (SELECT DISTINCT cycle FROM arrivals),
            (VALUES ('TMP_TGL_2m'), ('APCP_SFC_0')) s(source), leads)
        SELECT cycle, source, count(*) AS n_missing, CAST(min(lead) AS BIGINT) AS first_missing FROM e
        WHERE NOT EXISTS (SELECT 1 FROM arrivals a WHERE a.cycle = e.cycle AND a.source = e.source AND a.lead = e.lead) GROUP BY 1, 2""",
    ),
)
def missing_files(spark, sf):
    landed = substrate.arrivals(spark, sf)
    absent = forecast.missing_files(landed.select("cycle").distinct(), landed.select("cycle", "source", "lead").distinct())
    return absent.groupBy("cycle", "source").agg(
        F.count("*").alias("n_missing"), F.min("lead").cast("bigint").alias("first_missing")
    )


@query("distinct_cycles", with_views("arrivals", "SELECT DISTINCT cycle FROM arrivals"))
def distinct_cycles(spark, sf):
    landed = substrate.arrivals(spark, sf)
    return forecast.updated_cycles([landed.where(F.col("attempt") == i) for i in range(3)])


@query(
    "retention_split",
    with_views(
        "arrivals",
        """WITH f AS (SELECT name, replace(name, '.grib2', '.nc') AS derived, min(reftime) AS reftime FROM arrivals GROUP BY 1, 2)
        SELECT name, derived, date_diff('day', CAST(reftime AS DATE), DATE '2001-11-01') < 21 AS keep,
          date_diff('day', CAST(reftime AS DATE), DATE '2001-11-01') < 21 OR reftime = (SELECT max(reftime) FROM f) AS keep_published
        FROM f""",
    ),
)
def retention_split(spark, sf):
    files = substrate.arrivals(spark, sf).groupBy("name").agg(F.min("reftime").alias("reftime"))
    keep = forecast.young(F.col("reftime").cast("date"), F.lit("2001-11-01").cast("date"))
    newest = files.agg(F.max("reftime").alias("m")).scalar()
    return files.select(
        "name",
        F.replace("name", F.lit(".grib2"), F.lit(".nc")).alias("derived"),
        keep.alias("keep"),
        (keep | (F.col("reftime") == newest)).alias("keep_published"),
    )


@query(
    "latest_pointer",
    with_views(
        "arrivals",
        "SELECT 'GEPS_latest.nc' AS pointer, concat('CMC_geps-raw_latlon0p5x0p5_', max(cycle), '_allP_allmbrs.nc') AS target FROM arrivals",
    ),
)
def latest_pointer(spark, sf):
    combined = substrate.arrivals(spark, sf).select(forecast.combined_name("cycle").alias("name"))
    held = combined.unionByName(literals.table(spark, [(forecast.POINTER,)], "name string"))
    return forecast.latest(held)


@query(
    "lead_gate",
    with_views("arrivals", f"WITH {_COUNTS} SELECT *, n_tas > 86 AND n_pr > 86 AS complete FROM counts"),
)
def lead_gate(spark, sf):
    counts = forecast.lead_counts(substrate.arrivals(spark, sf))
    return counts.withColumnsRenamed({"TMP_TGL_2m": "n_tas", "APCP_SFC_0": "n_pr"})


@query(
    "first_step_fill",
    with_views(
        "arrivals",
        """WITH v AS (SELECT cycle, time, CASE WHEN member % 5 <> 0 THEN value END AS pr, min(time) OVER (PARTITION BY cycle) AS first
            FROM arrivals WHERE source = 'APCP_SFC_0')
        SELECT cycle, count(*) AS n, count(*) FILTER (pr IS NULL AND time <> first) AS n_null,
          CAST(sum(CASE WHEN time = first THEN coalesce(pr, 0) ELSE pr END) AS DOUBLE) AS pr FROM v GROUP BY 1""",
    ),
)
def first_step_fill(spark, sf):
    rain = substrate.arrivals(spark, sf).where(F.col("source") == "APCP_SFC_0")
    cube = rain.select("cycle", "time", F.when(F.col("member") % 5 != 0, F.col("value")).alias("pr"))
    filled = forecast.fill_first_step(cube, ["cycle"], "time", "pr")
    return filled.groupBy("cycle").agg(
        F.count("*").alias("n"), F.count_if(F.col("pr").isNull()).alias("n_null"), numeric.total("pr").alias("pr")
    )


@query(
    "incremental_convert",
    with_views(
        "arrivals",
        """SELECT DISTINCT name FROM arrivals WHERE name NOT IN (SELECT name FROM arrivals WHERE attempt < 2)""",
    ),
)
def incremental_convert(spark, sf):
    landed = substrate.arrivals(spark, sf)
    outputs = landed.where(F.col("attempt") < 2).select(F.replace("name", F.lit(".grib2"), F.lit(".nc")).alias("name"))
    return forecast.not_converted(landed.select("name").distinct(), outputs.distinct())


_DECISION = """out AS (SELECT DISTINCT cycle FROM arrivals WHERE reftime < TIMESTAMP '2000-01-01'),
          upd AS (SELECT DISTINCT cycle FROM arrivals WHERE attempt = 2 AND member = 19)"""


@query(
    "combine_decision",
    with_views(
        "arrivals",
        f"""WITH {_COUNTS}, {_DECISION}, f AS (SELECT cycle, n_tas > 86 AND n_pr > 86 AS complete, cycle IN (FROM out) AS has_output,
            cycle IN (FROM upd) AS updated FROM counts)
        SELECT *, CASE WHEN NOT complete THEN 'wait' WHEN NOT has_output OR updated THEN 'combine' ELSE 'nothing to do' END AS action FROM f""",
    ),
)
def combine_decision(spark, sf):
    landed = substrate.arrivals(spark, sf)
    outputs = landed.where(F.col("reftime") < F.lit("2000-01-01").cast("timestamp_ntz")).select("cycle").distinct()
    updated = forecast.updated_cycles([landed.where((F.col("attempt") == 2) & (F.col("member") == 19))])
    decided = forecast.combine_decision(forecast.lead_counts(landed), outputs, updated)
    return decided.drop(*forecast.VARIABLES)


def _raw_rows(spark, sf):
    """Arrivals with the variable name found inside each file; some are wrong."""
    raw = (
        F.when((F.col("source") == "TMP_TGL_2m") & (F.col("member") == 19), "u10")
        .when(F.col("source") == "TMP_TGL_2m", "t2m")
        .when(F.col("lead") < 100, "paramId_0")
        .otherwise("unknown")
    )
    return substrate.arrivals(spark, sf).withColumn("raw", raw)


@query(
    "forecast_combine",
    with_views(
        "arrivals",
        f"""WITH {_COUNTS}, mine AS (SELECT a.* FROM arrivals a JOIN counts USING (cycle) WHERE n_tas > 86 AND n_pr > 86
            AND NOT (source = 'TMP_TGL_2m' AND member = 19)),
          cells AS (SELECT cycle, reftime, member, time,
            first(value ORDER BY landed, value) FILTER (source = 'TMP_TGL_2m') AS tas,
            first(value ORDER BY landed, value) FILTER (source = 'APCP_SFC_0') AS pr,
            count(DISTINCT value) FILTER (source = 'TMP_TGL_2m') > 1 AS tas_conflict,
            count(DISTINCT value) FILTER (source = 'APCP_SFC_0') > 1 AS pr_conflict FROM mine GROUP BY 1, 2, 3, 4)
        SELECT cycle, CAST(member AS BIGINT) AS member, strftime(time, '%Y%m%d%H') AS valid, CAST(tas - 273.15 AS DOUBLE) AS tas,
          CAST(CASE WHEN time = min(time) OVER (PARTITION BY cycle) THEN coalesce(pr, 0) ELSE pr END AS DOUBLE) AS pr,
          tas_conflict, pr_conflict FROM cells""",
    ),
)
def forecast_combine(spark, sf):
    rows = _raw_rows(spark, sf)
    ready = forecast.lead_counts(rows).where("complete")
    cube, _ = forecast.combine(rows, ready)
    return cube.select(
        "cycle",
        F.col("member").cast("bigint"),
        F.date_format("time", "yyyyMMddHH").alias("valid"),
        F.col("tas").cast("double"),
        F.col("pr").cast("double"),
        "tas_conflict",
        "pr_conflict",
    )


@query(
    "forecast_refused",
    with_views(
        "arrivals",
        f"""WITH {_COUNTS}, mine AS (SELECT a.* FROM arrivals a JOIN counts USING (cycle) WHERE n_tas > 86 AND n_pr > 86)
        SELECT cycle, source, 'u10' AS raw, count(*) AS n FROM mine WHERE source = 'TMP_TGL_2m' AND member = 19 GROUP BY 1, 2""",
    ),
)
def forecast_refused(spark, sf):
    """Rows of ready cycles that have no known name: what a combination has to refuse."""
    rows = _raw_rows(spark, sf)
    _, errors = forecast.combine(rows, forecast.lead_counts(rows).where("complete"))
    return errors.groupBy("cycle", "source", "raw").agg(F.count("*").alias("n"))


@query(
    "rename_fallback",
    with_views(
        "arrivals",
        """SELECT source, CASE WHEN source = 'TMP_TGL_2m' AND member = 19 THEN 'u10' WHEN source = 'TMP_TGL_2m' THEN 't2m'
            WHEN lead < 100 THEN 'paramId_0' ELSE 'unknown' END AS raw,
          CASE WHEN source = 'TMP_TGL_2m' AND member = 19 THEN NULL WHEN source = 'TMP_TGL_2m' THEN 'tas' ELSE 'pr' END AS variable,
          source = 'TMP_TGL_2m' AND member = 19 AS failed, count(*) AS n FROM arrivals GROUP BY 1, 2, 3, 4""",
    ),
)
def rename_fallback(spark, sf):
    named = _raw_rows(spark, sf).withColumn("variable", forecast.published_name("source", "raw"))
    return named.groupBy("source", "raw", "variable", F.col("variable").isNull().alias("failed")).agg(F.count("*").alias("n"))


@query(
    "publish_check",
    with_views(
        "arrivals",
        """SELECT cycle, NOT (right(cycle, 2) = '12' AND CAST(substr(cycle, 5, 2) AS INT) % 3 = 0) AS reftime_ok, min(lead) = 0 AS time_ok
        FROM arrivals GROUP BY 1""",
    ),
)
def publish_check(spark, sf):
    """Every third month's second cycle carries a reference time that is six hours late."""
    wrong = F.col("cycle").endswith("12") & (F.substring("cycle", 5, 2).cast("int") % 3 == 0)
    late = F.when(wrong, F.col("reftime") + F.make_dt_interval(hours=F.lit(6))).otherwise(F.col("reftime"))
    return forecast.publication_check(substrate.arrivals(spark, sf).withColumn("reftime", late))


@query(
    "bad_file_split",
    """WITH p AS (SELECT page_id, TRY_CAST(regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS INTEGER) AS number FROM pages)
    SELECT page_id, CAST(number AS BIGINT) AS value, CASE WHEN number IS NULL THEN 'no number in the name' END AS error FROM p""",
)
def bad_file_split(spark, sf):
    pages = substrate.table(spark, sf, "pages").select("page_id", "url")
    number = F.regexp_extract("url", r"([^/?#]*)([?#].*)?$", 1).try_cast("int").cast("bigint")
    return forecast.split_errors(pages, number, "no number in the name").drop("url")
