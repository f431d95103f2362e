"""Filters, completeness gates, selection, and the relational operators behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeweave.functions import names, numeric, ordering, times
from cubeweave.operators import select
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views

RUN = ["center", "model", "run"]


@query(
    "all_vars_gate",
    with_views(
        "members",
        """SELECT center, model, run, exp FROM members WHERE variable IN ('tas', 'pr') GROUP BY 1, 2, 3, 4
        HAVING count(DISTINCT variable) = 2""",
    ),
)
def all_vars_gate(spark, sf):
    return select.all_variables(substrate.members(spark, sf), [*RUN, "exp"], ["tas", "pr"])


@query(
    "scenario_gate",
    with_views(
        "members",
        """WITH runs AS (SELECT center, model, run FROM members WHERE exp IN ('historical', 'ssp245') GROUP BY 1, 2, 3
          HAVING count(DISTINCT concat(exp, variable)) = 4)
        SELECT center, model, 'historical+ssp245' AS chain, count(*) AS n_runs, min(run) AS first_run FROM runs GROUP BY 1, 2""",
    ),
)
def scenario_gate(spark, sf):
    runs = select.surviving_runs(substrate.members(spark, sf), RUN, "historical+ssp245", ["tas", "pr"])
    return runs.groupBy("center", "model", "chain").agg(F.count("*").alias("n_runs"), F.min("run").alias("first_run"))


@query(
    "exclude_lists",
    with_views(
        "members",
        """SELECT path FROM members WHERE variable NOT IN ('prsn', 'pr') AND model <> 'M-N'
        AND NOT contains(path, 'NAM+QC') AND NOT contains(path, '_ssp585_')""",
    ),
)
def exclude_lists(spark, sf):
    left = select.exclude(
        substrate.members(spark, sf), {"variable": ["prsn", "pr"], "model": ["M-N"]}, fragments=["NAM+QC", "_ssp585_"]
    )
    return left.select("path")


@query(
    "token_split",
    "SELECT page_id, url, CASE WHEN contains(url, 'utm_source') THEN 'with' ELSE 'without' END AS part FROM pages",
)
def token_split(spark, sf):
    pages = substrate.table(spark, sf, "pages").select("page_id", "url")
    having = select.by_token(pages, "url", "utm_source", include=True).withColumn("part", F.lit("with"))
    lacking = select.by_token(pages, "url", "utm_source", include=False).withColumn("part", F.lit("without"))
    return having.unionByName(lacking)


@query(
    "freq_expand",
    """WITH o AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'YS' WHEN o_orderstatus = 'F' THEN 'MS'
          WHEN o_orderpriority = '5-LOW' THEN 'W' ELSE 'QS-DEC' END AS code, month(o_orderdate) AS m FROM orders),
      codes(code, token, months) AS (
        SELECT 'YS', 'YS', range(1, 13) UNION ALL
        SELECT 'MS', concat(lpad(CAST(i AS VARCHAR), 2, '0'), ['January','February','March','April','May','June','July','August',
          'September','October','November','December'][i]), [i] FROM range(1, 13) r(i) UNION ALL
        SELECT * FROM (VALUES ('QS-DEC', 'winterDJF', [12, 1, 2]), ('QS-DEC', 'springMAM', [3, 4, 5]),
          ('QS-DEC', 'summerJJA', [6, 7, 8]), ('QS-DEC', 'fallSON', [9, 10, 11])))
    SELECT c.code, c.token, count(o.m) AS n, true AS known FROM codes c LEFT JOIN o ON o.code = c.code AND list_contains(c.months, o.m)
    GROUP BY 1, 2 UNION ALL SELECT code, NULL, count(*), false FROM o WHERE code = 'W' GROUP BY 1""",
)
def freq_expand(spark, sf):
    status = F.col("o_orderstatus")
    code = (
        F.when(status == "O", "YS").when(status == "F", "MS").when(F.col("o_orderpriority") == "5-LOW", "W").otherwise("QS-DEC")
    )
    dated = substrate.table(spark, sf, "orders").select(code.alias("code"), F.col("o_orderdate").cast("date").alias("day"))
    seen = dated.groupBy("code", select.token_of(F.col("code"), F.col("day")).alias("token")).agg(F.count("*").alias("n"))
    codes = seen.select("code").distinct()
    tokens = codes.select("code", F.explode_outer(select.frequency_tokens(F.col("code"))).alias("token"))
    both = (F.col("t.code") == F.col("s.code")) & F.col("t.token").eqNullSafe(F.col("s.token"))
    return (
        tokens.alias("t")
        .join(seen.alias("s"), both, "left")
        .select("t.code", "t.token", F.coalesce("s.n", F.lit(0)).alias("n"), F.col("t.token").isNotNull().alias("known"))
    )


@query(
    "config_cross",
    with_views(
        "members",
        """WITH have AS (SELECT DISTINCT center, model, exp, variable FROM members)
        SELECT concat('C', s_suppkey) AS center, m.model, e.exp, v.variable, h.center IS NOT NULL AS found
        FROM supplier CROSS JOIN (VALUES ('M-A'), ('M-N'), ('M-X')) m(model)
        CROSS JOIN (VALUES ('historical'), ('ssp245'), ('ssp585')) e(exp) CROSS JOIN (VALUES ('tas'), ('pr')) v(variable)
        LEFT JOIN have h ON h.center = concat('C', s_suppkey) AND h.model = m.model AND h.exp = e.exp AND h.variable = v.variable""",
    ),
)
def config_cross(spark, sf):
    keys = ["center", "model", "exp", "variable"]
    centers = substrate.table(spark, sf, "supplier").select(F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("center"))
    wanted = select.product(
        centers, {"model": ["M-A", "M-N", "M-X"], "exp": ["historical", "ssp245", "ssp585"], "variable": ["tas", "pr"]}
    )
    return select.align(wanted, substrate.members(spark, sf), keys)


@query("first_match", with_views("members", "SELECT center, model, variable, min(path) AS path FROM members GROUP BY 1, 2, 3"))
def first_match(spark, sf):
    return select.first_match(substrate.members(spark, sf), ["center", "model", "variable"])


@query(
    "cardinality_guard",
    with_views(
        "members",
        """SELECT center, model, run, variable, count(*) AS n_files, CASE WHEN count(*) < 3 THEN 'too few' ELSE 'too many' END AS problem
        FROM members GROUP BY 1, 2, 3, 4 HAVING count(*) < 3 OR count(*) > 10""",
    ),
)
def cardinality_guard(spark, sf):
    return select.outside_bounds(substrate.members(spark, sf), [*RUN, "variable"], minimum=3, maximum=10)


@query(
    "cardinality_strict",
    with_views("members", "SELECT center, model, run, variable, count(*) AS n_files FROM members GROUP BY 1, 2, 3, 4"),
)
def cardinality_strict(spark, sf):
    """The guard that stops: three files of the past, and four years of two scenarios at most."""
    return select.check_bounds(substrate.members(spark, sf), [*RUN, "variable"], minimum=1, maximum=3 + 4 + 4)


@query(
    "primary_first",
    with_views(
        "members",
        """WITH held AS (SELECT DISTINCT center, model, run, concat(variable, '_', exp) AS variable FROM members),
          f AS (SELECT *, max(CASE WHEN variable = 'pr_historical' THEN 1 ELSE 0 END) OVER (PARTITION BY center, model, run) AS has FROM held)
        SELECT center, model, run, variable, row_number() OVER (PARTITION BY center, model, run ORDER BY
          CASE WHEN variable = 'pr_historical' OR (variable = 'tas_ssp245' AND has = 0) THEN 0 ELSE 1 END, variable) - 1 AS place FROM f""",
    ),
)
def primary_first(spark, sf):
    files = substrate.members(spark, sf).withColumn("variable", F.concat_ws("_", "variable", "exp"))
    return select.primary_first(files, RUN, primary="pr_historical", second="tas_ssp245")


@query(
    "group_period",
    with_views(
        "members",
        """SELECT center, model, run, variable, concat(arg_min(year, path), '0101-', arg_max(year, path), '1231') AS period,
          concat(arg_min(year, path), '-', arg_max(year, path)) AS years FROM members GROUP BY 1, 2, 3, 4""",
    ),
)
def group_period(spark, sf):
    dated = substrate.members(spark, sf).select(*RUN, "variable", "path", *names.facets("path", [])[-2:])
    years = select.period(F.left("start", F.lit(4)), F.left("end", F.lit(4)), "path")
    return dated.groupBy(*RUN, "variable").agg(select.period("start", "end", "path").alias("period"), years.alias("years"))


@query(
    "output_name",
    with_views(
        "members",
        """SELECT center, model, run, exp, concat(CASE WHEN exp = 'historical' THEN 'day_' ELSE concat('day_', exp, '_') END, center, '_', model, '_', run,
          '_', min(year), '-', max(year), '.ncml') AS name FROM members GROUP BY 1, 2, 3, 4""",
    ),
)
def output_name(spark, sf):
    files = substrate.members(spark, sf)
    spans = files.groupBy(*RUN, "exp").agg(F.concat_ws("-", F.min("year").cast("string"), F.max("year").cast("string")).alias("_span"))
    # an empty part and an empty ending leave doubled separators, which are tidied
    scenario = F.when(F.col("exp") == "historical", F.lit("")).otherwise(F.col("exp"))
    name = select.output_name(F.lit("day"), scenario, *RUN, "_span", F.lit(""))
    return spans.select(*RUN, "exp", name.alias("name"))


@query(
    "lookup_enrich",
    with_views(
        "members",
        """SELECT m.center, coalesce(n.n_name, 'missing') AS institution, count(*) AS n_files
        FROM members m JOIN supplier s ON concat('C', s.s_suppkey) = m.center
        LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY 1, 2""",
    ),
)
def lookup_enrich(spark, sf):
    files = substrate.members(spark, sf).groupBy("center").agg(F.count("*").alias("n_files"))
    suppliers = substrate.table(spark, sf, "supplier").select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("center"), F.col("s_nationkey").alias("n_nationkey")
    )
    nations = substrate.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        files.join(suppliers, "center")
        .join(nations, "n_nationkey", "left")
        .select("center", F.coalesce("n_name", F.lit("missing")).alias("institution"), "n_files")
    )


@query(
    "bbox_subset",
    with_views(
        "grid",
        """SELECT realization, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas, CAST(sum(pr) AS DOUBLE) AS pr FROM grid
        WHERE lon BETWEEN -80 AND -70 AND lat BETWEEN 45 AND 50 GROUP BY 1""",
    ),
)
def bbox_subset(spark, sf):
    _, lon, lat = select.REGIONS[0]
    box = substrate.grid(spark, sf).where(select.in_box(lon, lat))
    return box.groupBy("realization").agg(
        F.count("*").alias("n"), numeric.total("tas").alias("tas"), numeric.total("pr").alias("pr")
    )


@query(
    "region_fallback",
    with_views(
        "records",
        """WITH c AS (SELECT center, count(*) FILTER (lon BETWEEN -80 AND -70 AND lat BETWEEN 45 AND 50) AS a,
            count(*) FILTER (lon BETWEEN -80 AND -70 AND lat BETWEEN 25 AND 50) AS b,
            count(*) FILTER (lon BETWEEN -150 AND -50 AND lat BETWEEN 20 AND 88) AS c FROM records GROUP BY 1)
        SELECT center, CASE WHEN a > 0 THEN 'main' WHEN b > 0 THEN 'ghcn' WHEN c > 0 THEN 'none' END AS region,
          CASE WHEN a > 0 THEN a WHEN b > 0 THEN b WHEN c > 0 THEN c END AS n FROM c""",
    ),
)
def region_fallback(spark, sf):
    return select.first_region(substrate.records(spark, sf), ["center"])


@query(
    "year_subset",
    with_views(
        "records",
        """SELECT center, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total FROM records WHERE variable = 'tas' AND year BETWEEN
          (SELECT min(year) FROM records WHERE exp = 'ssp245' AND variable = 'pr') AND
          (SELECT max(year) FROM records WHERE exp = 'ssp245' AND variable = 'pr') GROUP BY 1""",
    ),
)
def year_subset(spark, sf):
    other = substrate.records(spark, sf, "pr").where(F.col("exp") == "ssp245")
    cut = select.years_of(substrate.records(spark, sf, "tas"), other)
    return cut.groupBy("center").agg(F.count("*").alias("n"), numeric.total("value").alias("total"))


@query(
    "time_slice",
    with_views(
        "grid",
        """SELECT realization, count(*) AS n, strftime(max(time), '%Y-%m-%d') AS last, CAST(sum(tas) AS DOUBLE) AS tas FROM grid
        WHERE time >= TIMESTAMP '1999-01-01' AND time < TIMESTAMP '1999-12-31' GROUP BY 1""",
    ),
)
def time_slice(spark, sf):
    cut = substrate.grid(spark, sf).where(times.within("time", ("1999-01-01", "1999-12-30")))
    return cut.groupBy("realization").agg(
        F.count("*").alias("n"), times.day_text(F.max("time")).alias("last"), numeric.total("tas").alias("tas")
    )


@query(
    "nearest_point",
    with_views(
        "grid",
        """SELECT realization, lat, lon, count(*) AS n, CAST(sum(tas) AS DOUBLE) AS tas FROM grid
        WHERE lon = (SELECT lon FROM grid ORDER BY abs(lon + 75.1), lon LIMIT 1)
          AND lat = (SELECT lat FROM grid ORDER BY abs(lat - 45.25), lat LIMIT 1) GROUP BY 1, 2, 3""",
    ),
)
def nearest_point(spark, sf):
    near = select.nearest(substrate.grid(spark, sf), {"lon": -75.1, "lat": 45.25}, source=substrate.points(spark, sf))
    return near.groupBy("realization", "lat", "lon").agg(F.count("*").alias("n"), numeric.total("tas").alias("tas"))


@query(
    "realization_match",
    with_views("members", "SELECT path, concat(model, ':', run) AS realization FROM members"),
)
def realization_match(spark, sf):
    labels = substrate.points(spark, sf).select("realization").distinct()
    return select.match_labels(substrate.members(spark, sf).select("path"), labels)


@query(
    "sample_members",
    with_views(
        "members",
        """WITH r AS (SELECT center, variable, path, row_number() OVER (PARTITION BY center, variable ORDER BY md5(concat('7:', path)), path) AS k,
          count(*) OVER (PARTITION BY center, variable) AS n FROM members)
        SELECT center, variable, path FROM r WHERE k <= greatest(1, least(15, round_even(n * CAST(0.1 AS DOUBLE), 0)))""",
    ),
)
def sample_members(spark, sf):
    files = substrate.members(spark, sf).select("center", "variable", "path")
    return select.sample(files, ["center", "variable"], "path", fraction=0.1, seed=7)


@query(
    "sample_first_last",
    with_views(
        "members",
        """WITH r AS (SELECT center, model, variable, path,
            row_number() OVER (PARTITION BY center, model, variable ORDER BY md5(concat('3:', path)), path) AS k,
            count(*) OVER (PARTITION BY center, model, variable) AS n FROM members),
          ends AS (SELECT center, model, variable, min(path) AS a, max(path) AS b FROM members GROUP BY 1, 2, 3 HAVING count(*) > 4)
        SELECT center, model, variable, path, CASE WHEN n <= 4 THEN 'all' ELSE 'drawn' END AS role FROM r WHERE k <= 4
        UNION ALL SELECT center, model, variable, a, 'first' FROM ends UNION ALL SELECT center, model, variable, b, 'last' FROM ends""",
    ),
)
def sample_first_last(spark, sf):
    files = substrate.members(spark, sf).select("center", "model", "variable", "path")
    return select.sample_with_ends(files, ["center", "model", "variable"], "path", k=4, seed=3)


@query(
    "sample_times",
    with_views(
        "grid",
        """WITH t AS (SELECT realization, time, row_number() OVER (PARTITION BY realization ORDER BY time) - 1 AS place,
            count(*) OVER (PARTITION BY realization) AS n FROM (SELECT DISTINCT realization, time FROM grid)),
          d AS (SELECT realization, (i * 7919 + 5) % n AS place, count(*) AS n_drawn
            FROM (SELECT DISTINCT realization, n FROM t WHERE n >= 1500), range(0, 15) r(i) GROUP BY 1, 2)
        SELECT realization, strftime(time, '%Y-%m-%d') AS time, n_drawn FROM t JOIN d USING (realization, place)
        UNION ALL SELECT realization, strftime(time, '%Y-%m-%d'), 1 FROM t WHERE n < 1500""",
    ),
)
def sample_times(spark, sf):
    drawn = select.sample_steps(substrate.points(spark, sf), ["realization"], "time", draws=15, threshold=1500, seed=5)
    return drawn.select("realization", times.day_text("time").alias("time"), "n_drawn")


@query(
    "member_filter",
    with_views(
        "arrivals",
        "SELECT cycle, source, count(*) AS n, min(member) AS first_member FROM arrivals WHERE member <> 0 GROUP BY 1, 2",
    ),
)
def member_filter(spark, sf):
    # files of the control run have no member dimension
    numbered = substrate.arrivals(spark, sf).withColumn("number", F.nullif("member", F.lit(0)))
    kept = numbered.where(F.col("number").isNotNull())
    return kept.groupBy("cycle", "source").agg(F.count("*").alias("n"), F.min("number").cast("bigint").alias("first_member"))


@query(
    "time_align",
    with_views(
        "grid",
        """WITH l AS (SELECT DISTINCT realization, time FROM grid), r AS (SELECT time FROM l WHERE realization = 'M-A:r1')
        SELECT realization, count(*) FILTER (r.time IS NOT NULL) AS n_common, count(*) FILTER (r.time IS NULL) AS n_missing
        FROM l LEFT JOIN r USING (time) GROUP BY 1""",
    ),
)
def time_align(spark, sf):
    labels = substrate.points(spark, sf).select("realization", "time").distinct()
    one = labels.where(F.col("realization") == "M-A:r1")
    return select.align(labels, one, ["time"]).groupBy("realization").agg(
        F.count_if("found").alias("n_common"), F.count_if(~F.col("found")).alias("n_missing")
    )


@query(
    "collection_group",
    with_views(
        "items",
        """SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY doc_id) - 1 AS BIGINT) AS place, dataset_name
        FROM items""",
    ),
)
def collection_group(spark, sf):
    """Sorted items of every collection, as rows: a collection may hold a third of all items."""
    docs = substrate.items(spark, sf).select("collection", "doc_id", "dataset_name", F.expr("doc_id div 1024").alias("_range"))
    return ordering.position(docs, ["collection"], "_range", ["doc_id"], "place").select("collection", "place", "dataset_name")


@query(
    "infer_freq",
    with_views(
        "station",
        """WITH d AS (SELECT DISTINCT station, CAST(time AS DATE) AS day FROM station),
          s AS (SELECT station, date_diff('day', lag(day) OVER (PARTITION BY station ORDER BY day), day) AS step FROM d),
          c AS (SELECT station, step, count(*) AS n FROM s WHERE step IS NOT NULL GROUP BY 1, 2),
          r AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY n DESC, step) AS k, sum(n) OVER (PARTITION BY station) AS n_all FROM c)
        SELECT station, step, CAST(n_all AS BIGINT) AS n_steps FROM r WHERE k = 1""",
    ),
)
def infer_freq(spark, sf):
    days = substrate.station(spark, sf).select("station", F.col("time").cast("date").alias("day"))
    return select.common_step(days, ["station"], "day", F.trunc("day", "month"))


@query(
    "resample_align",
    with_views(
        "station",
        """WITH a AS (SELECT station, variable, CAST(time AS DATE) AS d, sum(value) AS v FROM station GROUP BY 1, 2, 3)
        SELECT a.station, a.variable AS "left", b.variable AS "right", CAST(d AS VARCHAR) AS day, CAST(a.v AS DOUBLE) AS left_value,
          CAST(b.v AS DOUBLE) AS right_value FROM a JOIN a AS b USING (station, d) WHERE a.variable < b.variable""",
    ),
)
def resample_align(spark, sf):
    """Every two variables of a station on the days that both have."""
    rows = substrate.station(spark, sf)
    days = rows.groupBy("station", "variable", F.date_trunc("day", "time").cast("date").alias("day")).agg(F.sum("value").alias("value"))
    other = days.select("station", "day", F.col("variable").alias("right"), F.col("value").alias("right_value"))
    both = days.withColumnsRenamed({"variable": "left", "value": "left_value"}).join(other, ["station", "day"]).where("left < right")
    number = lambda c: F.col(c).cast("double").alias(c)
    return both.select("station", "left", "right", F.col("day").cast("string").alias("day"), number("left_value"), number("right_value"))


#: Series of one realization: all times, and totals of periods. The first one of each kind is stamped later in its period on the right side.
_KINDS = {"time": None, "month": "month", "quarter": "quarter", "year": "year"}


def _series(spark, sf):
    """(realization, kind, time) -> v: the times of the cube, and totals at the beginnings of periods."""
    points = substrate.points(spark, sf).select("realization", "time", "tas")
    stamp = [F.struct(F.lit(k).alias("kind"), (F.col("time") if u is None else F.date_trunc(u, "time").cast("timestamp_ntz")).alias("at")) for k, u in _KINDS.items()]
    rows = points.select("realization", "tas", F.inline(F.array(*stamp)))
    return rows.groupBy("realization", "kind", F.col("at").alias("time")).agg(F.sum("tas").cast("double").alias("v"))


_SERIES = """s AS (SELECT realization, unnest(['time', 'month', 'quarter', 'year']) AS kind,
    unnest([time, date_trunc('month', time)::TIMESTAMP, date_trunc('quarter', time)::TIMESTAMP, date_trunc('year', time)::TIMESTAMP]) AS moment, tas FROM points),
  c AS (SELECT realization, kind, moment AS time, CAST(sum(tas) AS DOUBLE) AS v FROM s GROUP BY 1, 2, 3)"""
_EVEN = """SELECT realization, count(*) >= 3 AND min(gap) = max(gap) AS even, min(gap) AS gap
    FROM (SELECT realization, date_diff('day', lag(time) OVER (PARTITION BY realization ORDER BY time), time) AS gap FROM {table} WHERE kind = 'time') GROUP BY 1"""


@query(
    "calendar_freq",
    with_views(
        "points",
        f"""WITH {_SERIES}, even AS ({_EVEN.format(table="c")})
        SELECT realization, kind, count(*) AS n_times, CASE kind WHEN 'month' THEN 'MS' WHEN 'quarter' THEN 'QS-OCT' WHEN 'year' THEN 'YS-JAN'
          ELSE max(CASE WHEN even THEN concat(CASE WHEN gap > 1 THEN gap::VARCHAR ELSE '' END, 'D') END) END AS freq
        FROM c JOIN even USING (realization) GROUP BY 1, 2""",
    ),
)
def calendar_freq(spark, sf):
    """Frequencies of even, uneven and calendar series."""
    return select.frequency(_series(spark, sf), ["realization", "kind"], "time", F.trunc("time", "month")).select("realization", "kind", "n_times", "freq")


@query(
    "time_align_fallback",
    with_views(
        "points",
        f"""WITH {_SERIES}, l AS (SELECT * FROM c WHERE realization <> 'M-A:r1'),
          f AS (SELECT kind, CASE WHEN kind = 'time' THEN time ELSE time + INTERVAL 12 HOUR END AS time, v FROM c WHERE realization = 'M-A:r1'),
          even AS ({_EVEN.format(table="(SELECT 'x' AS realization, kind, time FROM f)")}),
          ok AS (SELECT realization, l.kind, count(*) FILTER (f.time IS NULL) = 0 AS exact FROM l LEFT JOIN f ON f.kind = l.kind AND f.time = l.time GROUP BY 1, 2),
          step AS (SELECT realization, kind, exact, CASE kind WHEN 'month' THEN 'MS' WHEN 'quarter' THEN 'QS-OCT' WHEN 'year' THEN 'YS-JAN'
            ELSE (SELECT CASE WHEN even THEN concat(CASE WHEN gap > 1 THEN gap::VARCHAR ELSE '' END, 'D') END FROM even) END AS freq FROM ok),
          b AS (SELECT l.realization, l.kind, freq, l.time AS bucket, sum(l.v) AS v FROM l JOIN step USING (realization, kind) WHERE NOT exact AND freq IS NOT NULL GROUP BY ALL),
          d AS (SELECT kind, date_trunc('day', time)::TIMESTAMP AS bucket, sum(v) AS v FROM f GROUP BY ALL)
        SELECT realization, kind, true AS exact, freq, CAST(l.time AS VARCHAR) AS bucket, l.v AS left_value, f.v AS right_value
          FROM l JOIN step USING (realization, kind) JOIN f ON f.kind = l.kind AND f.time = l.time WHERE exact
        UNION ALL SELECT realization, kind, false, freq, CAST(bucket AS VARCHAR), b.v, d.v FROM b JOIN d USING (kind, bucket)
        UNION ALL SELECT realization, kind, false, NULL, NULL, NULL, NULL FROM step WHERE NOT exact AND freq IS NULL""",
    ),
)
def time_align_fallback(spark, sf):
    """Each series beside that of the first realization: on exact times if it has all of them, else on steps of its frequency."""
    series = _series(spark, sf)
    stamped = F.when(F.col("kind") == "time", F.col("time")).otherwise(F.col("time") + F.make_dt_interval(hours=F.lit(12)))
    others = series.where(F.col("realization") != "M-A:r1")
    every = others.select("realization", "kind").distinct()
    first = every.join(series.where(F.col("realization") == "M-A:r1").select("kind", stamped.alias("time"), "v"), "kind")
    met = select.align_inferred(others, first, ["realization", "kind"], "time", "v", F.trunc("time", "month"))
    return met.select("realization", "kind", "exact", "freq", F.col("bucket").cast("string").alias("bucket"), "left_value", "right_value")


@query(
    "shared_vars",
    with_views(
        "members",
        " INTERSECT ".join(f"SELECT center, concat(exp, '_', variable) AS variable FROM members WHERE model = 'M-{m}'" for m in "ANR"),
    ),
)
def shared_vars(spark, sf):
    """Variables that all models of a centre have."""
    held = substrate.members(spark, sf).select("center", "model", F.concat_ws("_", "exp", "variable").alias("variable"))
    of = [held.where(F.col("model") == m).drop("model") for m in ("M-A", "M-N", "M-R")]
    return of[0].intersect(of[1]).intersect(of[2])


@query(
    "pairwise_compare",
    with_views(
        "records",
        """WITH c AS (SELECT variable, run, time, lat, lon, sum(value) FILTER (model = 'M-A') AS a, sum(value) FILTER (model = 'M-N') AS n,
            sum(value) FILTER (model = 'M-R') AS r FROM records GROUP BY 1, 2, 3, 4, 5),
          p AS (SELECT variable, run, 'M-A' AS l, 'M-N' AS r, a AS x, n AS y FROM c UNION ALL SELECT variable, run, 'M-A', 'M-R', a, r FROM c
            UNION ALL SELECT variable, run, 'M-N', 'M-R', n, r FROM c)
        SELECT variable, run, l AS "left", r AS "right", count(*) AS n_cells, count(*) FILTER (x IS DISTINCT FROM y) AS n_different,
          CAST(max(abs(x - y)) AS DOUBLE) AS largest FROM p GROUP BY 1, 2, 3, 4""",
    ),
)
def pairwise_compare(spark, sf):
    cell = ["variable", "run", "time", "lat", "lon"]
    compared = select.pairs(substrate.records(spark, sf), cell, "model", ["M-A", "M-N", "M-R"], F.col("value"))
    return compared.groupBy("variable", "run", "left", "right").agg(
        F.count("*").alias("n_cells"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"),
        F.max(F.abs(F.col("a") - F.col("b"))).cast("double").alias("largest"),
    )
