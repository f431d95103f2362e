"""The eighteen dataset families, as configurations of one pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeweave.functions import names
from cubeweave.operators import select
from cubeweave.operators.edit import with_deltas
from cubeweave.plans.families import Family, build, name_of, run_token
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views

CHAINS = ("historical+ssp245", "historical+ssp585")
BOTH = ("tas", "pr")

# Fragments of the names of files that are left out, parts of dataset
# names, and the institution that is set by hand for one model.
LEFT_OUT_INDICATOR = "growing_degree_days_gt_4"
LEFT_OUT_AVERAGE = "spatialAvg"
LEFT_OUT_RUN = "ssp245_r10i"
DETRENDED = "_r1i1p1_na10kgrid_qm-moving-50bins-detrend_1950-2100"
DOWNSCALED = "nex-gddp"
SET_BY_HAND = "Norwegian Climate Center"

_SQL_CHAINS = "chains(chain, part, exp) AS (VALUES ('historical+ssp245', 0, 'historical'), ('historical+ssp245', 1, 'ssp245'), ('historical+ssp585', 0, 'historical'), ('historical+ssp585', 1, 'ssp585'))"


def _fixed(spark, sf):
    """Fixed-field files: one per center that has any."""
    has = substrate.table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    center = F.concat(F.lit("C"), F.col("s_suppkey").cast("string"))
    return has.select(
        center.alias("center"), F.concat(F.lit(f"{substrate.ROOT}/"), center, F.lit("/fx/orog_"), center, F.lit(".nc")).alias("path")
    )


_SQL_FIXED = """fixed AS (SELECT concat('C', s_suppkey) AS center, concat('/data/vdb/C', s_suppkey, '/fx/orog_C', s_suppkey, '.nc') AS path
          FROM supplier WHERE s_acctbal > 0)"""

_bigint = lambda c: F.col(c).cast("bigint").alias(c)


@query(
    "family_cmip5_single",
    with_views(
        "members",
        f"""WITH {_SQL_CHAINS}, d AS (SELECT DISTINCT center, model, run, variable FROM members WHERE exp = 'historical')
        SELECT center, model, chain, run AS realization, variable, CAST(part AS BIGINT) AS part,
          concat('/data/vdb/', center, '/', model, '/', exp, '/', run, '/day/', variable) AS location FROM d, chains""",
    ),
)
def family_cmip5_single(spark, sf):
    family = Family(dataset=("center", "model"), variables=BOTH, chains=CHAINS, realization=("run",))
    rows = build(substrate.members(spark, sf), family)
    return rows.select("center", "model", "chain", "realization", "variable", _bigint("part"), "location")


@query(
    "family_multirun",
    with_views(
        "members",
        """SELECT center, model, run AS realization, variable, count(*) AS n_files, concat('/data/vdb/', center, '/', model) AS location,
          concat('.*', variable, '_.*', run, '.*') AS regexp, 'time_bnds' AS removed FROM members GROUP BY 1, 2, 3, 4""",
    ),
)
def family_multirun(spark, sf):
    # run directories carry their scenario after the label: r1-rcp85 -> r1
    files = substrate.members(spark, sf).withColumn("_dir", F.concat("run", F.lit("-rcp85")))
    files = files.withColumn("run", F.element_at(F.split("_dir", "-rcp"), 1)).drop("_dir")
    family = Family(
        dataset=("center", "model", "run"), variables=BOTH, members="regexp", realization=("run",), removed=("time_bnds",)
    )
    rows = build(files, family)
    return rows.select("center", "model", "realization", "variable", "n_files", "location", "regexp", "removed")


@query(
    "family_casr",
    with_views(
        "members",
        f"""WITH {_SQL_FIXED}, m AS (SELECT *, row_number() OVER (PARTITION BY center, model, exp, run, variable ORDER BY path) - 1 AS ordinal
            FROM members WHERE variable NOT IN ('prsn', 'prra', 'prfr', 'prrp'))
        SELECT center, model, exp, run, 1::BIGINT AS block, variable, CAST(ordinal AS BIGINT) AS ordinal, path AS location, ncoords, 'lon,lat' AS removed FROM m
        UNION ALL SELECT center, model, exp, run, 0, 'fx', NULL, path, NULL, NULL
          FROM (SELECT DISTINCT center, model, exp, run FROM m) JOIN fixed USING (center)""",
    ),
)
def family_casr(spark, sf):
    family = Family(
        dataset=("center", "model", "exp", "run"),
        members="files",
        skip={"variable": ["prsn", "prra", "prfr", "prrp"]},
        removed=("lon", "lat"),
        fixed="first",
    )
    rows = build(substrate.members(spark, sf), family, _fixed(spark, sf))
    return rows.select(
        "center", "model", "exp", "run", _bigint("block"), "variable", "ordinal", "location", "ncoords", "removed"
    )


@query(
    "family_cordex",
    with_views(
        "members",
        f"""WITH {_SQL_FIXED}, m AS (SELECT m.*, concat(variable, exp) AS v FROM members m JOIN fixed f USING (center)),
          g AS (SELECT center, model, domain, run, bool_or(variable = 'pr') AS has FROM m GROUP BY 1, 2, 3, 4),
          n AS (SELECT center, model, domain, run, arg_min(year, path) AS a, arg_max(year, path) AS b, arg_min(exp, path) AS e FROM m JOIN g USING (center, model, domain, run)
            WHERE variable = CASE WHEN has THEN 'pr' ELSE 'tas' END GROUP BY 1, 2, 3, 4)
        SELECT concat('day_', domain, '_', center, '_', model, '_', e, '_', run, '_', a, '0101-', b, '1231') AS dataset, variable,
          CAST(CASE WHEN has AND variable = 'tas' THEN 1 ELSE 0 END AS BIGINT) AS place, count(*) AS n_members, CAST(sum(ncoords) AS BIGINT) AS n_steps
        FROM m JOIN g USING (center, model, domain, run) JOIN n USING (center, model, domain, run) GROUP BY 1, 2, 3""",
    ),
)
def family_cordex(spark, sf):
    """Facets from five directory levels; fixed fields are mandatory; the primary variable leads."""
    family = Family(
        dataset=("center", "model", "domain", "run"), members="files", primary=("pr", "tas"), fixed="first", ordered=False
    )
    fixed = _fixed(spark, sf)
    files = substrate.members(spark, sf).join(fixed.select("center"), "center", "left_semi")
    named = name_of(files, family)
    members = build(files, family).groupBy(*family.dataset, "variable", "place").agg(
        F.count("*").alias("n_members"), F.sum("ncoords").alias("n_steps")
    )
    return members.join(named, list(family.dataset)).select("dataset", "variable", "place", "n_members", "n_steps")


_SQL_RUNS = f"""{_SQL_CHAINS}, ok AS (SELECT center, model, run, chain FROM members JOIN chains USING (exp) WHERE variable IN ('tas', 'pr')
            GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT concat(exp, variable)) = 4),
          rows AS (SELECT center, model, run, chain, v.variable, part, concat('/data/vdb/', center, '/', model, '/', exp, '/', run, '/day/', v.variable) AS location
            FROM ok JOIN chains USING (chain), (VALUES ('tas'), ('pr')) v(variable))"""


@query(
    "family_single_run",
    with_views(
        "members",
        f"WITH {_SQL_RUNS} SELECT center, concat(model, '_', chain, '_', run) AS dataset, variable, CAST(part AS BIGINT) AS part, location FROM rows",
    ),
)
def family_single_run(spark, sf):
    run = ("center", "model", "run")
    rows = build(substrate.members(spark, sf), Family(dataset=run, variables=BOTH, gate=run, chains=CHAINS))
    return rows.select("center", F.concat_ws("_", "model", "chain", "run").alias("dataset"), "variable", _bigint("part"), "location")


@query(
    "family_multi_run",
    with_views(
        "members",
        f"WITH {_SQL_RUNS} SELECT center, concat(model, '_', chain) AS dataset, run AS realization, variable, CAST(part AS BIGINT) AS part, location FROM rows",
    ),
)
def family_multi_run(spark, sf):
    family = Family(
        dataset=("center", "model"), variables=BOTH, gate=("center", "model", "run"), chains=CHAINS, realization=("run",)
    )
    rows = build(substrate.members(spark, sf), family)
    return rows.select(
        "center", F.concat_ws("_", "model", "chain").alias("dataset"), "realization", "variable", _bigint("part"), "location"
    )


@query(
    "family_stations",
    with_views(
        "station",
        """SELECT concat(variable, '_day_NAM_GHCNd') AS dataset, concat('/data/stations/day/', variable) AS location, '.nc' AS suffix,
          count(DISTINCT station) AS n_stations, count(DISTINCT CAST(time AS DATE)) AS n_steps FROM station GROUP BY variable""",
    ),
)
def family_stations(spark, sf):
    """One dataset per variable, over (station, time)."""
    rows = substrate.station(spark, sf)
    # each pair of distinct counts starts from rows already reduced to (variable, key)
    stations = rows.select("variable", "station").distinct().groupBy("variable").agg(F.count("*").alias("n_stations"))
    days = rows.select("variable", F.col("time").cast("date").alias("d")).distinct().groupBy("variable").agg(F.count("*").alias("n_steps"))
    return stations.join(days, "variable").select(
        F.concat("variable", F.lit("_day_NAM_GHCNd")).alias("dataset"),
        F.concat(F.lit("/data/stations/day/"), "variable").alias("location"),
        F.lit(".nc").alias("suffix"),
        "n_stations",
        "n_steps",
    )


@query(
    "family_lookup",
    with_views(
        "members",
        """WITH ok AS (SELECT center, exp FROM members WHERE exp <> 'historical' GROUP BY 1, 2 HAVING count(DISTINCT variable) = 2)
        SELECT concat('day_', m.center, '_historical+', m.exp, '_r1i1p1_na10kgrid_qm-moving-50bins-detrend_1950-2100') AS dataset, variable, count(*) AS n_files,
          n.n_name AS driving_institution, m.center AS driving_model_id, 'ts,time_vectors' AS removed
        FROM members m JOIN ok USING (center, exp) JOIN supplier s ON concat('C', s_suppkey) = m.center JOIN nation n ON n_nationkey = s_nationkey
        GROUP BY ALL""",
    ),
)
def family_lookup(spark, sf):
    level = ("center", "exp")
    files = substrate.members(spark, sf).where(F.col("exp") != "historical")
    rows = build(files, Family(dataset=level, variables=BOTH, gate=level, members="pattern", removed=("ts", "time_vectors")))
    suppliers = substrate.table(spark, sf, "supplier").join(
        substrate.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    known = suppliers.select(F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("center"), F.col("n_name").alias("driving_institution"))
    name = F.concat(
        F.lit("day_"), "center", F.lit("_historical+"), "exp", F.lit(DETRENDED)
    )
    return rows.join(known, "center").select(
        name.alias("dataset"), "variable", "n_files", "driving_institution", F.col("center").alias("driving_model_id"), "removed"
    )


@query(
    "family_espo_r",
    with_views(
        "members",
        """WITH f AS (SELECT * FROM members WHERE exp <> 'historical'),
          ok AS (SELECT center, model FROM f GROUP BY 1, 2 HAVING count(DISTINCT variable) = 2),
          n AS (SELECT center, model, run, exp, min(year) AS a, max(year) AS b, any_value(domain) AS domain FROM f WHERE variable = 'tas' GROUP BY 1, 2, 3, 4)
        SELECT concat('day_', n.domain, '_', f.center, '_', f.model, '_', f.exp, '_', f.run, '_', a, '0101-', b, '1231') AS dataset, f.variable, count(*) AS n_files,
          concat('/data/vdb/', f.center, '/', f.model, '/', f.exp, '/', f.run) AS location, concat(f.variable, '_*.nc') AS suffix, f.center AS source_institution
        FROM f JOIN ok USING (center, model) JOIN n USING (center, model, run, exp) GROUP BY ALL""",
    ),
)
def family_espo_r(spark, sf):
    """Variables are tested for the whole model, scans stay inside a scenario."""
    family = Family(dataset=("center", "model", "run", "exp"), variables=BOTH, gate=("center", "model"), members="pattern")
    files = substrate.members(spark, sf).where(F.col("exp").contains("ssp"))
    rows = build(files, family).withColumn("location", names.parent("location"))
    return rows.join(name_of(files, family), list(family.dataset)).select(
        "dataset", "variable", "n_files",
        F.concat_ws("/", F.lit(substrate.ROOT), "center", "model", "exp", "run").alias("location"),
        "suffix", F.col("center").alias("source_institution"),
    )


@query(
    "family_pins",
    with_views(
        "members",
        """WITH f AS (SELECT * FROM members WHERE exp <> 'historical'),
          ok AS (SELECT center, model, run, exp FROM f GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT variable) = 2),
          n AS (SELECT center, model, run, exp, min(year) AS a, max(year) AS b FROM f WHERE variable = 'tas' GROUP BY 1, 2, 3, 4)
        SELECT concat('day_', domain, '_', center, '_', model, '_', exp, '_', run, '_', a, '0101-', b, '1231') AS dataset, 'day' AS frequency, variable,
          CAST(row_number() OVER (PARTITION BY center, model, run, exp, variable ORDER BY path) - 1 AS BIGINT) AS ordinal, path AS location, ncoords
        FROM f JOIN ok USING (center, model, run, exp) JOIN n USING (center, model, run, exp)""",
    ),
)
def family_pins(spark, sf):
    """Listed files per frequency; a frequency without files gives no dataset."""
    level = ("frequency", "center", "model", "run", "exp")
    files = substrate.members(spark, sf).where(F.col("exp").contains("ssp"))
    frequency = F.element_at(names.dirs("path"), -2)
    files = files.withColumn("frequency", frequency).where(F.col("frequency").isin("day", "mon"))
    family = Family(dataset=level, variables=BOTH, gate=level, members="files")
    rows = build(files, family).join(name_of(files, family), list(level))
    return rows.select("dataset", "frequency", "variable", "ordinal", "location", "ncoords")


@query(
    "family_espo_g",
    with_views(
        "members",
        f"""WITH {_SQL_FIXED}, f AS (SELECT * FROM members WHERE exp <> 'historical'),
          ok AS (SELECT center, model FROM f GROUP BY 1, 2 HAVING count(DISTINCT variable) = 2),
          g AS (SELECT center, model, exp, variable, count(*) AS n_files, count(DISTINCT run) AS n_runs, min(run) AS run FROM f JOIN ok USING (center, model) GROUP BY 1, 2, 3, 4)
        SELECT center, model, exp, 1::BIGINT AS block, variable, n_files, concat(variable, '_*.nc') AS suffix,
          concat('/data/vdb/', center, '/', model, '/', exp, CASE WHEN n_runs = 1 THEN concat('/', run, '/day/', variable) ELSE '' END) AS location FROM g
        UNION ALL SELECT center, model, exp, 2, 'fx', NULL, NULL, path FROM (SELECT DISTINCT center, model, exp FROM g) JOIN fixed USING (center)""",
    ),
)
def family_espo_g(spark, sf):
    family = Family(
        dataset=("center", "model", "exp"), variables=BOTH, gate=("center", "model"), members="common", fixed="last"
    )
    files = substrate.members(spark, sf).where(F.col("exp").contains("ssp"))
    rows = build(files, family, _fixed(spark, sf))
    return rows.select("center", "model", "exp", _bigint("block"), "variable", "n_files", "suffix", "location")


@query(
    "family_members",
    with_views(
        "members",
        """WITH f AS (SELECT * FROM members WHERE NOT contains(path, 'growing_degree_days_gt_4')),
          r AS (SELECT exp, center, model, run FROM f WHERE variable = 'pr' GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3),
          one AS (SELECT exp, center, model, min(run) AS run FROM r GROUP BY 1, 2, 3 HAVING count(*) = 1),
          lookup AS (SELECT * FROM (VALUES ('M-A', 0), ('M-N', 1), ('M-R', 2)) v(model, place))
        SELECT concat('day_', f.exp, '_', f.center) AS dataset, concat(f.model, ':', f.run) AS realization, CAST(place AS BIGINT) AS place,
          path AS location, NULL AS problem FROM f JOIN one USING (exp, center, model, run) JOIN lookup USING (model)
        UNION ALL SELECT DISTINCT concat('day_', exp, '_', center), NULL, 99, concat('/data/vdb/lookup/', exp, '_tcr.nc'), NULL
          FROM f JOIN one USING (exp, center, model, run)
        UNION ALL SELECT concat('day_', exp, '_', center), model, place, NULL, 'too many' FROM r JOIN lookup USING (model)
          GROUP BY exp, center, model, place HAVING count(*) > 1""",
    ),
)
def family_members(spark, sf):
    """Stack one run per model, in lookup order, and add the lookup file. A model
    with several complete runs is refused: it gets a row that says so."""
    model, run = ["exp", "center", "model"], ["exp", "center", "model", "run"]
    files = select.exclude(substrate.members(spark, sf), {}, [LEFT_OUT_INDICATOR])
    complete = files.where(F.col("variable") == "pr").groupBy(*run).agg(F.count("*").alias("n")).where("n >= 3")
    refused = select.outside_bounds(complete, model, minimum=1, maximum=1)
    runs = complete.join(refused, model, "left_anti").select(*run)
    family = Family(dataset=tuple(run), members="files", realization=("model", "run"), ordered=False)
    rows = build(files.join(runs, run, "left_semi"), family)
    order = F.create_map(*[F.lit(x) for i, m in enumerate(("M-A", "M-N", "M-R")) for x in (m, i)])
    name, place = F.concat_ws("_", F.lit("day"), "exp", "center").alias("dataset"), order[F.col("model")].cast("bigint").alias("place")
    none = F.lit(None).cast("string")
    stacked = rows.select(name, "realization", place, "location", none.alias("problem"))
    lookup = runs.select("exp", "center").distinct().select(
        name, none.alias("realization"), F.lit(99).cast("bigint").alias("place"),
        F.concat(F.lit("/data/vdb/lookup/"), "exp", F.lit("_tcr.nc")).alias("location"), none.alias("problem"),
    )
    told = refused.select(name, F.col("model").alias("realization"), place, none.alias("location"), "problem")
    return stacked.unionByName(lookup).unionByName(told)


_TOKEN_SQL = """CASE month(mtime) % 12 // 3 WHEN 0 THEN 'winterDJF' WHEN 1 THEN 'springMAM' WHEN 2 THEN 'summerJJA' ELSE 'fallSON' END"""


@query(
    "family_indicators",
    with_views(
        "members",
        f"""WITH t AS (SELECT *, 'annual' AS token FROM members UNION ALL SELECT *, {_TOKEN_SQL} FROM members)
        SELECT concat('30ymean_', token) AS dataset, center, exp, concat(exp, '_', variable) AS variable, variable AS org_name, true AS time_units_change,
          count(*) AS n_files, min(path) AS first_file FROM t WHERE NOT contains(path, 'spatialAvg') GROUP BY ALL""",
    ),
)
def family_indicators(spark, sf):
    """Frequency codes expand to tokens; variables get their scenario as a prefix; time units change by file."""
    files = substrate.members(spark, sf)
    coded = files.withColumn("_code", F.explode(F.array(F.lit("YS"), F.lit("QS-DEC"))))
    token = F.replace(select.token_of(F.col("_code"), F.col("mtime").cast("date")), F.lit("YS"), F.lit("annual"))
    family = Family(dataset=("token", "center", "exp"), members="files", prefix=True, fragments=(LEFT_OUT_AVERAGE,), ordered=False)
    rows = build(coded.withColumn("token", token), family)
    return rows.groupBy(
        F.concat(F.lit("30ymean_"), "token").alias("dataset"), "center", "exp", "variable", "org_name", F.lit(True).alias("time_units_change")
    ).agg(F.count("*").alias("n_files"), F.min("location").alias("first_file"))


@query(
    "family_indicators_30y",
    with_views(
        "members",
        """SELECT CASE WHEN contains(path, 'QC') THEN 'annual_30ymean' ELSE 'annual_' END AS dataset, center, exp, concat(exp, '_', variable) AS variable,
          variable AS org_name, count(*) AS n_files FROM members WHERE run <> 'r3' GROUP BY ALL""",
    ),
)
def family_indicators_30y(spark, sf):
    """The same with a skip list, split by a token of the file name."""
    files = substrate.members(spark, sf)

    def part(dataset: str, include: bool):
        family = Family(
            dataset=("center", "exp"), members="files", prefix=True, skip={"run": ["r3"]}, token=("QC", include), fragments=(LEFT_OUT_AVERAGE,),
            ordered=False,
        )
        return build(files, family).groupBy(F.lit(dataset).alias("dataset"), "center", "exp", "variable", "org_name").agg(
            F.count("*").alias("n_files")
        )

    return part("annual_", False).unionByName(part("annual_30ymean", True))


@query(
    "family_indicator_members",
    with_views(
        "members",
        """SELECT center, concat(model, ':', run) AS realization, exp, concat(exp, '_', variable, s.suffix) AS variable, min(path) AS location
        FROM members JOIN (VALUES ('M-A', 'r1'), ('M-N', 'r2'), ('M-R', 'r3')) l(model, run) USING (model, run),
          (VALUES (''), ('_delta_1971_2000'), ('_delta_1991_2020'), ('_delta_1971_2000_delta_1991_2020')) s(suffix)
        WHERE NOT contains(path, 'ssp245_r10i') GROUP BY ALL""",
    ),
)
def family_indicator_members(spark, sf):
    """One run per model from a lookup, some models skipped; the first file of every
    variable; change variables next to the originals."""
    pairs = {"M-A": "r1", "M-N": "r2", "M-R": "r3", "M-X": "r1"}
    skipped = ["M-X"]
    wanted = [f"{m}:{r}" for m, r in pairs.items() if m not in skipped]
    files = substrate.members(spark, sf).where(F.concat_ws(":", "model", "run").isin(*wanted))
    family = Family(
        dataset=("center",), members="first", realization=("model", "run"), prefix=True, skip={"model": skipped}, fragments=(LEFT_OUT_RUN,)
    )
    rows = build(files, family)
    return rows.select("center", "realization", "exp", F.explode(with_deltas("variable")).alias("variable"), "location")


@query(
    "family_regex",
    with_views(
        "members",
        """WITH ok AS (SELECT center, model, exp, run FROM members GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT variable) = 2),
          n AS (SELECT center, model, exp, run, min(year) AS a, max(year) AS b FROM members WHERE variable = 'tas' GROUP BY 1, 2, 3, 4)
        SELECT concat('day_', domain, '_', center, '_', model, '_', exp, '_', run, '_', a, '-', b) AS dataset, variable, count(*) AS n_files,
          concat('/data/vdb/', center, '/', model) AS location, concat('.*', variable, '_.*', exp, '.*', run, '.*') AS regexp,
          CASE WHEN count(*) > 2 THEN 'too many' END AS problem
        FROM members JOIN ok USING (center, model, exp, run) JOIN n USING (center, model, exp, run) GROUP BY ALL""",
    ),
)
def family_regex(spark, sf):
    """The run comes out of the file name. Datasets with too many files of a
    variable say so. The small tables need a smaller bound than the 38 of the real product."""
    most = 2
    files = substrate.members(spark, sf).withColumn("run", run_token("path", "exp"))
    level = ("center", "model", "exp", "run")
    family = Family(dataset=level, variables=BOTH, gate=level, members="regexp", bounds=(1, most))
    rows = build(files, family).join(name_of(files, family, characters=4), list(level))
    return rows.select("dataset", "variable", "n_files", "location", "regexp", "problem")


@query(
    "family_first_match",
    with_views(
        "members",
        """SELECT concat(model, '_', exp) AS dataset, center, variable, min(path) AS location,
          CASE WHEN model = 'M-R' THEN 'Norwegian Climate Center' ELSE 'as configured' END AS driving_institution,
          (SELECT count(DISTINCT model) FROM members) AS n_models FROM members GROUP BY ALL""",
    ),
)
def family_first_match(spark, sf):
    files = substrate.members(spark, sf)
    rows = build(files, Family(dataset=("center", "model", "exp"), members="first"))
    # the number of models is known; another one is an error
    counted = files.agg(F.count_distinct("model").alias("n")).scalar()
    models = F.when(counted == 3, counted).otherwise(F.raise_error(F.concat(F.lit("3 models expected, found "), counted.cast("string"))).cast("bigint"))
    # one model's institution is set by hand
    institution = F.when(F.col("model") == "M-R", SET_BY_HAND).otherwise("as configured")
    return rows.select(
        F.concat_ws("_", "model", "exp").alias("dataset"), "center", "variable", "location",
        institution.alias("driving_institution"), models.alias("n_models"),
    )


@query(
    "family_regex_pairs",
    with_views(
        "members",
        f"""WITH {_SQL_CHAINS}, anchor AS (SELECT center, model, run, min(domain) AS domain FROM members WHERE variable = 'tas' AND exp = 'historical' GROUP BY 1, 2, 3)
        SELECT concat('day_', center, '_', model, '_', run, '_', chain, '_nex-gddp') AS dataset, v.variable, CAST(part AS BIGINT) AS part,
          concat('.*/', v.variable, '_day_', replace(domain, '+', '\\+'), '_', center, '_', model, '_', chains.exp, '_', run, '_.*\\.nc$') AS regexp,
          replace(chain, '+', ',') AS driving_experiment FROM anchor, chains, (VALUES ('tas'), ('pr')) v(variable)""",
    ),
)
def family_regex_pairs(spark, sf):
    """The first file of a run is the anchor; its name, with other variables and
    scenarios put in, gives the patterns of every part."""
    files = substrate.members(spark, sf)
    first = files.where((F.col("variable") == "tas") & (F.col("exp") == "historical"))
    anchor = select.first_match(first, ["center", "model", "run"])
    combos = F.array(
        *[
            F.struct(F.lit(c).alias("chain"), F.lit(i).cast("bigint").alias("part"), F.lit(p).alias("scenario"), F.lit(v).alias("v"))
            for c in CHAINS
            for i, p in enumerate(c.split("+"))
            for v in BOTH
        ]
    )
    spread = anchor.select("center", "model", "run", names.file_name("path").alias("_name"), F.inline(combos))
    pattern = F.replace("_name", F.lit("+"), F.lit(r"\+"))
    pattern = F.regexp_replace(pattern, F.lit("^tas_"), F.concat("v", F.lit("_")))
    pattern = F.replace(pattern, F.lit("_historical_"), F.concat(F.lit("_"), "scenario", F.lit("_")))
    pattern = F.concat(F.lit(".*/"), F.regexp_replace(pattern, r"[0-9]{8}-[0-9]{8}\.nc$", r".*\\.nc\$"))
    name = F.concat_ws("_", F.lit("day"), "center", "model", "run", "chain", F.lit(DOWNSCALED))
    return spread.select(
        name.alias("dataset"), F.col("v").alias("variable"), "part", pattern.alias("regexp"),
        F.replace("chain", F.lit("+"), F.lit(",")).alias("driving_experiment"),
    )
