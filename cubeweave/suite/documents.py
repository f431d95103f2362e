"""Datasets read from their documents."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.plans.compiler import Compiler, Store, saved
from cubeweave.registry import query
from cubeweave.sources import substrate
from cubeweave.suite.views import with_views

#: The day as of which the age of files is counted.
AS_OF = "2002-06-30"


def compiler(spark, sf) -> Compiler:
    inventory = substrate.with_short_keys(substrate.members(spark, sf)).select("path", "variable", *substrate.SHORT_KEYS, "mtime")
    year = F.col("year").cast("string")
    dated = inventory.withColumns({"first": F.concat(year, F.lit("-01-01")), "last": F.concat(year, F.lit("-12-31"))})
    stores = [
        Store(substrate.ROOT, dated, partial(substrate.read_records, spark, sf), ("time", "lat", "lon", "realization")),
        Store(substrate.FORECASTS, substrate.forecast_files(spark, sf), partial(substrate.read_forecasts, spark, sf), ("time", "member")),
    ]
    return Compiler(substrate.dataset_documents(spark), stores, as_of=F.lit(AS_OF).cast("timestamp_ntz"))


def _totals(name: str, coords: tuple[str, ...], variables: tuple[str, ...], frame: DataFrame) -> DataFrame:
    """One row for each variable: cells, sum, least and greatest coordinates."""
    ends = lambda f: F.concat_ws(",", *[f(c).cast("string") for c in coords])
    number = lambda v: F.sum(v).cast("double") if frame.schema[v].dataType.typeName() != "string" else F.lit(None).cast("double")
    text = lambda v: F.max(v).cast("string") if frame.schema[v].dataType.typeName() == "string" else F.lit(None).cast("string")
    cells = [F.struct(F.lit(v).alias("variable"), F.count(v).alias("n"), number(v).alias("total"), text(v).alias("text")).alias(v) for v in variables]
    whole = frame.agg(F.count("*").alias("n_cells"), ends(F.min).alias("low"), ends(F.max).alias("high"), F.array(*cells).alias("_cells"))
    return whole.select(F.lit(name).alias("document"), F.lit(",".join(coords)).alias("dims"), "n_cells", "low", "high", F.inline("_cells"))


def _sql(name: str, dims: str, rows: str, variables: dict[str, str]) -> str:
    """The same for rows with one column for each dimension and variable."""
    low, high = (" || ',' || ".join(f"{f}({d})::VARCHAR" for d in dims.split(",")) for f in ("min", "max"))
    out = []
    for v, kind in variables.items():
        total, text = ("NULL::DOUBLE", f"max({v})") if kind == "text" else (f"sum({v})::DOUBLE", "NULL::VARCHAR")
        out.append(
            f"SELECT '{name}' AS document, '{dims}' AS dims, count(*) AS n_cells, {low} AS low, {high} AS high, '{v}' AS variable, count({v}) AS n, {total} AS total, {text} AS text FROM {rows}"
        )
    return "\nUNION ALL ".join(out)


_PUBLISHED = "NOT (variable = 'pr' AND run <> 'r1' AND CAST(substr(center, 2) AS BIGINT) % 5 = 0)"


def _wide(by: str, where: str) -> str:
    cells = ", ".join(f"sum(value) FILTER (variable = '{v}') AS {v}" for v in ("tas", "pr"))
    return f"(SELECT {by}, {cells} FROM records WHERE {_PUBLISHED} AND {where} GROUP BY ALL)"


_GRID = "time, lat, lon, realization"
_HIST = _wide(_GRID, "exp = 'historical'")
_FIRST_RUN = _wide(_GRID, "exp = 'historical' AND run = 'r1' AND variable = 'tas'")
_ONE_MODEL = _wide(_GRID, "exp = 'historical' AND run = 'r1' AND model = 'M-A' AND variable = 'tas'")
_WARM = _wide(_GRID, "exp = 'ssp585' AND variable = 'tas'")
_INDEXED = "(SELECT *, dense_rank() OVER (ORDER BY lat) - 1 AS ilat, dense_rank() OVER (ORDER BY lon) - 1 AS ilon FROM %s)"
_DOCS = "/data/docs"


@query(
    "descriptor_compile",
    with_views(
        "members arrivals",
        "\nUNION ALL ".join(
            [
                _sql(f"{_DOCS}/parts/pr.ncml", "time,lat,lon,realization", _wide(_GRID, "exp = 'historical' AND variable = 'pr'"), {"pr": ""}),
                _sql(f"{_DOCS}/parts/tas.ncml", "time,lat,lon,realization", _wide(_GRID, "exp = 'historical' AND variable = 'tas'"), {"tas": ""}),
                _sql(f"{_DOCS}/union.ncml", "time,lat,lon,member", f"(SELECT time, lat, lon, realization AS member, tas AS air_temperature, pr FROM {_HIST})", {"pr": "", "air_temperature": ""}),
                _sql(
                    f"{_DOCS}/scenarios.ncml", "time,lat,lon,realization,scenario",
                    _wide(f"{_GRID}, exp AS scenario", "exp <> 'historical' AND (variable = 'tas' OR exp = 'ssp245')"), {"tas": ""},
                ),
                _sql(
                    f"{_DOCS}/section.ncml", "time,lat,lon,realization",
                    f"(SELECT * FROM {_INDEXED % _FIRST_RUN} WHERE ilat BETWEEN 2 AND 20 AND ilon BETWEEN 5 AND 40)",
                    {"tas": ""},
                ),
                _sql(
                    f"{_DOCS}/slice.ncml", "time,lon",
                    f"(SELECT * FROM {_INDEXED % _ONE_MODEL} WHERE ilat = 3)",
                    {"tas": ""},
                ),
                _sql(
                    f"{_DOCS}/tiles.ncml", "time,lat,lon,realization",
                    """(SELECT time, y AS lat, x AS lon, realization, tas FROM (SELECT *, CAST(substr(center, 2) AS BIGINT) - 1 AS y,
                        dense_rank() OVER (PARTITION BY center ORDER BY lon) - 1 AS x FROM """
                    + _wide(f"center, {_GRID}", "center IN ('C1', 'C2', 'C3') AND variable = 'tas'")
                    + ") WHERE y < 2 OR x <= 50)",
                    {"tas": ""},
                ),
                _sql(
                    f"{_DOCS}/values.ncml", "time,lat,lon,realization",
                    f"""(SELECT *, CASE WHEN ilat < 20 THEN 100 + 0.5::DOUBLE * ilat END AS line, (['polar', 'boreal', 'temperate'])[ilat + 1] AS band
                        FROM {_INDEXED % _WARM})""",
                    {"tas": "", "line": "", "band": "text"},
                ),
                _sql(
                    f"{_DOCS}/geps.ncml", "member,run,time",
                    """(SELECT member, reftime AS run, time, sum(value) FILTER (source = 'APCP_SFC_0') AS "APCP_SFC_0", sum(value) FILTER (source = 'TMP_TGL_2m') AS "TMP_TGL_2m"
                        FROM arrivals GROUP BY 1, 2, 3)""",
                    {"APCP_SFC_0": "", "TMP_TGL_2m": ""},
                ),
                _sql(
                    f"{_DOCS}/starts.ncml", "time,lat,lon,realization,start",
                    f"""(SELECT r.time, lat, lon, realization, make_timestamp(m.year, 1, 1, 0, 0, 0) AS start, sum(value) AS tas FROM records r JOIN members m USING (center, model, exp, run, domain, variable, year)
                        WHERE exp = 'historical' AND run = 'r1' AND variable = 'tas' AND m.mtime <= TIMESTAMP '{AS_OF}' - INTERVAL 1000 DAY GROUP BY ALL)""",
                    {"tas": ""},
                ),
            ]
        ),
    ),
)
def descriptor_compile(spark, sf):
    """Every document to its rows: unions, lists, stacks, tiles, forecasts, logical views, values, renames, and documents of documents."""
    found = compiler(spark, sf)
    datasets = {path: found.dataset(path) for path in sorted(found.documents)}
    found.gather()
    # each is written, so that what one document moves is gone before the next one
    parts = [saved(_totals(path, ds.coords, ds.variables, ds.frame()), "totals") for path, ds in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
