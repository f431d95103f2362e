"""The substrate views as SQL, for the reference side of each query."""

from __future__ import annotations

_DEPENDS = {"members": ["records"], "arrivals": ["landed"]}

VIEWS = {
    "grid": """
  SELECT l_shipdate AS time, CAST(40 + 0.5 * (l_suppkey % 31) AS DOUBLE) AS lat,
         CAST(-90 + 0.5 * (l_partkey % 61) AS DOUBLE) AS lon,
         concat('M-', l_returnflag, ':r', l_linenumber % 3 + 1) AS realization,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS tas, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS pr
  FROM lineitem GROUP BY 1, 2, 3, 4""",
    "points": """
  SELECT l_shipdate AS time, CAST(40 + 0.5 * (l_suppkey % 31) AS DOUBLE) AS lat,
         CAST(-90 + 0.5 * (l_partkey % 61) AS DOUBLE) AS lon,
         concat('M-', l_returnflag, ':r', l_linenumber % 3 + 1) AS realization,
         CAST(l_quantity AS DECIMAL(18,2)) AS tas, CAST(l_extendedprice AS DECIMAL(18,2)) AS pr, l_discount AS weight
  FROM lineitem""",
    "records": """
  SELECT concat('C', l_suppkey) AS center, concat('M-', l_returnflag) AS model,
         CASE WHEN year(l_shipdate) < 1998 THEN 'historical' WHEN l_linestatus = 'O' THEN 'ssp245' ELSE 'ssp585' END AS exp,
         concat('r', l_linenumber % 3 + 1) AS run,
         CASE WHEN l_suppkey % 2 = 0 THEN 'NAM' ELSE 'NAM+QC' END AS domain,
         year(l_shipdate) AS year, l_shipdate AS time,
         CAST(40 + 0.5 * (l_suppkey % 31) AS DOUBLE) AS lat, CAST(-90 + 0.5 * (l_partkey % 61) AS DOUBLE) AS lon,
         concat('M-', l_returnflag, ':r', l_linenumber % 3 + 1) AS realization,
         v.variable AS variable,
         CAST(CASE WHEN v.variable = 'tas' THEN l_quantity ELSE l_extendedprice END AS DECIMAL(18,2)) AS value
  FROM lineitem, (VALUES ('tas'), ('pr')) v(variable)""",
    "members": """
  SELECT center, model, exp, run, domain, variable, year, count(DISTINCT time) AS ncoords, max(time) AS mtime,
         concat('/data/vdb/', center, '/', model, '/', exp, '/', run, '/day/', variable, '/', variable, '_day_', domain,
                '_', center, '_', model, '_', exp, '_', run, '_', year, '0101-', year, '1231.nc') AS path
  FROM records WHERE NOT (variable = 'pr' AND run <> 'r1' AND CAST(substr(center, 2) AS BIGINT) % 5 = 0)
  GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "fx": """
  SELECT CAST(40 + 0.5 * (s_suppkey % 31) AS DOUBLE) AS lat, max(CAST(s_acctbal AS DECIMAL(18,2))) AS orog
  FROM supplier GROUP BY 1""",
    "station": """
  SELECT user_id AS station, ts AS time, event_type AS variable, CAST(value AS DECIMAL(18,2)) AS value FROM events""",
    "landed": """
  SELECT CASE WHEN day(l_shipdate) >= 16 THEN date_trunc('month', l_shipdate) + INTERVAL 15 DAY + INTERVAL 12 HOUR
              ELSE CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) END AS reftime,
         CASE WHEN l_suppkey % 2 = 0 THEN 'TMP_TGL_2m' ELSE 'APCP_SFC_0' END AS source,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 < 64 THEN ((l_orderkey * 7 + l_linenumber) % 97) * 3
              ELSE 192 + ((l_orderkey * 7 + l_linenumber) % 97 - 64) * 6 END AS lead,
         l_partkey % 20 AS member, CAST(l_quantity AS DECIMAL(18,2)) AS value, l_shipdate AS landed,
         l_linenumber % 3 AS attempt
  FROM lineitem""",
    "arrivals": """
  SELECT *, strftime(reftime, '%Y%m%d%H') AS cycle, reftime + to_hours(lead) AS time,
         concat('CMC_geps-raw_', source, '_latlon0p5x0p5_', strftime(reftime, '%Y%m%d%H'), '_P',
                lpad(CAST(lead AS VARCHAR), 3, '0'), '_allmbrs.grib2') AS name
  FROM landed""",
    "tree": """
  SELECT concat('R', n_regionkey) AS parent, concat('N', n_nationkey) AS child FROM nation
  UNION ALL SELECT concat('N', c_nationkey), concat('C', c_custkey) FROM customer
  UNION ALL SELECT concat('N', s_nationkey), concat('S', s_suppkey) FROM supplier""",
    "attrs": """
  SELECT p_partkey AS dataset, 'global' AS scope, CAST(NULL AS VARCHAR) AS variable, 1 AS pos, 'title' AS name, p_name AS value FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 2, 'institute', p_brand FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 3, 'frequency', CASE WHEN p_size % 2 = 0 THEN 'day' ELSE 'mon' END FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 4, 'type', p_type FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 5, '_hidden', 'x' FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 6, 'title', concat(p_name, ' v2') FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 7, 'license_type', CASE WHEN p_partkey % 3 <> 0 THEN 'permissive' END FROM part
  UNION ALL SELECT p_partkey, 'global', NULL, 8, 'realm', CASE WHEN p_size % 5 = 0 THEN 'wrong!' WHEN p_size % 2 = 0 THEN 'atmos' ELSE 'aerosol' END FROM part
  UNION ALL SELECT p_partkey, 'variable', 'tas', 9, 'long_name', concat('temperature of ', p_type) FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0
  UNION ALL SELECT p_partkey, 'variable', 'tas', 10, 'units', CASE WHEN p_size % 2 = 0 THEN 'K' ELSE 'degC' END FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0
  UNION ALL SELECT p_partkey, 'variable', 'pr', 11, 'units', 'kg m-2 s-1' FROM part WHERE p_partkey % 11 <> 0
  UNION ALL SELECT p_partkey, 'variable', 'pr', 12, '_FillValue', '-999' FROM part WHERE p_partkey % 11 <> 0
  UNION ALL SELECT p_partkey, 'variable', 'lat', 13, '_CoordinateAxisType', 'Lat' FROM part WHERE p_partkey % 11 <> 0
  UNION ALL SELECT p_partkey, 'variable', 'lat', 14, 'units', 'degrees_north' FROM part WHERE p_partkey % 11 <> 0""",
    "items": """
  SELECT d.doc_id, concat('item_', d.doc_id) AS dataset_name, source AS collection, lang AS frequency, n_chars,
         o.o_orderdate AS datetime, p.url AS url
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id""",
}


def with_views(names: str, body: str, recursive: bool = False) -> str:
    """``body`` preceded by the named views and the views they need."""
    wanted: list[str] = []
    for name in names.split():
        for view in [*_DEPENDS.get(name, []), name]:
            if view not in wanted:
                wanted.append(view)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    body = body.strip()
    if body.upper().startswith("WITH "):
        body = ", " + body[5:]
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
