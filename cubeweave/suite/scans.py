"""Sources, scans, inventory and sinks."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cubeweave.functions import names
from cubeweave.operators import catalog as cat
from cubeweave.operators import virtual
from cubeweave.plans import descriptor
from cubeweave.registry import query
from cubeweave.runtime import new_dir
from cubeweave.sources import descriptors, inventory, sinks, substrate
from cubeweave.suite.views import with_views

ROOT = substrate.ROOT


@query(
    "scan_suffix",
    with_views(
        "members",
        """SELECT path, variable, year AS year FROM members
        WHERE starts_with(path, '/data/vdb/') AND regexp_matches(path, 'pr_.*0101-1999.*\\.nc$')""",
    ),
)
def scan_suffix(spark, sf):
    found = inventory.scan(substrate.members(spark, sf), ROOT, suffix="pr_*0101-1999*.nc")
    return found.select("path", "variable", F.col("year").cast("bigint"))


@query(
    "scan_regexp",
    with_views(
        "members",
        """SELECT center, model, count(*) AS n_files FROM members
        WHERE regexp_full_match(path, '.*/tas_.*NAM\\+QC_.*_ssp245_.*') AND ends_with(path, '.nc') GROUP BY 1, 2""",
    ),
)
def scan_regexp(spark, sf):
    found = inventory.scan(
        substrate.members(spark, sf), ROOT, suffix=".nc", regexp=r".*/tas_.*NAM\+QC_.*_ssp245_.*", subdirs="True"
    )
    return found.groupBy("center", "model").agg(F.count("*").alias("n_files"))


@query(
    "scan_subdirs",
    with_views(
        "members",
        """SELECT center, variable,
          count(*) FILTER (starts_with(path, concat('/data/vdb/', center, '/M-A/historical/'))) AS n_recursive,
          count(*) FILTER (regexp_replace(path, '/[^/]*$', '') =
            concat('/data/vdb/', center, '/M-A/historical/r1/day/', variable)) AS n_flat
        FROM members GROUP BY 1, 2 HAVING n_recursive > 0""",
    ),
)
def scan_subdirs(spark, sf):
    """Two scans: a directory with all below it, and one without."""
    files = substrate.members(spark, sf)
    top = F.concat(F.lit(f"{ROOT}/"), "center", F.lit("/M-A/historical"))
    deep = inventory.scan(files, top, subdirs="True").withColumn("flat", F.lit(False))
    flat = inventory.scan(files, F.concat(top, F.lit("/r1/day/"), "variable"), subdirs="false").withColumn("flat", F.lit(True))
    return deep.unionByName(flat).groupBy("center", "variable").agg(
        F.count_if(~F.col("flat")).alias("n_recursive"), F.count_if("flat").alias("n_flat")
    )


@query(
    "scan_older_than",
    with_views(
        "members",
        """SELECT variable, exp, count(*) AS n_files, strftime(max(mtime), '%Y-%m-%d') AS newest FROM members
        WHERE mtime <= TIMESTAMP '2000-01-01' - INTERVAL 30 DAY GROUP BY 1, 2""",
    ),
)
def scan_older_than(spark, sf):
    found = inventory.scan(
        substrate.members(spark, sf),
        ROOT,
        older_than=F.expr("INTERVAL '30' DAY"),
        as_of=F.lit("2000-01-01").cast("timestamp_ntz"),
    )
    return found.groupBy("variable", "exp").agg(
        F.count("*").alias("n_files"), F.max("mtime").cast("date").cast("string").alias("newest")
    )


@query(
    "scan_date_mark",
    with_views(
        "members",
        """SELECT path, strftime(try_strptime(regexp_extract(path, '_([0-9]{8})-[0-9]{8}\\.nc$', 1), '%Y%m%d'),
          '%Y-%m-%d') AS file_date FROM members""",
    ),
)
def scan_date_mark(spark, sf):
    mark = inventory.date_mark("path", r"_([0-9]{8})-[0-9]{8}\.nc$", "yyyyMMdd")
    return substrate.members(spark, sf).select("path", mark.cast("date").cast("string").alias("file_date"))


@query(
    "explicit_members",
    with_views(
        "members",
        """SELECT m.path, CAST(row_number() OVER (PARTITION BY m.center, m.model, m.run, m.exp, m.variable ORDER BY m.year) - 1
            AS BIGINT) AS ordinal, m.ncoords, r.n_values
        FROM members m JOIN (
          SELECT center, model, exp, run, domain, variable, year, count(*) AS n_values FROM records GROUP BY ALL
        ) r USING (center, model, exp, run, domain, variable, year)""",
    ),
)
def explicit_members(spark, sf):
    listed = virtual.member_list(
        substrate.members(spark, sf), ["center", "model", "run", "exp", "variable"], order=["path"]
    ).select("path", "ordinal", "ncoords")
    held = (
        substrate.records(spark, sf).groupBy(*substrate.FILE_KEYS).agg(F.count("*").alias("n_values"))
        .select(substrate.file_path(F.col("year")).alias("path"), "n_values")
    )
    return listed.join(held, "path")


@query(
    "recheck_refresh",
    with_views(
        "members",
        """SELECT variable, exp, count(*) AS n_new, CAST(sum(ncoords) AS BIGINT) AS steps_added FROM members m
        WHERE mtime <= TIMESTAMP '2000-06-30' AND NOT EXISTS (
          SELECT 1 FROM members o WHERE o.path = m.path AND o.mtime <= TIMESTAMP '1998-06-30') GROUP BY 1, 2""",
    ),
)
def recheck_refresh(spark, sf):
    files = substrate.members(spark, sf)
    before = files.where(F.col("mtime") <= F.lit("1998-06-30").cast("timestamp_ntz"))
    after = files.where(F.col("mtime") <= F.lit("2000-06-30").cast("timestamp_ntz"))
    return (
        inventory.appeared(before, after, ["path"])
        .groupBy("variable", "exp")
        .agg(F.count("*").alias("n_new"), F.sum("ncoords").alias("steps_added"))
    )


@query(
    "path_rewrite",
    with_views(
        "members",
        """SELECT path, concat('/published', substr(path, length('/data') + 1)) AS published, true AS restored FROM members""",
    ),
)
def path_rewrite(spark, sf):
    out = names.swap_prefix("path", "/data", "/published")
    back = names.swap_prefix("published", "/published", "/data")
    return (
        substrate.members(spark, sf)
        .select("path", out.alias("published"))
        .withColumn("restored", back == F.col("path"))
    )


_FACETS = ["variable", "frequency", "domain", "center", "model", "exp", "run"]


@query(
    "filename_facets",
    with_views(
        "members",
        """SELECT path, variable, 'day' AS frequency, domain, center, model, exp, run,
          concat(year, '0101') AS start, concat(year, '1231') AS "end" FROM members""",
    ),
)
def filename_facets(spark, sf):
    return substrate.members(spark, sf).select("path", *names.facets("path", _FACETS))


@query(
    "dir_facets",
    with_views(
        "members",
        """SELECT split_part(path, '/', 4) AS center, split_part(path, '/', 5) AS model, split_part(path, '/', 6) AS exp,
          split_part(path, '/', 7) AS run, split_part(path, '/', 8) AS frequency, split_part(path, '/', 9) AS variable,
          count(*) AS n_files FROM members GROUP BY ALL""",
    ),
)
def dir_facets(spark, sf):
    parts = F.split(F.col("path"), "/")
    levels = ["center", "model", "exp", "run", "frequency", "variable"]
    facets = [F.element_at(parts, i + 4).alias(n) for i, n in enumerate(levels)]
    return substrate.members(spark, sf).groupBy(*facets).agg(F.count("*").alias("n_files"))


@query(
    "common_path",
    with_views(
        "members",
        """WITH parts AS (
          SELECT center, model, exp, variable, path, unnest(string_split(path, '/')) AS part,
            generate_subscripts(string_split(path, '/'), 1) AS pos FROM members),
        sizes AS (SELECT center, model, exp, variable, count(DISTINCT path) AS n_files FROM parts GROUP BY ALL),
        level AS (SELECT center, model, exp, variable, pos, count(DISTINCT part) AS n_parts, count(*) AS n, min(part) AS part
          FROM parts GROUP BY ALL),
        stop AS (SELECT center, model, exp, variable, min(pos) AS stop FROM level JOIN sizes USING (center, model, exp, variable)
          WHERE n_parts > 1 OR n < n_files GROUP BY ALL)
        SELECT s.center, s.model, s.exp, s.variable, s.n_files, string_agg(l.part, '/' ORDER BY l.pos) AS common_path
        FROM sizes s JOIN level l USING (center, model, exp, variable) LEFT JOIN stop USING (center, model, exp, variable)
        WHERE l.pos < coalesce(stop, (SELECT max(pos) FROM level)) GROUP BY ALL""",
    ),
)
def common_path(spark, sf):
    return inventory.common_path(substrate.members(spark, sf), ["center", "model", "exp", "variable"])


_DOCS = """SELECT c_custkey AS k FROM customer"""


@query(
    "ncml_flatten",
    f"""WITH d AS ({_DOCS})
    SELECT k AS doc_id, CAST(2 + (k % 5 = 0)::INT AS BIGINT) AS n_attributes,
      CAST((k % 5 = 0)::INT + (k % 2 = 0)::INT AS BIGINT) AS n_renames,
      CAST(1 + (k % 7 = 0)::INT + (k % 3 = 0)::INT AS BIGINT) AS n_removals,
      CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k % 4 + 1 END AS BIGINT) AS n_files,
      CAST(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_scans,
      CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE [365, 730, 1096, 1461][k % 4 + 1] END AS BIGINT) AS n_steps,
      CASE WHEN k % 3 = 0 THEN 'joinexisting,joinnew,union' ELSE 'joinexisting,union' END AS aggregations
    FROM d""",
)
def ncml_flatten(spark, sf):
    facts = descriptors.facts(substrate.descriptors(spark, sf))
    of = lambda kind: F.col("kind") == kind
    types = sorted(t.lower() for t in cat.AGGREGATION_TYPES)
    return facts.groupBy("doc_id").agg(
        F.count_if(of("attribute")).alias("n_attributes"),
        F.count_if(F.col("org_name").isNotNull()).alias("n_renames"),
        F.count_if(of("remove")).alias("n_removals"),
        F.count_if(of("member") & F.col("location").isNotNull()).alias("n_files"),
        F.count_if(of("scan")).alias("n_scans"),
        F.coalesce(F.sum("ncoords"), F.lit(0)).alias("n_steps"),
        *[F.bool_or(of("aggregation") & (F.col("type") == t)).alias(t) for t in types],
    ).select(
        "doc_id", "n_attributes", "n_renames", "n_removals", "n_files", "n_scans", "n_steps",
        F.concat_ws(",", *[F.when(F.col(t), F.lit(t)) for t in types]).alias("aggregations"),
    )


@query(
    "ncml_facts",
    """WITH f(kind, node_path, ordinal, name, type, value, org_name, older_than, date_mark, section) AS (VALUES
      ('dataset', '/netcdf', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL),
      ('metadata', '/netcdf', 0, '{flag}', NULL, NULL, NULL, NULL, NULL, NULL),
      ('enum', '/netcdf', 0, 'sky', 'enum1', '0=clear', NULL, NULL, NULL, NULL),
      ('enum', '/netcdf', 1, 'sky', 'enum1', '1=rain', NULL, NULL, NULL, NULL),
      ('group', '/netcdf', 0, 'obs', NULL, NULL, NULL, NULL, NULL, NULL),
      ('attribute', '/netcdf/group[0]', 0, 'origin', 'String', '{segment}', NULL, NULL, NULL, NULL),
      ('variable', '/netcdf/group[0]', 0, 'inner', 'int', NULL, 'old', NULL, NULL, NULL),
      ('group', '/netcdf/group[0]', 0, 'deep', NULL, NULL, NULL, NULL, NULL, NULL),
      ('remove', '/netcdf/group[0]/group[0]', 0, 'tmp', 'variable', NULL, NULL, NULL, NULL, NULL),
      ('variable', '/netcdf', 0, 'rlat', 'double', NULL, NULL, NULL, NULL, NULL),
      ('variable', '/netcdf', 1, 'level', 'int', NULL, NULL, NULL, NULL, NULL),
      ('values', '/netcdf', 0, 'rlat', 'sequence', '0 0.5 {key}', NULL, NULL, NULL, NULL),
      ('values', '/netcdf', 0, 'level', 'list', '1 2 {key}', NULL, NULL, NULL, NULL),
      ('remove', '/netcdf/variable[0]', 0, 'bounds', 'attribute', NULL, NULL, NULL, NULL, NULL),
      ('aggregation', '/netcdf/aggregation[0]', 0, 'y x', 'tiled', NULL, NULL, NULL, NULL, NULL),
      ('member', '/netcdf/aggregation[0]', 0, NULL, NULL, NULL, NULL, NULL, NULL, '0:15,0:30'),
      ('scan', '/netcdf/aggregation[0]', 0, NULL, NULL, NULL, NULL, '{key} min', 'tas_#yyyyMMdd', NULL))
    SELECT c_custkey AS doc_id, kind, node_path, CAST(ordinal AS BIGINT) AS ordinal,
      replace(name, '{flag}', CASE WHEN c_custkey % 2 = 0 THEN 'explicit' ELSE 'readMetadata' END) AS name, type,
      replace(replace(value, '{key}', CAST(c_custkey AS VARCHAR)), '{segment}', c_mktsegment) AS value, org_name,
      replace(older_than, '{key}', CAST(c_custkey AS VARCHAR)) AS older_than, date_mark, section FROM customer, f""",
)
def ncml_facts(spark, sf):
    """Every fact of documents that have values, enumerations, groups, removals inside variables, scan options and sections."""
    facts = descriptors.facts(substrate.full_descriptors(spark, sf))
    return facts.select(
        "doc_id", "kind", "node_path", F.col("ordinal").cast("bigint").alias("ordinal"), "name", "type", "value", "org_name",
        "older_than", "date_mark", "section",
    )


@query(
    "ncml_edit",
    """WITH f(kind, node_path, name, value, org_name, cond) AS (VALUES
      ('attribute', '/netcdf', 'title', '{name}', NULL, 1), ('attribute', '/netcdf', 'segment', '{segment}', NULL, 1),
      ('attribute', '/netcdf', 'summary', NULL, 'comment', 5), ('remove', '/netcdf', 'height', NULL, NULL, 1),
      ('remove', '/netcdf', 'history', NULL, NULL, 7), ('remove', '/netcdf', 'tmp', NULL, NULL, 1),
      ('variable', '/netcdf', 'latitude', NULL, 'lat', 1), ('variable', '/netcdf', 'tas', NULL, NULL, 1),
      ('attribute', '/netcdf/variable[{i}]', 'units', 'K', NULL, 1))
    SELECT c_custkey AS doc_id, kind, replace(node_path, '{i}', '1') AS node_path, name,
      replace(replace(value, '{name}', c_name), '{segment}', c_mktsegment) AS value,
      CASE WHEN name = 'latitude' AND c_custkey % 2 = 1 THEN 'lat_1' ELSE org_name END AS org_name FROM customer, f WHERE c_custkey % cond = 0""",
)
def ncml_edit(spark, sf):
    """Renames, attributes of variables and removals, written to XML and read back."""
    path = new_dir(spark, "edited")
    edited = substrate.descriptors(spark, sf)
    # half of the documents have an element for the variable already, under another name
    edited = descriptors.rename_variable(descriptors.rename_variable(edited, "lat_1", "lat"), "lat", "latitude")
    edited = descriptors.set_variable_attribute(edited, "tas", "units", F.lit("degC"))
    edited = descriptors.set_variable_attribute(edited, "tas", "units", F.lit("K"))
    sinks.write_descriptors(descriptors.add_removal(edited, "tmp", "variable"), path)
    facts = descriptors.facts(sinks.read_descriptors(spark, path))
    outer = (F.col("node_path") == "/netcdf") | F.startswith("node_path", F.lit("/netcdf/variable["))
    return facts.where(F.col("kind").isin("attribute", "variable", "remove") & outer).select("doc_id", "kind", "node_path", "name", "value", "org_name")


@query(
    "key_search",
    f"""WITH d AS ({_DOCS})
    SELECT k AS doc_id, concat('/data/vdb/C', k, '/tas_', 1990 + i, '.nc') AS location FROM d, generate_series(0, 3) g(i)
      WHERE k % 3 <> 0 AND i <= k % 4
    UNION ALL SELECT k, concat('/data/vdb/C', k) FROM d WHERE k % 3 = 0""",
)
def key_search(spark, sf):
    found = descriptors.key_values(substrate.descriptors(spark, sf), "@location")
    return found.select("doc_id", F.col("value").alias("location"))


@query(
    "catalog_walk",
    with_views(
        "tree",
        """, level AS (
          SELECT concat('R', r_regionkey) AS root, concat('R', r_regionkey) AS node, -1 AS depth FROM region
          UNION ALL SELECT l.root, t.child, l.depth + 1 FROM level l JOIN tree t ON t.parent = l.node WHERE l.depth < 1)
        SELECT root, CAST(depth AS BIGINT) AS depth, count(*) AS n_nodes, min(node) AS first_node, max(node) AS last_node
        FROM level WHERE depth >= 0 GROUP BY ALL""",
        recursive=True,
    ),
)
def catalog_walk(spark, sf):
    regions = substrate.table(spark, sf, "region")
    roots = regions.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("node"))
    found = inventory.walk(substrate.tree(spark, sf), roots, depth=1)
    return found.groupBy("root", F.col("depth").cast("bigint").alias("depth")).agg(
        F.count("*").alias("n_nodes"), F.min("node").alias("first_node"), F.max("node").alias("last_node")
    )


@query(
    "catalog_walk_all",
    with_views(
        "tree",
        """, edges AS (SELECT parent, child FROM tree UNION ALL SELECT concat('C', c_custkey), concat('N', c_nationkey) FROM customer WHERE c_custkey % 10 = 0
            UNION ALL SELECT concat('S', s_suppkey), concat('C', s_suppkey) FROM supplier),
          way AS (SELECT concat('R', r_regionkey) AS root, concat('R', r_regionkey) AS node, -1 AS depth, [concat('R', r_regionkey)] AS above FROM region
            UNION ALL SELECT root, child, depth + 1, list_append(above, child) FROM way JOIN edges ON parent = node WHERE NOT list_contains(above, child))
        SELECT root, CAST(depth AS BIGINT) AS depth, substr(node, 1, 1) AS kind, count(*) AS n_nodes, min(node) AS first_node
        FROM (SELECT root, node, min(depth) AS depth FROM way WHERE depth >= 0 GROUP BY 1, 2) GROUP BY ALL""",
        recursive=True,
    ),
)
def catalog_walk_all(spark, sf):
    """The whole catalogue below each region, to any depth; some customers link back to their nation, suppliers to a customer."""
    t = lambda n: substrate.table(spark, sf, n)
    named = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    back = t("customer").where("c_custkey % 10 = 0").select(named("C", "c_custkey").alias("parent"), named("N", "c_nationkey").alias("child"))
    across = t("supplier").select(named("S", "s_suppkey").alias("parent"), named("C", "s_suppkey").alias("child"))
    edges = substrate.tree(spark, sf).unionByName(back).unionByName(across)
    found = inventory.walk_all(edges, t("region").select(named("R", "r_regionkey").alias("node")))
    return found.groupBy("root", F.col("depth").cast("bigint").alias("depth"), F.substring("node", 1, 1).alias("kind")).agg(
        F.count("*").alias("n_nodes"), F.min("node").alias("first_node")
    )


def _service_urls(spark, sf):
    """Access URLs of every page: one row per service, some services missing."""
    pages = substrate.table(spark, sf, "pages")
    offered = F.filter(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("service")) for i, s in enumerate(inventory.SERVICES)]),
        lambda s: F.col("page_id") % 7 != s["i"],
    )
    return pages.select("page_id", "url", F.inline(offered)).select(
        "page_id", "service", F.concat("url", F.lit("#"), "service").alias("url")
    )


@query(
    "service_pivot",
    "SELECT page_id, "
    + ", ".join(
        f"CASE WHEN page_id % 7 <> {i} THEN concat(url, '#{s}') ELSE '' END AS {c}"
        for i, (s, c) in enumerate(inventory.SERVICES.items())
    )
    + " FROM pages",
)
def service_pivot(spark, sf):
    return inventory.service_columns(_service_urls(spark, sf), ["page_id"])


@query(
    "crawl_snapshot",
    with_views(
        "tree",
        """SELECT substr(child, 1, 1) AS kind, count(*) AS n_first, count(*) AS n_again FROM tree GROUP BY 1""",
    ),
)
def crawl_snapshot(spark, sf):
    path = new_dir(spark, "crawl")
    kind = F.substring("child", 1, 1).alias("kind")
    crawled = substrate.tree(spark, sf)
    first = inventory.snapshot(crawled, path).groupBy(kind).agg(F.count("*").alias("n_first"))
    # the second run finds the snapshot: the empty crawl given here is not used
    again = inventory.snapshot(crawled.where("false"), path).groupBy(kind).agg(F.count("*").alias("n_again"))
    return first.join(again, "kind")


@query(
    "catalog_csv",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, coalesce(max_by(value, pos) FILTER (name = 'title' AND value IS NOT NULL), 'NA') AS title,
          coalesce(max(value) FILTER (name = 'institute'), 'NA') AS institute,
          coalesce(max(value) FILTER (name = 'frequency'), 'NA') AS frequency,
          coalesce(max(value) FILTER (name = 'license_type'), 'NA') AS license_type
        FROM attrs WHERE scope = 'global' GROUP BY 1""",
    ),
)
def catalog_csv(spark, sf):
    path = new_dir(spark, "catalog")
    table = cat.facet_table(substrate.attrs(spark, sf), ["title", "institute", "frequency", "license_type"])
    sinks.write_table(table, path)
    return sinks.read_table(
        spark, path, "dataset bigint, title string, institute string, frequency string, license_type string"
    )


_SPECS = ", ".join(
    f"({i}, '{c}', '{json.dumps(cat.spec(c), separators=(',', ':'))}')" for i, c in enumerate(cat.COLLECTIONS)
)


@query(
    "esm_spec",
    f"""SELECT collection, spec, count(*) AS n_entries FROM part JOIN (VALUES {_SPECS}) s(i, collection, spec)
    ON p_partkey % {len(cat.COLLECTIONS)} = i GROUP BY 1, 2""",
)
def esm_spec(spark, sf):
    return cat.catalog_specs(substrate.attrs(spark, sf))


@query(
    "ncml_write",
    f"""WITH d AS ({_DOCS})
    SELECT k AS doc_id, CAST(3 + (k % 5 = 0)::INT AS BIGINT) AS n_attributes,
      CAST(2 + (k % 7 = 0)::INT + (k % 3 = 0)::INT AS BIGINT) AS n_removals,
      CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE k % 4 + 1 END AS BIGINT) AS n_files,
      concat('doc ', k) AS comment FROM d""",
)
def ncml_write(spark, sf):
    path = new_dir(spark, "descriptors")
    edited = descriptors.add_attribute(substrate.descriptors(spark, sf), "comment", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    edited = descriptors.add_removal(descriptors.add_removal(edited, "time_vectors", "variable"), "height", "variable")
    sinks.write_descriptors(edited, path)
    facts = descriptors.facts(sinks.read_descriptors(spark, path))
    of = lambda kind: F.col("kind") == kind
    return facts.groupBy("doc_id").agg(
        F.count_if(of("attribute")).alias("n_attributes"),
        F.count_if(of("remove")).alias("n_removals"),
        F.count_if(of("member") & F.col("location").isNotNull()).alias("n_files"),
        F.max(F.when(F.col("name") == "comment", F.col("value"))).alias("comment"),
    )


@query(
    "stac_persist",
    with_views(
        "items",
        """SELECT collection, count(*) AS n_items, count(datetime) AS n_dated, CAST(sum(n_chars) AS BIGINT) AS n_chars,
          min(concat('./', collection, '/', dataset_name, '.json')) AS first_link FROM items GROUP BY 1""",
    ),
)
def stac_persist(spark, sf):
    path = new_dir(spark, "stac")
    items = cat.item_links(substrate.items(spark, sf))
    sinks.write_json_by(items, "collection", path)
    back = sinks.read_json_by(
        spark, path, "doc_id bigint, dataset_name string, datetime string, n_chars bigint, href string, collection string"
    )
    return back.groupBy("collection").agg(
        F.count("*").alias("n_items"),
        F.count("datetime").alias("n_dated"),
        F.sum("n_chars").alias("n_chars"),
        F.min("href").alias("first_link"),
    )


@query(
    "encode_cast",
    with_views(
        "grid",
        """SELECT realization, count(*) AS n, CAST(min(CAST(tas AS FLOAT)) AS DOUBLE) AS tas_min,
          CAST(max(CAST(pr AS FLOAT)) AS DOUBLE) AS pr_max,
          CAST(sum(date_diff('day', DATE '1970-01-01', CAST(time AS DATE))) AS DOUBLE) AS days FROM grid GROUP BY 1""",
    ),
)
def encode_cast(spark, sf):
    path = new_dir(spark, "packed")
    sinks.write_packed(substrate.grid(spark, sf), path, times=["time"], partition=["realization"])
    back = spark.read.parquet(path)
    return back.groupBy("realization").agg(
        F.count("*").alias("n"),
        F.min("tas").cast("double").alias("tas_min"),
        F.max("pr").cast("double").alias("pr_max"),
        F.sum("time").alias("days"),
    )


@query(
    "encode_hours",
    with_views(
        "arrivals",
        """SELECT cycle, count(*) AS n, CAST(sum(epoch(time) / 86400) AS DOUBLE) AS days, CAST(max(epoch(time) / 86400) AS DOUBLE) AS last FROM arrivals GROUP BY 1""",
    ),
)
def encode_hours(spark, sf):
    """Forecast times, three-hourly, as fractions of a day."""
    path = new_dir(spark, "packed")
    rows = substrate.arrivals(spark, sf).select("cycle", "source", "time", "value")
    sinks.write_packed(rows, path, times=["time"], partition=["source"])
    back = spark.read.parquet(path)
    return back.groupBy("cycle").agg(F.count("*").alias("n"), F.sum("time").alias("days"), F.max("time").alias("last"))


@query(
    "descriptor_read",
    with_views(
        "members",
        """WITH docs AS (SELECT c_custkey AS doc_id FROM customer),
          listed AS (SELECT doc_id, count(*) AS n_listed FROM (SELECT doc_id, unnest(range(0, 1 + doc_id % 4)) FROM docs WHERE doc_id % 3 <> 0) GROUP BY 1),
          scanned AS (SELECT doc_id, m.* FROM docs JOIN members m ON m.center = concat('C', doc_id) WHERE doc_id % 3 = 0),
          files AS (SELECT doc_id, count(*) AS n_files FROM scanned GROUP BY 1),
          c AS (SELECT s.doc_id, r.time, r.lat, r.lon, sum(r.value) FILTER (variable = 'tas') AS tas, sum(r.value) FILTER (variable = 'pr') AS pr
            FROM scanned s JOIN records r USING (center, model, exp, run, domain, variable, year) GROUP BY 1, 2, 3, 4),
          t AS (SELECT doc_id, count(*) AS n_cells, CAST(sum(tas) AS DOUBLE) AS tas, CAST(sum(pr) AS DOUBLE) AS pr FROM c GROUP BY 1)
        SELECT doc_id, CASE WHEN f.doc_id IS NOT NULL THEN 'r1' END AS label, CASE WHEN doc_id % 2 = 0 THEN 'lat_1' ELSE 'lat' END AS lat_name,
          coalesce(n_files, 0) AS n_files, coalesce(n_listed, 0) AS n_absent, n_cells, tas, pr
        FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN files f USING (doc_id) LEFT JOIN t USING (doc_id)
        WHERE n_listed IS NOT NULL OR f.doc_id IS NOT NULL""",
    ),
)
def descriptor_read(spark, sf):
    """From documents to rows: parse, resolve against the inventory, read, merge, total per document."""
    # facts are used four times and are small: documents are parsed once
    path = new_dir(spark, "facts")
    descriptors.facts(substrate.descriptors(spark, sf)).write.parquet(path)
    found, files = spark.read.parquet(path), substrate.with_short_keys(substrate.members(spark, sf))
    # the files of the documents are used twice: they are looked up once
    path = new_dir(spark, "members")
    descriptor.member_files(found, files).write.parquet(path)
    members = spark.read.parquet(path)
    held = members.groupBy("doc_id").agg(
        F.max("label").alias("label"), F.count_if("found").alias("n_files"), F.count_if(~F.col("found")).alias("n_absent")
    )
    lines = substrate.lines(spark, sf)
    rows = descriptor.cells(found, files, lines, substrate.SHORT_KEYS, ["time", "lat", "lon"], held=members, value=substrate.value_of())
    cube = rows.groupBy("doc_id", "time", "lat", "lon").agg(
        *[F.sum(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in ("tas", "pr")]
    )
    totals = cube.groupBy("doc_id").agg(F.count("*").alias("n_cells"), F.sum("tas").cast("double").alias("tas"), F.sum("pr").cast("double").alias("pr"))
    named = descriptor.renamed(found, "variable").where("org_name = 'lat'").select("doc_id", "name")
    out = held.join(totals, "doc_id", "left").join(named, "doc_id", "left")
    return out.select("doc_id", "label", F.coalesce("name", F.lit("lat")).alias("lat_name"), "n_files", "n_absent", "n_cells", "tas", "pr")
