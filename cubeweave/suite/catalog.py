"""Catalogue building, validation, search."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from cubeweave.functions import literals
from cubeweave.operators import catalog as cat
from cubeweave.operators import tables
from cubeweave.registry import query
from cubeweave.runtime import new_dir
from cubeweave.sources import descriptors, substrate
from cubeweave.suite.views import with_views

_LAST = """visible AS (SELECT dataset, scope, variable, name, value, row_number() OVER (PARTITION BY dataset, scope, variable, name ORDER BY pos DESC) AS k
          FROM attrs a WHERE NOT starts_with(name, '_') AND NOT EXISTS (
            SELECT 1 FROM attrs x WHERE x.dataset = a.dataset AND x.variable = a.variable AND x.name = '_CoordinateAxisType'))"""


@query(
    "extract_attrs",
    with_views("attrs", f"WITH {_LAST} SELECT CAST(dataset AS BIGINT) AS dataset, scope, variable, name, value FROM visible WHERE k = 1"),
)
def extract_attrs(spark, sf):
    return cat.extract_attributes(substrate.attrs(spark, sf))


_FACETS = ["title", "institute", "frequency", "type", "license_type", "version"]


@query(
    "catalog_facets",
    with_views(
        "attrs",
        "SELECT CAST(dataset AS BIGINT) AS dataset, "
        + ", ".join(f"coalesce(arg_max(value, pos) FILTER (name = '{f}' AND value IS NOT NULL), 'NA') AS {f}" for f in _FACETS)
        + " FROM attrs WHERE scope = 'global' GROUP BY 1",
    ),
)
def catalog_facets(spark, sf):
    return cat.facet_table(substrate.attrs(spark, sf), _FACETS)


@query(
    "variable_lists",
    """SELECT p_partkey AS dataset,
      CASE WHEN p_partkey % 13 = 0 THEN 'pr' ELSE 'tas,pr' END AS variable_name,
      CASE WHEN p_partkey % 13 = 0 THEN 'NA' ELSE concat('temperature of ', p_type, ',NA') END AS variable_long_name,
      CASE WHEN p_partkey % 13 = 0 THEN 'kg m-2 s-1' WHEN p_size % 2 = 0 THEN 'K,kg m-2 s-1' ELSE 'degC,kg m-2 s-1' END AS variable_units
    FROM part WHERE p_partkey % 11 <> 0""",
)
def variable_lists(spark, sf):
    facets = ["variable_name", "variable_long_name", "variable_units"]
    lists = cat.variable_lists(substrate.attrs(spark, sf), facets)
    return lists.select("dataset", *[F.array_join(f, ",").alias(f) for f in facets])


def _in_collection(collection: str) -> str:
    return f"dataset % {len(cat.COLLECTIONS)} = {cat.COLLECTIONS.index(collection)}"


@query(
    "catalog_by_collection",
    with_views(
        "attrs",
        "WITH found AS (SELECT DISTINCT dataset, name FROM attrs WHERE scope = 'global' AND value IS NOT NULL AND NOT starts_with(name, '_'))"
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS collection, (SELECT count(*) FROM part WHERE {_in_collection(c).replace('dataset', 'p_partkey')}) AS n_entries,
            (SELECT count(*) FROM part WHERE {_in_collection(c).replace('dataset', 'p_partkey')}) * {len(cat.cells_of(c, 'dataset'))} - count(*) AS n_missing
            FROM found WHERE {_in_collection(c)} AND name IN ({", ".join(f"'{x}'" for x in cat.cells_of(c, 'dataset'))})"""
            for c in cat.COLLECTIONS
        ),
    ),
)
def catalog_by_collection(spark, sf):
    return cat.catalog_summary(substrate.attrs(spark, sf))


_ALL_COLUMNS = sorted({c.column for c in cat.LAYOUT if c.kind == "dataset"})
_CELLS = "CASE " + " ".join(
    f"WHEN {_in_collection(c)} THEN concat_ws('|', {', '.join('coalesce(' + x + ', ' + repr('' if x.startswith('variable_') else 'NA') + ')' for x in cat.cells_of(c))})"
    for c in cat.COLLECTIONS
) + " END"


@query(
    "catalog_entries",
    with_views(
        "attrs",
        f"""WITH w AS (SELECT dataset, {", ".join(f"arg_max(value, pos) FILTER (scope = 'global' AND name = '{c}' AND value IS NOT NULL) AS {c}" for c in _ALL_COLUMNS)}
            FROM attrs GROUP BY 1),
          v AS (SELECT p_partkey AS dataset, CASE WHEN p_partkey % 13 = 0 THEN 'pr' ELSE 'tas,pr' END AS variable_name,
            CASE WHEN p_partkey % 13 = 0 THEN 'NA' ELSE concat('temperature of ', p_type, ',NA') END AS variable_long_name FROM part WHERE p_partkey % 11 <> 0),
          f AS (SELECT p_partkey AS dataset, concat('/data/vdb/', p_brand, '/', p_partkey, '.nc') AS path FROM part WHERE p_size % 4 <> 0),
          e AS (SELECT * FROM w LEFT JOIN v USING (dataset) LEFT JOIN f USING (dataset))
        SELECT {repr(cat.COLLECTIONS)}[dataset % {len(cat.COLLECTIONS)} + 1] AS collection, CAST(dataset AS BIGINT) AS dataset, {_CELLS} AS cells FROM e""",
    ),
)
def catalog_entries(spark, sf):
    """The rows of the seven catalogue files; a fourth of the datasets has no file."""
    files = substrate.table(spark, sf, "part").where(F.col("p_size") % 4 != 0).select(
        F.col("p_partkey").alias("dataset"),
        F.concat_ws("/", F.lit(substrate.ROOT), "p_brand", F.concat(F.col("p_partkey").cast("string"), F.lit(".nc"))).alias("path"),
    )
    rows = cat.all_entries(substrate.attrs(spark, sf), files)
    return rows.select("collection", "dataset", F.array_join("cells", "|").alias("cells"))


def _plugged() -> cat.Collections:
    """The common collections, one of them replaced, and one of its own."""
    kinds = cat.Collections()

    @kinds.register("reanalysis", facets=("title", "frequency"), lists=("variable_name",))
    def reanalysis(c):
        return [F.upper(c["title"]), F.concat_ws("/", c["frequency"], c["variable_name"])]

    @kinds.register("permissive monthly", facets=("type", "license_type", "frequency"), takes=lambda c: (c["license_type"] == "permissive") & (c["frequency"] == "mon"))
    def monthly(c):
        return [c["type"], c["path"]]

    return kinds


@query(
    "catalog_plugins",
    with_views(
        "attrs",
        f"""WITH w AS (SELECT dataset, {", ".join(f"arg_max(value, pos) FILTER (scope = 'global' AND name = '{c}' AND value IS NOT NULL) AS {c}" for c in sorted({*_ALL_COLUMNS, "type"}))}
            FROM attrs GROUP BY 1),
          v AS (SELECT p_partkey AS dataset, CASE WHEN p_partkey % 13 = 0 THEN 'pr' ELSE 'tas,pr' END AS variable_name,
            CASE WHEN p_partkey % 13 = 0 THEN 'NA' ELSE concat('temperature of ', p_type, ',NA') END AS variable_long_name FROM part WHERE p_partkey % 11 <> 0),
          f AS (SELECT p_partkey AS dataset, concat('/data/vdb/', p_brand, '/', p_partkey, '.nc') AS path FROM part WHERE p_size % 4 <> 0),
          e AS (SELECT *, {repr(cat.COLLECTIONS)}[dataset % {len(cat.COLLECTIONS)} + 1] AS kind FROM w LEFT JOIN v USING (dataset) LEFT JOIN f USING (dataset))
        SELECT CASE WHEN license_type = 'permissive' AND frequency = 'mon' THEN 'permissive monthly' ELSE kind END AS collection, CAST(dataset AS BIGINT) AS dataset,
          CASE WHEN license_type = 'permissive' AND frequency = 'mon' THEN concat_ws('|', coalesce(type, 'NA'), coalesce(path, 'NA'))
            WHEN kind = 'reanalysis' THEN concat_ws('|', upper(coalesce(title, 'NA')), concat_ws('/', coalesce(frequency, 'NA'), coalesce(variable_name, '')))
            ELSE {_CELLS} END AS cells FROM e""",
    ),
)
def catalog_plugins(spark, sf):
    """The catalogues with two plug-ins: one replaces a collection, one takes datasets of all others."""
    files = substrate.table(spark, sf, "part").where(F.col("p_size") % 4 != 0).select(
        F.col("p_partkey").alias("dataset"),
        F.concat_ws("/", F.lit(substrate.ROOT), "p_brand", F.concat(F.col("p_partkey").cast("string"), F.lit(".nc"))).alias("path"),
    )
    rows = _plugged().entries(substrate.attrs(spark, sf), files)
    return rows.select("collection", "dataset", F.array_join("cells", "|").alias("cells"))


_REQUIRED = "CASE " + " ".join(
    f"WHEN {_in_collection(c)} THEN [{', '.join(repr(x) for x in cat.cells_of(c, 'dataset'))}]" for c in cat.COLLECTIONS
) + " END"


@query(
    "required_fields",
    with_views(
        "attrs",
        f"""WITH g AS (SELECT DISTINCT dataset, name, {_REQUIRED} AS need FROM attrs
            WHERE scope = 'global' AND value IS NOT NULL AND NOT starts_with(name, '_'))
        SELECT CAST(dataset AS BIGINT) AS dataset, {repr(cat.COLLECTIONS)}[dataset % {len(cat.COLLECTIONS)} + 1] AS collection,
          len(any_value(need)) - count(*) FILTER (list_contains(need, name)) AS n_missing,
          count(*) FILTER (NOT list_contains(need, name)) AS n_extra, min(name) FILTER (NOT list_contains(need, name)) AS first_extra
        FROM g GROUP BY 1, 2""",
    ),
)
def required_fields(spark, sf):
    return cat.field_report(substrate.attrs(spark, sf))


# a controlled vocabulary: facet -> value -> code, or facet -> values
TERMS = {
    "realm": {"aerosol": "AER", "atmos": "ATM", "land": "LND"},
    "frequency": ["day", "mon", "yr"],
    "license_type": ["permissive"],
}


@query(
    "cv_validate",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, name AS facet, value,
          coalesce((name = 'realm' AND value IN ('aerosol', 'atmos', 'land')) OR (name = 'frequency' AND value IN ('day', 'mon', 'yr'))
            OR (name = 'license_type' AND value = 'permissive'), false) AS ok
        FROM attrs WHERE scope = 'global' AND name IN ('realm', 'frequency', 'license_type')""",
    ),
)
def cv_validate(spark, sf):
    return cat.check_values(substrate.attrs(spark, sf), cat.vocabulary(spark, TERMS))


@query(
    "cv_default",
    with_views(
        "attrs",
        """SELECT CAST(dataset AS BIGINT) AS dataset, coalesce(max(value) FILTER (name = 'license_type'), 'permissive') AS license_type,
          max(value) FILTER (name = 'frequency') AS frequency, 'CMIP' AS activity, CAST(NULL AS VARCHAR) AS product, 1::BIGINT AS n_missing
        FROM attrs WHERE scope = 'global' GROUP BY 1""",
    ),
)
def cv_default(spark, sf):
    terms = {**{k: TERMS[k] for k in ("license_type", "frequency")}, "activity": ["CMIP"], "product": ["output1", "output2"]}
    return cat.fill_defaults(substrate.attrs(spark, sf), terms)


@query(
    "cv_schema",
    with_views(
        "attrs",
        """WITH v(facet, value, code, enum) AS (VALUES ('realm', 'aerosol', 'AER', '["aerosol","atmos","land"]'), ('realm', 'atmos', 'ATM', '["aerosol","atmos","land"]'),
            ('realm', 'land', 'LND', '["aerosol","atmos","land"]'), ('frequency', 'day', 'day', '["day","mon","yr"]'),
            ('frequency', 'mon', 'mon', '["day","mon","yr"]'), ('frequency', 'yr', 'yr', '["day","mon","yr"]'),
            ('license_type', 'permissive', 'permissive', '["permissive"]'))
        SELECT facet, v.value, code, enum, count(a.value) AS n_used FROM v
        LEFT JOIN attrs a ON a.scope = 'global' AND a.name = facet AND a.value = v.value GROUP BY 1, 2, 3, 4""",
    ),
)
def cv_schema(spark, sf):
    path = new_dir(spark, "vocabulary")
    # one JSON file per facet, as vocabularies are published
    for facet, terms in TERMS.items():
        text = literals.table(spark, [(json.dumps({facet: terms}),)], "value string")
        text.coalesce(1).write.text(os.path.join(path, facet))
    allowed = cat.read_vocabulary_lines(spark.read.text([os.path.join(path, f) for f in TERMS]))
    observed = substrate.attrs(spark, sf).where((F.col("scope") == "global") & F.col("name").isin(*TERMS))
    return cat.vocabulary_schema(allowed, observed.select(F.col("name").alias("facet"), "value"))


@query(
    "validate_split",
    with_views(
        "attrs",
        """WITH w AS (SELECT dataset, arg_max(value, pos) FILTER (name = 'title') AS title, max(value) FILTER (name = 'realm') AS realm,
            max(value) FILTER (name = 'license_type') AS license_type FROM attrs WHERE scope = 'global' GROUP BY 1)
        SELECT CAST(dataset AS BIGINT) AS dataset, realm <> 'wrong!' AND license_type IS NOT NULL AND length(title) < 14 AS valid,
          concat_ws('; ', CASE WHEN realm = 'wrong!' THEN 'realm is not allowed' END,
            CASE WHEN license_type IS NULL THEN 'license is missing' END, CASE WHEN length(title) >= 14 THEN 'title is too long' END) AS reason
        FROM w""",
    ),
)
def validate_split(spark, sf):
    entries = cat.facet_table(substrate.attrs(spark, sf), ["title", "realm", "license_type"], default=None)
    checked = cat.validate(
        entries,
        {
            "realm is not allowed": F.col("realm").isin("aerosol", "atmos"),
            "license is\nmissing": F.col("license_type").isNotNull(),
            "title is too long": F.length("title") < 14,
        },
    )
    return checked.select("dataset", "valid", "reason")


_FIXED_URL = "https://data.example.org/a/b/c/d/e/f/g/h/i/j/k/l"


@query(
    "cmip5_facets",
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'https://data.example.org/short.nc'
          ELSE concat('{_FIXED_URL}/', split_part(url, '/', 4), '/file.nc') END AS http_url FROM pages)
    SELECT page_id AS dataset, http_url, 'thredds' AS provider, 'na' AS source_id, 'na' AS member_id, 'na' AS table_id,
      '' AS variable_id, 'na' AS grid_label, '' AS activity_id, coalesce(p_brand, '') AS institution_id, '' AS experiment_id,
      '' AS conventions, '' AS modeling_realm, '' AS model_id,
      CASE WHEN p_partkey IS NOT NULL AND p_partkey % 3 <> 0 THEN CASE WHEN p_size % 2 = 0 THEN 'day' ELSE 'mon' END
        WHEN page_id % 5 = 0 THEN '' ELSE split_part(http_url, '/', 16) END AS frequency
    FROM p LEFT JOIN part ON p_partkey = page_id""",
)
def cmip5_facets(spark, sf):
    given = substrate.attrs(spark, sf).where((F.col("name") != "frequency") | (F.col("dataset") % 3 != 0))
    renamed = given.withColumn("name", F.when(F.col("name") == "institute", "institute_id").otherwise(F.col("name")))
    entries = cat.facet_table(renamed, ["institute_id", "frequency", "project_id"], default=None)
    long_url = F.concat(F.lit(f"{_FIXED_URL}/"), F.try_element_at(F.split("url", "/"), F.lit(4)), F.lit("/file.nc"))
    pages = substrate.table(spark, sf, "pages").select(
        F.col("page_id").alias("dataset"),
        F.when(F.col("page_id") % 5 == 0, F.lit("https://data.example.org/short.nc")).otherwise(long_url).alias("http_url"),
    )
    return cat.cmip5_facets(pages.join(entries, "dataset", "left"))


@query(
    "collection_name",
    """SELECT page_id, replace(rtrim(regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '[?#].*$', ''),
      '(/catalog)?\\.(html|xml)$', ''), '/'), '/', '_') AS collection FROM pages""",
)
def collection_name(spark, sf):
    return substrate.table(spark, sf, "pages").select("page_id", cat.collection_name("url").alias("collection"))


@query(
    "stac_item",
    with_views(
        "items",
        """SELECT dataset_name AS id, collection, frequency AS frequency, -180::DOUBLE AS west, 180::DOUBLE AS north, 5::BIGINT AS n_corners,
          strftime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS start, concat(url, '#httpserver') AS http FROM items""",
    ).replace("concat(url, '#httpserver')", "url || '#httpserver'"),
)
def stac_item(spark, sf):
    made = cat.stac_item(substrate.items(spark, sf))
    text = made.select("id", F.to_json(F.struct(*made.columns)).alias("body"))
    # read back from the JSON text, which is what a catalogue holds
    got = lambda path: F.get_json_object("body", path)
    return text.select(
        "id",
        got("$.collection").alias("collection"),
        got("$.properties['cv:frequency']").alias("frequency"),
        got("$.bbox[0]").cast("double").alias("west"),
        got("$.bbox[3]").cast("double").alias("north"),
        F.size(F.from_json(got("$.geometry.coordinates[0]"), "array<array<double>>")).cast("bigint").alias("n_corners"),
        got("$.properties.start_datetime").alias("start"),
        got("$.assets.metadata_http.href").alias("http"),
    )


@query(
    "stac_collection",
    with_views(
        "items",
        """SELECT collection AS id, count(*) AS n_items, strftime(min(datetime), '%Y-%m-%d') AS start, strftime(max(datetime), '%Y-%m-%d') AS "end",
          'na' AS license FROM items GROUP BY 1""",
    ),
)
def stac_collection(spark, sf):
    made = cat.stac_collection(substrate.items(spark, sf))
    day = lambda c: F.col(c).cast("date").cast("string").alias(c)
    return made.select("id", "n_items", day("start"), day("end"), "license")


@query(
    "stac_catalog",
    "SELECT DISTINCT 'root' AS catalog, source AS child, concat('./', source, '/collection.json') AS href FROM documents",
)
def stac_catalog(spark, sf):
    return cat.stac_catalog(cat.stac_collection(substrate.items(spark, sf)), "root")


def _boxed(items):
    """Items with a box, from their size."""
    west = F.col("n_chars") % 300 - 180
    south = F.col("n_chars") % 120 - 60
    return items.select("*", west.alias("west"), (west + 20).alias("east"), south.alias("south"), (south + 10).alias("north"))


@query(
    "stac_search",
    with_views(
        "items",
        """SELECT dataset_name, collection, strftime(datetime, '%Y-%m-%d') AS day FROM (
          SELECT *, n_chars % 300 - 180 AS west, n_chars % 120 - 60 AS south FROM items)
        WHERE collection IN ('src1', 'src2', 'src3', 'src4', 'src5') AND datetime BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2000-01-01'
          AND west <= 40 AND west + 20 >= -90 AND south <= 50 AND south + 10 >= -30 ORDER BY datetime, dataset_name LIMIT 5""",
    ),
)
def stac_search(spark, sf):
    span = (F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("2000-01-01").cast("timestamp_ntz"))
    found = cat.search(
        _boxed(substrate.items(spark, sf)),
        collections=[f"src{i}" for i in range(1, 6)],
        between=span,
        bbox=(-90, -30, 40, 50),
        order=[F.col("datetime"), F.col("dataset_name")],
        limit=5,
    )
    return found.select("dataset_name", "collection", F.col("datetime").cast("date").cast("string").alias("day"))


@query(
    "stac_upsert",
    with_views(
        "items",
        """WITH old AS (SELECT dataset_name, n_chars FROM items WHERE datetime IS NULL OR datetime < TIMESTAMP '1998-07-01'),
          new AS (SELECT dataset_name, n_chars + 1 AS n_chars FROM items WHERE datetime >= TIMESTAMP '1997-01-01')
        SELECT dataset_name, coalesce(new.n_chars, old.n_chars) AS n_chars,
          CASE WHEN new.n_chars IS NULL THEN 'kept' WHEN old.n_chars IS NULL THEN 'created' ELSE 'replaced' END AS action
        FROM old FULL JOIN new USING (dataset_name)""",
    ),
)
def stac_upsert(spark, sf):
    items = substrate.items(spark, sf)
    dated = F.col("datetime")
    old = items.where(dated.isNull() | (dated < F.lit("1998-07-01").cast("timestamp_ntz"))).select("dataset_name", "n_chars")
    new = items.where(dated >= F.lit("1997-01-01").cast("timestamp_ntz")).select("dataset_name", (F.col("n_chars") + 1).alias("n_chars"))
    return tables.upsert(old, new, ["dataset_name"])


@query(
    "stac_delete",
    with_views(
        "items",
        """SELECT 'item' AS kind, collection, count(*) AS n FROM items WHERE collection NOT IN ('src1', 'src7') GROUP BY 2
        UNION ALL SELECT 'collection', collection, 1 FROM (SELECT DISTINCT collection FROM items WHERE collection NOT IN ('src1', 'src7'))""",
    ),
)
def stac_delete(spark, sf):
    items = substrate.items(spark, sf).select("collection", "dataset_name")
    wiped = literals.table(spark, [("src1",), ("src7",)], "collection string")
    left, parents = tables.delete_with_children(items.select("collection").distinct(), items, wiped, ["collection"])
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), "collection").agg(F.count("*").alias("n"))
    return count(left, "item").unionByName(count(parents, "collection"))


@query(
    "asset_override",
    with_views(
        "items",
        "SELECT dataset_name, coalesce(split_part(url, '/', 4), frequency) AS variable_id FROM items",
    ),
)
def asset_override(spark, sf):
    items = substrate.items(spark, sf).withColumn("asset_value", F.try_element_at(F.split("url", "/"), F.lit(4)))
    return items.select("dataset_name", cat.asset_value("asset_value", "frequency").alias("variable_id"))


@query(
    "schema_rules",
    "SELECT c_custkey AS doc_id, 'removal of an unknown kind of object' AS rule, 1::BIGINT AS n_hits FROM customer WHERE c_custkey % 7 = 0",
)
def schema_rules(spark, sf):
    return cat.descriptor_rules(descriptors.facts(substrate.descriptors(spark, sf)))


@query(
    "schema_rules_all",
    """WITH r(n, rule, hits) AS (VALUES (2, 'attribute of an unknown type', 1), (3, 'unknown aggregation', 1), (5, 'name is missing', 2), (7, 'scan without a location', 1),
        (11, 'attribute without a value', 1), (13, 'removal of an unknown kind of object', 1))
    SELECT c_custkey AS doc_id, rule, hits::BIGINT AS n_hits FROM customer, r WHERE c_custkey % n = 0""",
)
def schema_rules_all(spark, sf):
    """Documents that break each of the rules."""
    return cat.descriptor_rules(descriptors.facts(substrate.broken_descriptors(spark, sf)))
