"""Catalogue building: attributes, facets, vocabularies, items, collections, search."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeweave.functions import literals, names

MISSING = "NA"

# For each kind of catalogue its name, its description and its columns.
# Columns that start with "variable_" hold lists over the variables of a dataset.
_KINDS = """
cmip5 | CMIP5 simulations | license_type variable_name variable_long_name activity product institute model experiment frequency modeling_realm mip_table ensemble_member version_number
biasadjusted | Bias adjusted projections. | license_type variable_name variable_long_name title institution dataset_id driving_model driving_experiment institute type processing bias_adjustment_method project_id frequency modeling_realm target_dataset driving_institution driving_institute_id
climex | Bias adjusted projections. | license_type variable_name variable_long_name title institution driving_model_id driving_experiment type processing project_id frequency modeling_realm
reanalysis | Reanalyses | license_type variable_name variable_long_name title institute_id institute dataset_id frequency
gridobs | Gridded observations | license_type variable_name variable_long_name title institute_id institute frequency dataset_id version
stationobs | station observations | license_type variable_name variable_long_name title institute_id institute frequency dataset_id
forecast | Weather forecasts | license_type variable_name variable_long_name title institution member
"""
SPEC_VERSION = "0.1.0"
ASSET_COLUMN = "path"
ASSET_FORMAT = "netcdf"


class Cell(NamedTuple):
    """One column of a catalogue: what it is filled from, and its place in the file."""

    collection: str
    column: str
    kind: str
    place: int


def _layout() -> tuple[dict[str, str], list[Cell]]:
    """Descriptions, and all columns of all catalogues: dataset columns, then lists over variables, then the asset."""
    described, cells = {}, []
    for line in _KINDS.strip().splitlines():
        collection, described_as, names_of = (part.strip() for part in line.split("|"))
        described[collection] = described_as
        kinds = [(c, "variable" if c.startswith("variable_") else "dataset") for c in names_of.split()]
        kinds = [*sorted(kinds, key=lambda k: k[1] == "variable"), (ASSET_COLUMN, "asset")]
        cells += [Cell(collection, c, kind, place) for place, (c, kind) in enumerate(kinds)]
    return described, cells


DESCRIPTIONS, LAYOUT = _layout()
COLLECTIONS = list(DESCRIPTIONS)


def cells_of(collection: str, *kinds: str) -> list[str]:
    """Columns of a catalogue in file order; of some kinds (dataset, variable, asset) if any are named."""
    return [c.column for c in LAYOUT if c.collection == collection and (not kinds or c.kind in kinds)]


def layout(spark: SparkSession) -> DataFrame:
    """The same as a table of literals: collection, column, kind, place."""
    return literals.table(spark, [tuple(c) for c in LAYOUT], "collection string, column string, kind string, place int")


def spec(collection: str) -> dict:
    """The description of one catalogue file."""
    return {
        "esmcat_version": SPEC_VERSION,
        "id": collection,
        "description": DESCRIPTIONS[collection],
        "catalog_file": f"{collection}.csv.gz",
        "attributes": [{"column_name": c} for c in cells_of(collection, "dataset", "variable")],
        "assets": {"column_name": ASSET_COLUMN, "format": ASSET_FORMAT},
    }


def collection_of(dataset: str | Column) -> Column:
    """The collection a numbered dataset is filed under."""
    kinds = F.array(*[F.lit(c) for c in COLLECTIONS])
    return F.element_at(kinds, (names.col(dataset) % len(COLLECTIONS) + 1).cast("int"))


def catalog_specs(attrs: DataFrame) -> DataFrame:
    """One spec per collection that has entries, with their number."""
    entries = attrs.groupBy(collection_of("dataset").alias("collection")).agg(F.count_distinct("dataset").alias("n_entries"))
    texts = F.create_map(*[F.lit(x) for c in COLLECTIONS for x in (c, json.dumps(spec(c), separators=(",", ":")))])
    return entries.select("collection", "n_entries", texts[F.col("collection")].alias("spec"))


def extract_attributes(attrs: DataFrame) -> DataFrame:
    """Visible attributes of a dataset, its groups and its data variables; the last duplicate wins."""
    axes = attrs.where((F.col("scope") == "variable") & (F.col("name") == "_CoordinateAxisType")).select("dataset", "variable")
    return (
        attrs.where(~F.col("name").startswith("_"))
        .join(axes.distinct(), ["dataset", "variable"], "left_anti")
        .groupBy("dataset", "scope", "variable", "name")
        .agg(F.max_by("value", "pos").alias("value"))
    )


def _last(name: str) -> Column:
    given = (F.col("scope") == "global") & (F.col("name") == name) & F.col("value").isNotNull()
    return F.max_by(F.when(given, F.col("value")), F.when(given, F.col("pos")))


def facet_table(attrs: DataFrame, facets: list[str], default: str | None = MISSING) -> DataFrame:
    """One row for every dataset, also one that has none of them, with the given global attributes as columns."""
    wide = attrs.groupBy("dataset").agg(*[_last(f).alias(f) for f in facets])
    if default is None:
        return wide
    return wide.select("dataset", *[F.coalesce(f, F.lit(default)).alias(f) for f in facets])


def variable_lists(attrs: DataFrame, facets: list[str]) -> DataFrame:
    """``variable_X`` columns: the list over data variables of their attribute X.

    The name falls back to the variable's own; anything else to "NA". Rows are
    first reduced to one per variable; the lists hold what a catalogue cell holds.
    """
    shown = extract_attributes(attrs.where(F.col("scope") == "variable"))
    first_seen = attrs.where(F.col("scope") == "variable").groupBy("dataset", "variable").agg(F.min("pos").alias("pos"))
    wanted = [f.removeprefix("variable_") for f in facets]
    per_variable = shown.groupBy("dataset", "variable").agg(
        *[F.max(F.when(F.col("name") == w, F.col("value"))).alias(f"_{w}") for w in wanted]
    )
    filled = [
        F.coalesce(f"_{w}", F.col("variable") if w == "name" else F.lit(MISSING)).alias(f) for w, f in zip(wanted, facets)
    ]
    listed = per_variable.join(first_seen, ["dataset", "variable"]).select("dataset", "pos", *filled)
    gathered = listed.groupBy("dataset").agg(F.sort_array(F.collect_list(F.struct("pos", *facets))).alias("_rows"))
    return gathered.select("dataset", *[F.col("_rows")[f].alias(f) for f in facets])


def entries(
    attrs: DataFrame, collection: str, assets: DataFrame | None = None, make: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The catalogue of a collection: its dataset columns, its variable columns,
    and the asset of each dataset (``assets``: dataset, path).

    ``make`` gives one row for each dataset of an attribute table, for
    collections whose entries are not made in the common way.
    """
    if make is not None:
        table = make(attrs)
    else:
        lists = variable_lists(attrs, cells_of(collection, "variable"))
        table = facet_table(attrs, cells_of(collection, "dataset")).join(lists, "dataset", "left")
    return table if assets is None else table.join(assets.select("dataset", ASSET_COLUMN), "dataset", "left")


def all_entries(attrs: DataFrame, assets: DataFrame) -> DataFrame:
    """The catalogues of all collections in one pass: collection, dataset, cells (in file order, as text).

    Every dataset is an entry of the collection it is filed under, also one without attributes that are asked for.
    """
    texts = list(dict.fromkeys(c.column for c in LAYOUT if c.kind == "dataset"))
    lists = list(dict.fromkeys(c.column for c in LAYOUT if c.kind == "variable"))
    wide = facet_table(attrs, texts).join(variable_lists(attrs, lists), "dataset", "left").join(assets, "dataset", "left")
    shown = {c: F.col(c) for c in texts} | {c: F.coalesce(F.array_join(c, ","), F.lit("")) for c in lists}
    shown[ASSET_COLUMN] = F.coalesce(ASSET_COLUMN, F.lit(MISSING))
    kind = collection_of("dataset")
    cells = F.lit(None).cast("array<string>")
    for k in COLLECTIONS:
        cells = F.when(kind == k, F.array(*[shown[c] for c in cells_of(k)])).otherwise(cells)
    return wide.select(kind.alias("collection"), "dataset", cells.alias("cells"))


def catalog_summary(attrs: DataFrame) -> DataFrame:
    """Entries and missing cells of every collection, in one pass over the attributes."""
    every = list(dict.fromkeys(c.column for c in LAYOUT if c.kind == "dataset"))
    wide = facet_table(attrs.where(~F.col("name").startswith("_")), every, default=None)
    kind = collection_of("dataset")
    missing = F.lit(None).cast("int")
    for k in COLLECTIONS:
        n = sum((F.col(c).isNull().cast("int") for c in cells_of(k, "dataset")), F.lit(0))
        missing = F.when(kind == k, n).otherwise(missing)
    return wide.groupBy(kind.alias("collection")).agg(
        F.count("*").alias("n_entries"), F.sum(missing).cast("bigint").alias("n_missing")
    )


def field_report(attrs: DataFrame) -> DataFrame:
    """Required fields an entry lacks and given fields its collection does not have; an entry without any field lacks all."""
    given = (F.col("scope") == "global") & ~F.col("name").startswith("_") & F.col("value").isNotNull()
    named = attrs.select("dataset", F.when(given, F.col("name")).alias("name")).distinct()
    required = F.create_map(
        *[x for k in COLLECTIONS for x in (F.lit(k), F.array(*[F.lit(c) for c in cells_of(k, "dataset")]))]
    )[collection_of("dataset")]
    known = F.array_contains(required, F.col("name"))
    return named.groupBy("dataset", collection_of("dataset").alias("collection"), F.size(required).alias("n_required")).agg(
        F.count_if(known).alias("n_found"),
        F.count_if(~known).alias("n_extra"),
        F.min(F.when(~known, F.col("name"))).alias("first_extra"),
    ).select("dataset", "collection", (F.col("n_required") - F.col("n_found")).alias("n_missing"), "n_extra", "first_extra")


def vocabulary(spark: SparkSession, terms: dict[str, dict[str, str] | list[str]]) -> DataFrame:
    """Allowed values per facet as a table of literals: (facet, value, code)."""
    rows = [
        (facet, v, allowed[v] if isinstance(allowed, dict) else v) for facet, allowed in terms.items() for v in allowed
    ]
    return literals.table(spark, rows, "facet string, value string, code string")


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The vocabularies of a folder of JSON files: facet -> list, or facet -> value -> code."""
    return read_vocabulary_lines(spark.read.text(path, wholetext=True, pathGlobFilter="*.json"))


def read_vocabulary_lines(files: DataFrame) -> DataFrame:
    """The same from texts that hold one JSON object each."""
    raw = files.select(F.explode(F.from_json("value", "map<string,string>")).alias("facet", "body"))
    listed = F.transform(F.from_json("body", "array<string>"), lambda v: F.struct(v.alias("value"), v.alias("code")))
    mapped = F.transform(
        F.map_entries(F.from_json("body", "map<string,string>")),
        lambda e: F.struct(
            e["key"].alias("value"), F.when(e["value"].startswith("{"), e["key"]).otherwise(e["value"]).alias("code")
        ),
    )
    is_list = F.ltrim("body").startswith("[")
    return raw.select("facet", F.inline(F.when(is_list, listed).otherwise(mapped)))


def check_values(attrs: DataFrame, allowed: DataFrame) -> DataFrame:
    """Values of facets that have a vocabulary, with whether it holds them.

    The vocabulary is a table of literals, so its size is known to the planner.
    """
    seen = allowed.select("facet").distinct()
    last = (
        attrs.where(F.col("scope") == "global")
        .join(seen.withColumnRenamed("facet", "name"), "name", "left_semi")
        .groupBy("dataset", F.col("name").alias("facet"))
        .agg(F.max_by("value", "pos").alias("value"))
    )
    terms = allowed.select("facet", "value", F.lit(True).alias("known"))
    return last.join(terms, ["facet", "value"], "left").select(
        "dataset", "facet", "value", F.coalesce("known", F.lit(False)).alias("ok")
    )


def fill_defaults(attrs: DataFrame, terms: dict[str, dict[str, str] | list[str]]) -> DataFrame:
    """Facets as columns; a vocabulary of one value is its default, other facets are required."""
    wide = facet_table(attrs, list(terms), default=None)
    only = {f: next(iter(v)) for f, v in terms.items() if len(v) == 1}
    filled = [F.coalesce(F.col(f), F.lit(only.get(f)).cast("string")).alias(f) for f in terms]
    done = wide.select("dataset", *filled)
    lacking = sum((F.col(f).isNull().cast("bigint") for f in terms), F.lit(0).cast("bigint"))
    return done.withColumn("n_missing", lacking)


def vocabulary_schema(allowed: DataFrame, observed: DataFrame) -> DataFrame:
    """Allowed values with the number of times each is used, and the facet's enumeration as JSON."""
    used = observed.groupBy("facet", "value").agg(F.count("*").alias("n_used"))
    # the size of a vocabulary bounds the list
    enums = allowed.groupBy("facet").agg(F.to_json(F.sort_array(F.collect_set("value"))).alias("enum"))
    return (
        allowed.join(used, ["facet", "value"], "left")
        .join(enums, "facet")
        .select("facet", "value", "code", F.coalesce("n_used", F.lit(0)).alias("n_used"), "enum")
    )


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Every row with whether it meets all rules and one line that names those it breaks."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()])
    )
    return df.withColumn("valid", F.size(broken) == 0).withColumn("reason", names.one_line(F.array_join(broken, "; ")))


def collection_name(url: str | Column) -> Column:
    """A collection name from a catalogue URL: no scheme, host, query or file; slashes become underscores."""
    path = F.regexp_replace(names.col(url), r"^[a-z]+://[^/]+/", "")
    path = F.regexp_replace(path, r"[?#].*$", "")
    path = F.regexp_replace(path, r"(/catalog)?\.(html|xml)$", "")
    return F.replace(F.regexp_replace(path, r"/+$", ""), F.lit("/"), F.lit("_"))


def cmip5_facets(df: DataFrame, url: str = "http_url", provider: str = "thredds") -> DataFrame:
    """Item metadata: constants, attributes with a default, and a part of the URL as a last resort."""
    # fixed values: constants, the attribute behind each facet, and the position of the frequency in a URL
    constants = {
        "provider": provider, "source_id": "na", "member_id": "na", "table_id": "na", "variable_id": "",
        "grid_label": "na",
    }
    attributes = {
        "activity_id": "project_id", "institution_id": "institute_id", "experiment_id": "driving_experiment",
        "conventions": "Conventions", "modeling_realm": "modeling_realm", "model_id": "model_id",
    }
    part = F.try_element_at(F.split(F.col(url), "/"), F.lit(16))

    def given(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    return df.select(
        "dataset",
        url,
        *[F.lit(v).alias(n) for n, v in constants.items()],
        *[F.coalesce(given(a), F.lit("")).alias(n) for n, a in attributes.items()],
        F.coalesce(given("frequency"), part, F.lit("")).alias("frequency"),
    )


def item_links(items: DataFrame) -> DataFrame:
    """Items with their date as text and their link relative to the catalogue root."""
    return items.select(
        "doc_id",
        "dataset_name",
        F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"),
        "n_chars",
        F.concat(F.lit("./"), "collection", F.lit("/"), "dataset_name", F.lit(".json")).alias("href"),
        "collection",
    )


# fixed values: the bounds of an item without its own footprint
WORLD = (-180.0, -180.0, 180.0, 180.0)


def polygon(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A closed ring around a box."""
    ring = [(west, south), (west, north), (east, north), (east, south), (west, south)]
    return F.array(F.array(*[F.array(x, y) for x, y in ring]))


def stac_item(
    items: DataFrame, bounds: tuple[float, float, float, float] = WORLD, provider: str = "thredds"
) -> DataFrame:
    """Nested catalogue items: geometry, box, dates, properties and assets."""
    w, s, e, n = (F.lit(float(b)) for b in bounds)
    stamp = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def asset(service: str, media: str, title: str) -> Column:
        return F.struct(
            F.concat("url", F.lit(f"#{service}")).alias("href"), F.lit(media).alias("type"), F.lit(title).alias("title")
        )

    return items.select(
        F.col("dataset_name").alias("id"),
        "collection",
        F.struct(F.lit("Polygon").alias("type"), polygon(w, s, e, n).alias("coordinates")).alias("geometry"),
        F.array(w, s, e, n).alias("bbox"),
        F.struct(
            *[stamp.alias(k) for k in ("datetime", "start_datetime", "end_datetime", "created")],
            F.lit(provider).alias("meta:provider"),
            F.lit("na").alias("cv:source_id"),
            F.col("frequency").alias("cv:frequency"),
        ).alias("properties"),
        F.struct(
            asset("httpserver", "application/netcdf", "NetCDF file").alias("metadata_http"),
            asset("iso", "application/xml", "Metadata ISO").alias("metadata_iso"),
            asset("ncml", "application/xml", "Metadata NcML").alias("metadata_ncml"),
        ).alias("assets"),
    )


def stac_collection(items: DataFrame) -> DataFrame:
    """Collections with their true time extent and size."""
    return items.groupBy(F.col("collection").alias("id")).agg(
        F.count("*").alias("n_items"), F.min("datetime").alias("start"), F.max("datetime").alias("end"), F.lit("na").alias("license")
    )


def stac_catalog(collections: DataFrame, root: str) -> DataFrame:
    """The links from a root catalogue to its collections, one row each."""
    return collections.select(
        F.lit(root).alias("catalog"),
        F.col("id").alias("child"),
        F.concat(F.lit("./"), "id", F.lit("/collection.json")).alias("href"),
    ).orderBy("child")


def search(
    items: DataFrame,
    collections: list[str] | None = None,
    between: tuple[Column, Column] | None = None,
    bbox: tuple[float, float, float, float] | None = None,
    order: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Items of some collections, in a time range, whose box meets another box."""
    found = items
    if collections is not None:
        found = found.where(F.col("collection").isin(*collections))
    if between is not None:
        found = found.where(F.col("datetime").between(*between))
    if bbox is not None:
        w, s, e, n = bbox
        found = found.where(
            (F.col("west") <= e) & (F.col("east") >= w) & (F.col("south") <= n) & (F.col("north") >= s)
        )
    if order is not None:
        found = found.orderBy(*order)
    return found if limit is None else found.limit(limit)


def asset_value(asset: str, item: str) -> Column:
    """A property of an asset, or that of its item."""
    return F.coalesce(F.col(asset), F.col(item))


# fixed values: object, data and aggregation types a descriptor may name
OBJECT_TYPES = ["attribute", "dimension", "variable", "group"]
DATA_TYPES = [
    "byte", "char", "short", "int", "long", "float", "double", "String", "string", "Structure", "Sequence", "opaque",
    "enum1", "enum2", "enum4",
]
AGGREGATION_TYPES = [
    "forecastModelRunCollection", "forecastModelRunSingleCollection", "joinExisting", "joinNew", "tiled", "union",
]


def descriptor_rules(facts: DataFrame) -> DataFrame:
    """Rule breaks of every descriptor: one row per broken rule and document."""
    kind, type_ = F.col("kind"), F.col("type")
    lowered = [t.lower() for t in AGGREGATION_TYPES]
    broken = F.array_compact(
        F.array(
            F.when((kind == "remove") & ~type_.isin(OBJECT_TYPES), F.lit("removal of an unknown kind of object")),
            F.when((kind == "attribute") & ~type_.isin(DATA_TYPES), F.lit("attribute of an unknown type")),
            F.when((kind == "aggregation") & ~type_.isin(lowered), F.lit("unknown aggregation")),
            F.when(
                kind.isin("remove", "attribute", "variable", "dimension") & F.col("name").isNull(), F.lit("name is missing")
            ),
            F.when((kind == "scan") & F.col("location").isNull(), F.lit("scan without a location")),
            F.when(
                (kind == "attribute") & F.col("value").isNull() & F.col("org_name").isNull(), F.lit("attribute without a value")
            ),
        )
    )
    return facts.select("doc_id", F.explode(broken).alias("rule")).groupBy("doc_id", "rule").agg(F.count("*").alias("n_hits"))


class Collection(NamedTuple):
    """A way to make the entries of a collection.

    facets and lists: the dataset attributes and the lists over variables that
    it needs; cells: its entry, from a column for each of them (and ``path``);
    takes: which datasets are filed under it, told by the same columns (null:
    those of ``collection_of``).
    """

    name: str
    facets: tuple[str, ...]
    lists: tuple[str, ...]
    cells: Callable[[dict[str, Column]], list[Column]]
    takes: Callable[[dict[str, Column]], Column] | None = None


def common_collection(name: str) -> Collection:
    """The common way: all columns of the catalogue as they are."""
    return Collection(name, tuple(cells_of(name, "dataset")), tuple(cells_of(name, "variable")), lambda c: [c[x] for x in cells_of(name)])


class Collections:
    """Registered collections. A registered one replaces the common one of its name, or is a collection of its own."""

    def __init__(self) -> None:
        self.known = {name: common_collection(name) for name in COLLECTIONS}

    def register(self, name: str, facets: tuple[str, ...] = (), lists: tuple[str, ...] = (), takes: Callable[[dict[str, Column]], Column] | None = None):
        """Register the function below as the ``cells`` of a collection."""

        def add(cells: Callable[[dict[str, Column]], list[Column]]) -> Callable[[dict[str, Column]], list[Column]]:
            if takes is None and name not in COLLECTIONS:
                raise ValueError(f"collection {name} takes no datasets")
            # one that was registered goes before the common ones, and before earlier ones
            self.known = {name: Collection(name, tuple(facets), tuple(lists), cells, takes), **{k: c for k, c in self.known.items() if k != name}}
            return cells

        return add

    def entries(self, attrs: DataFrame, assets: DataFrame) -> DataFrame:
        """The entries of all collections in one pass: collection, dataset, cells (text).

        Attributes are gathered once, for what all collections need together; a
        dataset goes to the first collection that takes it.
        """
        every = list(self.known.values())
        texts = list(dict.fromkeys(f for c in every for f in c.facets))
        lists = list(dict.fromkeys(f for c in every for f in c.lists))
        wide = facet_table(attrs, texts).join(variable_lists(attrs, lists), "dataset", "left").join(assets, "dataset", "left")
        shown = {c: F.col(c) for c in texts} | {c: F.coalesce(F.array_join(c, ","), F.lit("")) for c in lists}
        shown[ASSET_COLUMN] = F.coalesce(ASSET_COLUMN, F.lit(MISSING))
        kind, name = collection_of("dataset"), None
        for c in every:
            if c.takes is not None:
                hit = F.coalesce(c.takes(shown), F.lit(False))
                name = F.when(hit, c.name) if name is None else name.when(hit, c.name)
        filed = wide.withColumn("collection", kind if name is None else name.otherwise(kind))
        cells = F.lit(None).cast("array<string>")
        for c in every:
            cells = F.when(F.col("collection") == c.name, F.array(*[x.cast("string") for x in c.cells(shown)])).otherwise(cells)
        return filed.select("collection", "dataset", cells.alias("cells"))
