"""Descriptor documents (XML text) as one table of facts, edits of them, and the files they name.

Documents are read at any depth (``markup.elements``), one row for each
element, and every element is a fact. Reading is lenient: child order is
ignored, aggregation types and booleans are taken in any case. Edits change the text
itself, so what they do not touch stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.functions import marks, names
from cubeweave.sources import markup

FACT = (
    "kind string, node_path string, ordinal int, name string, type string, value string, org_name string, "
    "location string, ncoords bigint, coord_value string, suffix string, regexp string, subdirs boolean, "
    "recheck string, time_units_change boolean, older_than string, date_mark string, section string, "
    "options map<string,string>"
)

#: Elements that are a fact of their own, and what the fact is called.
_KINDS = {
    "attribute": "attribute", "remove": "remove", "variable": "variable", "dimension": "dimension", "group": "group",
    "values": "values", "enum": "enum", "explicit": "metadata", "readMetadata": "metadata", "aggregation": "aggregation",
    "scan": "scan", "scanFmrc": "scan_fmrc", "variableAgg": "variable_agg", "promoteGlobalAttribute": "promote",
    "cacheVariable": "cache", "logicalSection": "logical_section", "logicalSlice": "logical_slice", "logicalReduce": "logical_reduce",
    "unreadable": "unreadable",
}


def facts(docs: DataFrame, key: str = "doc_id", xml: str = "xml") -> DataFrame:
    """All facts of documents, one for each element at any depth: (key, kind, node_path, ordinal, ..., options).

    node_path is the path of what holds the element; that of an aggregation is
    its own, and values and enumeration entries stand where their variable or
    type stands, under its name. options has every XML attribute as it is, so nothing is
    lost; an element without a kind of its own is a fact named by its element. Text that is no
    document is one fact, ``unreadable``.
    """
    rows = markup.elements(docs, key, xml).where("element <> 'enumTypedef'")
    given = lambda n: F.try_element_at("given", F.lit(n))
    outer = lambda n: F.try_element_at("outer_given", F.lit(n))
    is_ = lambda *e: F.col("element").isin(*e)
    kinds = F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv])
    kind = F.when(F.col("outer").isNull() & is_("netcdf"), "dataset").when(is_("netcdf"), "member").otherwise(F.coalesce(F.try_element_at(kinds, "element"), "element"))
    yes = lambda n: F.lower(given(n)) == "true"
    inner = is_("values", "enum")
    generated = is_("values") & given("npts").isNotNull()
    value = (
        F.when(is_("enum"), F.concat(given("key"), F.lit("="), F.coalesce("text", F.lit(""))))
        # generated values are told as text, listed ones as they stand
        .when(is_("values"), F.coalesce("text", F.concat_ws(" ", given("start"), given("increment"), given("npts"))))
        .when(is_("unreadable"), F.col("text"))
        .otherwise(F.coalesce(given("value"), F.when(is_("attribute"), F.col("text"))))
    )
    type_ = (
        F.when(is_("aggregation"), F.lower(given("type")))
        .when(is_("attribute"), F.coalesce(given("type"), F.lit("String")))
        .when(is_("enum"), outer("type"))
        .when(is_("values"), F.when(generated, "sequence").otherwise("list"))
        .otherwise(given("type"))
    )
    name = (
        F.when(inner, outer("name"))
        .when(is_("explicit", "readMetadata"), F.col("element"))
        .when(is_("aggregation", "logicalSlice"), given("dimName"))
        .when(is_("logicalReduce"), given("dimNames"))
        .otherwise(given("name"))
    )
    columns = {
        "kind": kind,
        "node_path": F.when(is_("aggregation") | F.col("outer").isNull(), F.col("path")).when(inner, F.col("holder")).otherwise(F.col("outer")),
        "ordinal": F.when(is_("values"), 0).otherwise(F.col("ordinal")),
        "name": name,
        "type": type_,
        "value": value,
        "org_name": given("orgName"),
        "location": given("location"),
        "ncoords": given("ncoords").try_cast("bigint"),
        "coord_value": given("coordValue"),
        "suffix": given("suffix"),
        "regexp": given("regExp"),
        "subdirs": yes("subdirs"),
        "recheck": given("recheckEvery"),
        "time_units_change": yes("timeUnitsChange"),
        "older_than": given("olderThan"),
        "date_mark": given("dateFormatMark"),
        "section": given("section"),
        "options": F.col("given"),
    }
    types = dict(f.strip().split(" ", 1) for f in FACT.replace("map<string,string>", "map").split(","))
    return rows.select(key, *[c.cast("map<string,string>" if types[n] == "map" else types[n]).alias(n) for n, c in columns.items()])


def key_values(docs: DataFrame, key: str, xml: str = "xml", doc: str = "doc_id") -> DataFrame:
    """Every value of one attribute (``@name``) or element at any depth, in document order."""
    path = f"//{key}" if key.startswith("@") else f"//{key}/text()"
    return docs.select(doc, F.posexplode(F.xpath(F.col(xml), F.lit(path))).alias("pos", "value"))


class _Keeping(ElementTree.TreeBuilder):
    """A builder that keeps the prefixes of name spaces for writing."""

    def start_ns(self, prefix: str, uri: str) -> None:
        if not re.fullmatch(r"ns\d+", prefix or ""):
            ElementTree.register_namespace(prefix or "", uri)


def _edited(docs: DataFrame, change: Callable[[ElementTree.Element, str | None], None], value: Column | None, xml: str) -> DataFrame:
    """``docs`` with ``change`` applied to the outermost element of every text; comments stay."""

    def text(xml: str | None, value: str | None) -> str | None:
        if xml is None:
            return None
        # a builder of its own costs as much again, and only texts with name spaces need it
        builder = _Keeping if "xmlns" in xml else ElementTree.TreeBuilder
        root = ElementTree.fromstring(xml.encode(), ElementTree.XMLParser(target=builder(insert_comments=True, insert_pis=True)))
        change(root, value)
        return ElementTree.tostring(root, encoding="unicode")

    @F.pandas_udf("string")
    def run(xml: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series([text(x, v) for x, v in zip(xml, value, strict=True)], dtype=object)

    # a filter on the text would otherwise be pushed below the edit, which is then done twice
    run = run.asNondeterministic()
    return docs.withColumn(xml, run(xml, F.lit(None).cast("string") if value is None else value.cast("string")))


def _named(root: ElementTree.Element, element: str, **given: str) -> list[ElementTree.Element]:
    """Children of one kind with these XML attributes, whatever their name space."""
    kind = lambda e: isinstance(e.tag, str) and e.tag.rpartition("}")[2] == element
    return [e for e in root if kind(e) and all(e.get(k) == v for k, v in given.items())]


def _add(root: ElementTree.Element, element: str, given: dict[str, str | None]) -> ElementTree.Element:
    """A new child in the name space of its parent, after its siblings of the same kind."""
    space = root.tag.rpartition("}")
    child = ElementTree.Element(f"{space[0]}{space[1]}{element}", {k: v for k, v in given.items() if v is not None})
    last = [i for i, e in enumerate(root) if e in _named(root, element)]
    root.insert(last[-1] + 1 if last else 0, child)
    return child


def _set(node: ElementTree.Element, name: str, value: str | None, type_: str) -> None:
    for e in _named(node, "attribute", name=name):
        node.remove(e)
    _add(node, "attribute", {"name": name, "type": type_, "value": value})


def add_attribute(docs: DataFrame, name: str, value: Column, type_: str = "String", xml: str = "xml") -> DataFrame:
    """Set a dataset attribute of every document, in the document itself."""
    return _edited(docs, lambda root, v: _set(root, name, v, type_), value, xml)


def add_removal(docs: DataFrame, name: str, type_: str, xml: str = "xml") -> DataFrame:
    """List one more removal in every document that does not have it."""

    def change(root, _):
        if not _named(root, "remove", name=name, type=type_):
            _add(root, "remove", {"name": name, "type": type_})

    return _edited(docs, change, None, xml)


def rename_variable(docs: DataFrame, old: str, new: str, xml: str = "xml") -> DataFrame:
    """Rename a variable in every document; its first name stays as ``orgName``.

    An element with the old name takes the new one; where there is none, an element is added.
    """

    def change(root, _):
        held = _named(root, "variable", name=old)
        for e in held:
            e.set("orgName", e.get("orgName", old))
            e.set("name", new)
        if not held:
            _add(root, "variable", {"name": new, "orgName": old})

    return _edited(docs, change, None, xml)


def set_variable_attribute(docs: DataFrame, variable: str, name: str, value: Column, type_: str = "String", xml: str = "xml") -> DataFrame:
    """Set an attribute of a variable in every document; an element is added where the variable has none."""

    def change(root, v):
        for e in _named(root, "variable", name=variable) or [_add(root, "variable", {"name": variable})]:
            _set(e, name, v, type_)

    return _edited(docs, change, value, xml)


def resolve(
    found: DataFrame, inventory: DataFrame, key: str = "doc_id", as_of: Column | None = None, given: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """The files behind every descriptor: (key, node_path, ordinal, path, kind of the fact that names it).

    Listed locations are files themselves. A scan meets a file when its
    location is one of the file's directories, so paths are spread over those of their
    directories that are as deep as a location and the match is an equality. A scan that takes files of a minimum age needs the inventory's
    ``mtime`` and the time ``as_of`` which their age is counted.

    ``given`` are columns of the facts and ``keep`` columns of the inventory that go with each file, so that
    files need not be looked up again by their paths. With ``keep``, listed locations are those that the inventory has, and scans,
    which must be few then, are sent to the files: these are not moved.
    """
    said, held_of = F.struct(F.lit(0).alias("_"), *given).alias("_given"), F.struct(F.lit(0).alias("_"), *keep).alias("_kept")
    bare = lambda c: F.when(c == "/", c).otherwise(F.regexp_replace(c, "/+$", ""))
    listed = found.where((F.col("kind") == "member") & F.col("location").isNotNull()).select(
        key, "node_path", "ordinal", F.col("location").alias("path"), "kind", said
    )
    if keep:
        listed = listed.join(inventory.select("path", held_of), "path")
    scans = found.where(F.col("kind").isin("scan", "scan_fmrc")).select(
        key, "node_path", "ordinal", "kind", bare(F.col("location")).alias("location"), "suffix", "regexp",
        F.coalesce("subdirs", F.lit(True)).alias("subdirs"), marks.seconds(F.col("older_than")).alias("_age"), said,
    )
    # locations are at a few depths, of which most directories of a file are none; two slashes at the start are the root twice
    levels = F.when(F.col("location") == "/", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.size(F.split("location", "/"))))
    depths = scans.where(F.col("location").isNotNull()).select(F.explode(levels).alias("_at")).distinct()
    # a file without a directory is in the empty one
    slashes = F.length("path") - F.length(F.replace("path", F.lit("/")))
    inner = F.when(slashes == 0, "").otherwise(F.call_function("substring_index", F.col("path"), F.lit("/"), F.col("_at")))
    # the first part of an absolute path is empty: its directory is the root
    place = F.when(F.startswith("path", F.lit("/")) & (inner == ""), "/").otherwise(inner)
    time = F.col("mtime").cast("timestamp_ntz") if "mtime" in inventory.columns else F.lit(None).cast("timestamp_ntz")
    held = inventory.select("path", time.alias("_time"), F.greatest(slashes, F.lit(1)).alias("_depth"), held_of)
    spread = held.join(F.broadcast(depths), F.col("_at") <= F.col("_depth")).select("path", "_time", "_depth", "_at", place.alias("location"), "_kept")
    hit = (F.broadcast(scans) if keep else scans).join(spread, "location").where(F.col("subdirs") | (F.col("_at") == F.col("_depth")))
    ending = names.glob_to_regex_column(F.concat(F.lit("*"), F.ltrim(F.coalesce("suffix", F.lit("")), F.lit("*"))))
    suffix_is = F.rlike("path", ending)
    regexp_is = F.col("regexp").isNull() | F.rlike("path", F.concat(F.lit("^(?:"), F.coalesce("regexp", F.lit("")), F.lit(")$")))
    unknown = F.raise_error(F.lit("a scan takes files of a minimum age: give the time as of which it is counted")).cast("boolean")
    aged = unknown if as_of is None else F.col("_time") <= as_of - F.make_dt_interval(secs=F.col("_age").cast("decimal(18,6)"))
    old_enough = F.when(F.col("_age").isNull(), True).otherwise(aged)
    columns = [key, "node_path", "ordinal", "path", "kind", *[f"_given.{c}" for c in given], *[f"_kept.{c}" for c in keep]]
    return listed.select(*columns).unionByName(hit.where(suffix_is & regexp_is & old_enough).select(*columns))
