"""From descriptor documents to virtual datasets: facts become a tree, and a tree becomes one plan.

The driver holds a document's structure: its aggregations, edits, labelled or
nested members. Plain members (files that a scan meets or a list names) stay in
tables, however many there are; all of one aggregation are one leaf, which is read as a
whole. A location that is a document itself is compiled in its place.

What is where:

* ``joinExisting`` concatenates; ``union`` takes each variable from the first
  member that has it; ``joinNew`` stacks along a new dimension, labelled by
  ``coordValue``, or for scanned files by the date that a ``dateFormatMark``
  finds in their names, else by the names; ``tiled`` places members by their
  ``section``, its dimensions become indices; forecast collections get the run and
  the valid time from the names of the files.
* Removals, renames and attributes inside an aggregation apply to each member.
* On a dataset: renames first, then removals of what still has that name, then
  ``values``, logical sections, slices and reductions, then ``explicit``.
* ``timeUnitsChange``, ``recheckEvery``, ``cacheVariable`` and ``ncoords`` do
  not change rows: stores give decoded times and are read when asked.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cubeweave.functions import marks, names, ordering
from cubeweave.operators import edit, virtual
from cubeweave.plans.dataset import VirtualDataset
from cubeweave.runtime import new_dir, released, settings
from cubeweave.sources import descriptors

#: Column types of the types of values in a document.
_TYPES = {"double": "double", "float": "float", "int": "int", "long": "bigint", "short": "smallint", "byte": "tinyint", "string": "string"}


#: What one task reads of tables, as Parquet has it.
READ_BYTES = "16m"


@dataclass(frozen=True)
class Store:
    """Where the files below a directory are.

    files: one row for each file and variable: path, variable and what ``read`` needs, and no more, as it is kept for each
    document that has the file; ``first`` and ``last`` (ISO dates) and ``mtime`` if they are known. ``read(files, keep, variables)``
    gives the stored values of some files: the coordinates, the columns
    ``keep`` of ``files``, variable and value. Values at one place are added up. ``files`` may
    have a file several times, with different values in ``keep``.
    """

    root: str
    files: DataFrame
    read: Callable[[DataFrame, list[str], list[str]], DataFrame]
    coords: tuple[str, ...]


@dataclass(frozen=True)
class _Leaf:
    """The plain files of one aggregation: the coordinates of their store, and names of others with the columns of ``files`` that have them."""

    store: int
    base: tuple[str, ...]
    extra: dict[str, str]
    files: DataFrame
    variables: tuple[str, ...]


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Rows as a table in the shared folder. What their making moved is gone when they are written.

    They are made of a few megabytes of tables to a task: a task that sorts what it reads, or moves it, needs disk besides if that is more than its memory.
    """
    path = new_dir(df.sparkSession, purpose)
    with released(df.sparkSession), settings(df.sparkSession, {"spark.sql.files.maxPartitionBytes": READ_BYTES}):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Compiler:
    """Documents (path, xml) over stores. Documents are parsed and resolved once, for all datasets that are asked for."""

    def __init__(self, documents: DataFrame, stores: list[Store], as_of: Column | None = None) -> None:
        self.stores = sorted(stores, key=lambda s: -len(s.root))
        docs = documents.select(F.col("path").alias("doc"), "xml")
        found = descriptors.facts(docs, "doc")
        # locations are relative to the document that names them
        here = F.when(F.col("location").isNotNull(), names.absolute("location", names.parent("doc")))
        self.found = saved(found.withColumn("location", here), "facts")
        self.documents = {r.doc for r in self.found.where("kind = 'dataset'").select("doc").collect()}
        located = self._located_facts()
        self.facts = self._structure()
        # what the stores know of these files is looked up once for all datasets
        self.stored = [self._files_of(s, located, as_of) for s in self.stores]
        names_ = self.found.where("kind = 'dataset'").select(F.col("doc").alias("path")).distinct()
        self.inner = descriptors.resolve(located, names_, "doc", as_of, given=["special"]).join(names_, "path")
        self.held = self._summary()
        self.built: dict[str, VirtualDataset] = {}
        self.leaves: list[_Leaf] = []
        self.cells: dict[int, DataFrame] = {}

    def _located_facts(self) -> DataFrame:
        """Facts with ``special``: whether a member has something inside or a label, so that it is not one of many."""
        inside = F.when(F.col("kind") == "aggregation", F.regexp_replace("node_path", r"/aggregation\[\d+\]$", "")).otherwise(F.col("node_path"))
        nested = self.found.where(F.col("kind") != "dataset").select("doc", inside.alias("_path")).distinct().withColumn("_nested", F.lit(True))
        member = self.found.where("kind = 'member'").select("doc", "node_path", "ordinal", "kind", "section", "coord_value")
        member = member.withColumn("_path", F.concat("node_path", F.lit("/netcdf["), F.col("ordinal").cast("string"), F.lit("]")))
        member = member.join(nested, ["doc", "_path"], "left")
        self.members = saved(member.withColumn("special", F.col("_nested").isNotNull() | F.col("coord_value").isNotNull()).drop("_nested", "_path"), "members")
        known = self.members.select("doc", "node_path", "ordinal", "kind", "section", "special")
        # the location of a whole document is its only member
        located = self.found.drop("section").withColumn("kind", F.when(F.col("kind") == "dataset", "member").otherwise(F.col("kind")))
        located = located.where(F.col("kind").isin("member", "scan", "scan_fmrc")).join(known, ["doc", "node_path", "ordinal", "kind"], "left")
        return saved(located.withColumn("special", F.coalesce("special", F.lit(False))), "located")

    def _files_of(self, store: Store, located: DataFrame, as_of: Column | None) -> DataFrame:
        """doc, node_path, ordinal, kind, section, special and the store's columns of every file of every document. Nothing moves; those of an aggregation lie together."""
        keep = [c for c in store.files.columns if c != "path"]
        files = descriptors.resolve(located, store.files, "doc", as_of, given=["section", "special"], keep=keep)
        return saved(files.sortWithinPartitions("doc", "node_path"), "stored")

    def _structure(self) -> dict[tuple[str, str], list[Row]]:
        """Facts by document and path, without plain members."""
        plain = self.members.where(~F.col("special")).select("doc", "node_path", "ordinal", "kind")
        facts: dict[tuple[str, str], list[Row]] = defaultdict(list)
        for f in self.found.join(plain, ["doc", "node_path", "ordinal", "kind"], "left_anti").collect():
            facts[f.doc, f.node_path].append(f)
        for rows in facts.values():
            rows.sort(key=lambda f: f.ordinal)
        return facts

    def _summary(self) -> dict[tuple, list[Row]]:
        """What the files of each aggregation hold: one row for each store and special member, and each document among them."""
        text = lambda df, c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
        which = F.when(F.col("special"), F.col("ordinal"))
        held = []
        for i, s in enumerate(self.stores):
            known = self.stored[i].withColumns({"first": text(s.files, "first"), "last": text(s.files, "last")})
            of = known.groupBy("doc", "node_path", "kind", which.alias("member")).agg(
                F.array_sort(F.collect_set("variable")).alias("variables"), F.min("first").alias("first"), F.max("last").alias("last"),
                (F.min("ordinal") != F.max("ordinal")).alias("several"), F.min("ordinal").alias("ordinal"),
            )
            held.append(of.withColumns({"store": F.lit(i), "document": F.lit(None).cast("string")}))
        inner = self.inner.select(
            "doc", "node_path", "kind", which.alias("member"), F.array().cast("array<string>").alias("variables"), F.lit(None).cast("string").alias("first"),
            F.lit(None).cast("string").alias("last"), F.lit(False).alias("several"), "ordinal", F.lit(-1).alias("store"), F.col("path").alias("document"),
        )
        found: dict[tuple, list[Row]] = defaultdict(list)
        for r in reduce(DataFrame.unionByName, [*held, inner]).collect():
            found[r.doc, r.node_path, r.member].append(r)
        for rows in found.values():
            rows.sort(key=lambda r: (r.kind != "member", r.ordinal, r.document or ""))
        return found

    def dataset(self, path: str) -> VirtualDataset:
        """The dataset that the document at ``path`` describes."""
        return self._document(path, ())

    def _document(self, path: str, above: tuple[str, ...]) -> VirtualDataset:
        if path in above:
            raise ValueError(f"documents that contain each other: {' -> '.join([*above, path])}")
        if path not in self.documents:
            raise ValueError(f"no document {path}")
        if path not in self.built:
            (own,) = [f for f in self.facts[path, "/netcdf"] if f.kind == "dataset"]
            located = self.held.get((path, "/netcdf", None), []) if own.location else []
            self.built[path] = self._netcdf(path, "/netcdf", located, (*above, path))
        return self.built[path]

    def _netcdf(self, doc: str, at: str, located: list[Row], above: tuple[str, ...]) -> VirtualDataset:
        facts = self.facts[doc, at]
        inner = [p for d, p in self.facts if d == doc and p.startswith(f"{at}/aggregation[") and "/" not in p.removeprefix(f"{at}/")]
        parts = [self._aggregation(doc, p, above) for p in sorted(inner, key=lambda p: int(p.rpartition("[")[2][:-1]))]
        parts += [self._located(doc, at, r, above) for r in located]
        if not parts:
            raise ValueError(f"nothing to read at {at} of {doc}")
        return self._edit(doc, at, facts, parts[0] if len(parts) == 1 else VirtualDataset.merge(parts))

    def _located(self, doc: str, at: str, row: Row, above: tuple[str, ...]) -> VirtualDataset:
        """A document or the files of one member or pool, as ``_summary`` has them."""
        return self._document(row.document, above) if row.document else self._leaf(row)

    def _rows_of(self, row: Row) -> DataFrame:
        mine = (F.col("doc") == row.doc) & (F.col("node_path") == row.node_path) & (F.col("kind") == row.kind)
        mine &= ~F.col("special") if row.member is None else F.col("special") & (F.col("ordinal") == row.member)
        return self.stored[row.store].where(mine).select("path", "ordinal", "section", *[c for c in self.stores[row.store].files.columns if c != "path"])

    def _leaf(self, row: Row, extra: dict[str, Column] | None = None, first: bool = False, without: tuple[str, ...] = ()) -> VirtualDataset:
        """Plain files as one table. ``extra``: coordinates from the files' columns; ``first``: one member for each variable."""
        store, extra = self.stores[row.store], extra or {}
        base = [c for c in store.coords if c not in extra and c not in without]
        files = self._rows_of(row)
        if first:
            earliest = files.groupBy("variable").agg(F.min(F.struct("ordinal", "path")).alias("_first"))
            files = files.join(earliest, "variable").where((F.col("path") == F.col("_first.path")) & (F.col("ordinal") == F.col("_first.ordinal"))).drop("_first")
        # names of their own, by type: those of a store's columns stay, and leaves that are read together share them
        types = files.select(*[c.alias(n) for n, c in extra.items()]).schema
        made = {n: f"_{n}_{types[n].dataType.typeName()}" for n in extra}
        files = files.withColumns({made[n]: c for n, c in extra.items()}).drop("ordinal", "section")
        # a file is met once by one scan, unless two slashes at the start of its path are the root twice
        rooted = any(f.kind in ("scan", "scan_fmrc") and f.location == "/" for f in self.facts.get((row.doc, row.node_path), []))
        if row.several or rooted:
            files = files.distinct()
        leaf = _Leaf(row.store, tuple(base), made, files, tuple(row.variables))
        self.leaves.append(leaf)
        number = len(self.leaves) - 1

        def read(wanted: tuple[str, ...]) -> DataFrame:
            chosen, key = list(wanted) or list(row.variables), [*base, *made.values()]
            if number in self.cells:
                cells = self.cells[number].where((F.col("_leaf") == number) & F.col("variable").isin(*chosen))
                # a place has one cell for each variable
                found = cells.select(*key, F.col("value").alias(chosen[0])) if len(chosen) == 1 else virtual.merge_cells(cells, key, chosen)
            else:
                rows = store.read(files.where(F.col("variable").isin(*chosen)), list(made.values()), chosen)
                found = virtual.merge_records(rows, key, chosen)
            return found.select(*base, *[F.col(c).alias(n) for n, c in made.items()], *wanted)

        period = (row.first, row.last) if row.first and row.last and "time" in store.coords else None
        return VirtualDataset.files(read, [*base, *extra], row.variables, period)

    def gather(self) -> None:
        """Read the plain files of all datasets that were asked for so far, once for all of them: afterwards these start from cells.

        The rows of a store move once, to be joined with the files of all leaves, and lie by leaf then. Some leaves at a time, with no more rows
        than the largest one has, they are added up at their places: what moves at one time does not grow with the number of
        datasets. A leaf that is alone gains nothing and is read when asked.
        """
        together: dict[tuple, list[int]] = defaultdict(list)
        for i, leaf in enumerate(self.leaves):
            if i not in self.cells:
                together[leaf.store, leaf.base].append(i)
        for (store, base), numbers in together.items():
            if len(numbers) == 1:
                continue
            leaves = [self.leaves[i] for i in numbers]
            files = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [leaf.files.withColumn("_leaf", F.lit(i)) for i, leaf in zip(numbers, leaves)])
            keep = ["_leaf", *sorted({c for leaf in leaves for c in leaf.extra.values()})]
            rows = self.stores[store].read(files, keep, sorted({v for leaf in leaves for v in leaf.variables}))
            rows = saved(rows.select(*keep, *base, "variable", "value").sortWithinPartitions("_leaf"), "rows")
            sizes = {r["_leaf"]: r["n"] for r in rows.groupBy("_leaf").agg(F.count("*").alias("n")).collect()}
            for some in _batches(numbers, sizes):
                cells = rows.where(F.col("_leaf").isin(*some)).groupBy(*keep, *base, "variable").agg(F.sum("value").alias("value"))
                cells = saved(cells.sortWithinPartitions("_leaf", "variable", *base), "cells")
                self.cells.update(dict.fromkeys(some, cells))

    def _members(self, doc: str, at: str, above: tuple[str, ...], leaf: Callable[[Row], VirtualDataset]) -> list[tuple[VirtualDataset, Row | None]]:
        """The members of an aggregation in order: nested or labelled ones with their fact, documents, and plain files together."""
        facts = self.facts[doc, at]
        shared = [f for f in facts if f.kind in ("remove", "variable", "attribute", "dimension")]
        found = []
        for row in self.held.get((doc, at, None), []):
            place = (row.kind != "member", row.ordinal, row.document or "")
            found.append((place, self._document(row.document, above) if row.document else leaf(row), None))
        for f in facts:
            if f.kind == "member":
                located = self.held.get((doc, at, f.ordinal), [])
                member = self._netcdf(doc, f"{at}/netcdf[{f.ordinal}]", located, above)
                found.append(((False, f.ordinal, ""), member, f))
        return [(self._edit(doc, at, shared, m), f) for _, m, f in sorted(found, key=lambda x: x[0])]

    def _aggregation(self, doc: str, at: str, above: tuple[str, ...]) -> VirtualDataset:
        facts = self.facts[doc, at]
        (own,) = [f for f in facts if f.kind == "aggregation"]
        listed = [f.name for f in facts if f.kind == "variable_agg"]
        scans = [f for f in facts if f.kind == "scan"]
        forecast = [f for f in facts if f.kind == "scan_fmrc"]
        leaf: Callable[[Row], VirtualDataset] = self._leaf
        if own.type == "union":
            leaf = lambda row: self._leaf(row, first=True)
        elif own.type == "joinnew":
            date = next((f.date_mark for f in scans if f.date_mark), None)
            label = marks.date("path", date) if date else names.file_name("path")
            leaf = lambda row: self._leaf(row, {own.name: label})
        elif own.type == "tiled":
            leaf = lambda row: self._leaf(row, {"_tile": F.col("path"), "section": F.col("section")})
        elif own.type in ("forecastmodelrunsinglecollection", "forecastmodelruncollection") and forecast:
            leaf = lambda row: self._leaf(row, _forecast_times(forecast[0]), without=("time",))
        members = self._members(doc, at, above, leaf)
        if not members:
            raise ValueError(f"no member at {at} of {doc}")
        for f in facts:
            if f.kind == "promote":
                members = [(_with_column(m, f.name, m.attributes.get(f.org_name or f.name)), fact) for m, fact in members]
        sets = [m for m, _ in members]
        if own.type == "union":
            return sets[0] if len(sets) == 1 else VirtualDataset.merge(sets)
        if own.type == "joinexisting" or own.type.startswith("forecast") and forecast:
            return sets[0] if len(sets) == 1 else VirtualDataset.concat(sets, own.name or "time")
        if own.type == "joinnew" or own.type.startswith("forecast"):
            dim = own.name or "run"
            labelled = {f.coord_value: m for m, f in members if f is not None and f.coord_value is not None}
            pools = [_only(m, listed) for m, f in members if f is None]
            if len(labelled) + len(pools) < len(members) or any(dim not in p.coords for p in pools):
                raise ValueError(f"a member without a label at {at} of {doc}")
            stacked = [VirtualDataset.stack(labelled, dim, listed)] if labelled else []
            return pools[0] if pools and not stacked and len(pools) == 1 else VirtualDataset.concat([*stacked, *pools], dim) if pools else stacked[0]
        if own.type == "tiled":
            dims = (own.name or "").split()
            tiles = [_tile(m, dims, f.section if f is not None else None, doc) for m, f in members]
            return tiles[0] if len(tiles) == 1 else VirtualDataset.concat(tiles, dims[0])
        raise ValueError(f"unknown aggregation {own.type} at {at} of {doc}")

    def _edit(self, doc: str, at: str, facts: list[Row], base: VirtualDataset) -> VirtualDataset:
        """What a netcdf element changes in the dataset inside it."""
        declared = [f for f in facts if f.kind == "variable"]
        old = {f.name: f.org_name for f in declared if f.org_name in base.variables}
        dims = {f.org_name: f.name for f in facts if f.kind in ("dimension", "variable") and f.org_name in base.coords and f.org_name != f.name}
        if old or dims:
            renamed = {v: n for n, v in old.items()}
            kept = {renamed.get(v, v): v for v in base.variables}
            both = {**dims, **{v: n for v, n in renamed.items()}}
            base = base.then(lambda df, both=both: _renamed(df, both), [dims.get(c, c) for c in base.coords], kept, pruned="time" not in dims)
        gone = {f.name for f in facts if f.kind == "remove" and f.type in ("variable", "dimension")}
        if gone & set(base.variables):
            base = _only(base, [v for v in base.variables if v not in gone])
        for f in facts:
            if f.kind == "values":
                base = _valued(base, f, next(v for v in declared if v.name == f.name), doc)
        base = self._logical(doc, at, declared, base)
        given = {f.name: f for f in facts if f.kind == "attribute"}
        attributes = dict(base.attributes)
        for f in facts:
            if f.kind == "remove" and f.type == "attribute":
                attributes.pop(f.name, None)
        for name, f in given.items():
            if f.value is None and f.org_name in attributes:
                attributes[name] = attributes.pop(f.org_name)
            elif f.value is not None:
                attributes[name] = f.value
        if any(f.kind == "metadata" and f.name == "explicit" for f in facts):
            base = _only(base, [v for v in base.variables if v in {f.name for f in declared}])
        return replace(base, attributes=attributes)

    def _logical(self, doc: str, at: str, declared: list[Row], base: VirtualDataset) -> VirtualDataset:
        """Sections, slices and reductions, which every variable of the dataset must have alike: its rows are those of all."""
        views = {}
        for v in declared:
            inside = [f for f in self.facts.get((doc, f"{at}/variable[{v.ordinal}]"), []) if f.kind.startswith("logical")]
            if inside:
                shape = (v.options.get("shape") or " ".join(base.coords)).split()
                views[v.name] = [(f.kind, tuple(shape) if f.kind == "logical_section" else (), tuple(sorted(f.options.items()))) for f in inside]
        if not views:
            return base
        if set(views) != set(base.variables) or any(v != views[base.variables[0]] for v in views.values()):
            raise ValueError(f"variables at {at} of {doc} have different logical views; give each a dataset of its own")
        for kind, shape, options in views[base.variables[0]]:
            o = dict(options)
            if kind == "logical_section":
                spans = [tuple(int(x) for x in (p.split(":") * 2)[:2]) for p in o["section"].split(",")]
                base = base.then(lambda df, r=dict(zip(shape, spans, strict=True)): edit.cut(df, df, r), pruned=False)
            elif kind == "logical_slice":
                d, i = o["dimName"], int(o["index"])
                base = base.then(lambda df, d=d, i=i: edit.cut(df, df, {d: (i, i)}).drop(d), [c for c in base.coords if c != d], pruned=False)
            else:
                gone = o["dimNames"].replace(",", " ").split()
                base = base.then(lambda df, g=gone: edit.drop_single(df, g), [c for c in base.coords if c not in gone], pruned=False)
        return base


def _batches(numbers: list[int], sizes: dict[int, int]) -> list[list[int]]:
    """Leaves in batches that have no more rows than the largest leaf."""
    batches: list[list[int]] = []
    for i in numbers:
        if batches and sum(sizes.get(j, 0) for j in [*batches[-1], i]) <= max(sizes.values(), default=0):
            batches[-1].append(i)
        else:
            batches.append([i])
    return batches


def _renamed(df: DataFrame, names_: dict[str, str]) -> DataFrame:
    return reduce(lambda d, p: edit.rename_variable(d, *p), [(o, n) for o, n in names_.items() if o in df.columns], df)


def _only(base: VirtualDataset, variables: list[str]) -> VirtualDataset:
    kept = [v for v in base.variables if v in variables]
    return base if kept == list(base.variables) else base.then(lambda df: df, names={v: v for v in kept})


def _with_column(base: VirtualDataset, name: str, value: str | None) -> VirtualDataset:
    """A dataset with an attribute of its own as a variable."""
    kept = {v: v for v in base.variables if v != name}
    return base.then(lambda df: df.withColumn(name, F.lit(value).cast("string")), names={**kept, name: None})


def _valued(base: VirtualDataset, values: Row, variable: Row, doc: str) -> VirtualDataset:
    """A variable along one dimension from generated or listed values."""
    shape = (variable.options.get("shape") or variable.name).split()
    if len(shape) != 1 or shape[0] not in base.coords:
        raise ValueError(f"values of {variable.name} in {doc} need one dimension of the dataset")
    kind = _TYPES[(variable.type or "double").lower()]
    o = values.options
    if "npts" in o:
        at = F.lit(float(o.get("start", 0))) + F.col("index") * F.lit(float(o.get("increment", 1)))
        value = F.when(F.col("index") < int(o["npts"]), at)
    else:
        texts = (values.value or "").split(o.get("separator"))
        value = F.try_element_at(F.array(*[F.lit(t.strip()) for t in texts]), (F.col("index") + 1).cast("int"))
    step = lambda df: edit.along(df, shape[0], variable.name, value.cast(kind))
    if variable.name in base.coords:
        return base.then(step, pruned=False)
    return base.then(step, names={**{v: v for v in base.variables if v != variable.name}, variable.name: None}, pruned=False)


def _forecast_times(scan: Row) -> dict[str, Column]:
    """Run and valid time of a forecast file, from its name."""
    o = scan.options
    run = marks.date("path", o["runDateMatcher"])
    if "forecastDateMatcher" in o:
        return {"run": run, "time": marks.date("path", o["forecastDateMatcher"])}
    return {"run": run, "time": run + F.make_dt_interval(hours=marks.hours("path", o["forecastOffsetMatcher"]))}


def _tile(base: VirtualDataset, dims: list[str], section: str | None, doc: str) -> VirtualDataset:
    """A member, or many (``_tile``), with indices in the whole along ``dims`` instead of coordinates; cells outside the section go."""
    if section is None and "section" not in base.coords:
        raise ValueError(f"a tile without a section in {doc}")
    coords = [c for c in base.coords if c not in ("_tile", "section")]

    def step(df: DataFrame) -> DataFrame:
        if section is not None:
            df = df.withColumns({"_tile": F.lit(""), "section": F.lit(section)})
        for d in dims:
            axis = df.select("_tile", F.col(d).alias("_at"), edit.coarse(df, d).alias("_coarse")).distinct()
            axis = ordering.position(axis, ["_tile"], "_coarse", ["_at"], "_index").select(F.col("_tile").alias("_of"), "_at", "_index")
            df = df.join(axis, (F.col("_tile") == F.col("_of")) & (F.col(d) == F.col("_at"))).withColumn(d, F.col("_index")).drop("_of", "_at", "_index")
        return virtual.place_tiles(df, "section", dims).where("inside").drop("inside", "_tile", "section")

    return base.then(step, coords, pruned=False)
