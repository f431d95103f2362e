"""What keeps time, disk and memory in proportion to the input."""

import os
import re
import time
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

import cubeweave.suite  # noqa: F401  (registers every query)
from cubeweave.operators import catalog, select
from cubeweave.plans import compiler
from cubeweave.registry import QUERIES
from cubeweave.sources import descriptors, inventory, markup, substrate
from cubeweave.streaming import arrivals
from cubeweave.suite import documents


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_labels_are_sent_to_the_files(spark, tmp_path):
    # the files are small for the planner, their exploded rows are not
    spark.createDataFrame([(f"/d/M{i}/r1/x.nc",) for i in range(50)], "path string").write.parquet(str(tmp_path / "files"))
    labels = spark.range(20_000_000).select(F.concat(F.lit("M"), F.col("id").cast("string"), F.lit(":r1")).alias("realization")).where("id < 3").distinct()
    found = select.match_labels(spark.read.parquet(str(tmp_path / "files")), labels)
    assert "BuildRight" in plan(found) and "BuildLeft" not in plan(found)
    assert sorted(tuple(r) for r in found.collect()) == [(f"/d/M{i}/r1/x.nc", f"M{i}:r1") for i in range(3)]


def test_a_walk_does_not_follow_every_way(spark):
    # every node of a layer leads to all of the next: 12 ** 12 ways
    rows = [("r", f"0-{b}") for b in range(12)] + [(f"{d}-{a}", f"{d + 1}-{b}") for d in range(11) for a in range(12) for b in range(12)]
    edges = spark.createDataFrame([*rows, ("11-0", "r"), ("11-1", "0-0")], "parent string, child string")
    got = inventory.walk_all(edges, spark.createDataFrame([("r",), ("r",)], "node string")).collect()
    assert sorted((r.root, r.node, r.depth) for r in got) == sorted(("r", f"{d}-{b}", d) for d in range(12) for b in range(12))


def customers(spark, tmp_path, n):
    given = spark.range(n).select(F.col("id").alias("c_custkey"), F.lit("a").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit("b").alias("c_mktsegment"))
    given.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_documents_of_one_row_group_are_made_by_several_tasks(spark, tmp_path):
    sf = customers(spark, tmp_path, 3 * substrate.DOCUMENT_ROWS)
    for docs in (substrate.descriptors, substrate.full_descriptors, substrate.broken_descriptors):
        assert docs(spark, sf).rdd.getNumPartitions() == 3
    assert descriptors.facts(substrate.descriptors(spark, sf)).select("doc_id").distinct().count() == 3 * substrate.DOCUMENT_ROWS


def test_an_edit_is_made_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "<netcdf/>"), (2, None), (3, '<q:netcdf xmlns:q="urn"><!-- c --></q:netcdf>')], "doc_id bigint, xml string")
    edited = descriptors.add_removal(descriptors.add_attribute(docs, "a", F.lit("1")), "h", "variable").where("xml IS NOT NULL").select("doc_id", F.upper("xml").alias("xml"))
    assert plan(edited).count("ArrowEvalPython") == 2
    got = dict(tuple(r) for r in edited.collect())
    assert sorted(got) == [1, 3] and "<!-- C -->" in got[3] and "<Q:ATTRIBUTE" in got[3]


def test_elements_around_an_element(spark):
    xml = "<a>x<!-- c -->y<b k='1' xmlns:q='u' q:z='2'><c/><b/><c>  t </c></b>tail<b/></a>"
    docs = spark.createDataFrame([(1, xml), (2, "<a><b></a>"), (3, None), (4, "<a>" + "<g>" * 3000 + "</g>" * 3000 + "</a>")], "doc_id int, xml string")
    rows = markup.elements(docs).orderBy("doc_id", "place").collect()
    first = [(r.path, r.element, r.ordinal, r.given, r.text, r.outer, r.outer_given, r.holder) for r in rows if r.doc_id == 1]
    b = {"k": "1", "z": "2"}
    assert first == [
        ("/a", "a", 0, {}, "xy", None, None, None),
        ("/a/b[0]", "b", 0, b, None, "/a", {}, None),
        ("/a/b[0]/c[0]", "c", 0, {}, None, "/a/b[0]", b, "/a"),
        ("/a/b[0]/b[0]", "b", 0, {}, None, "/a/b[0]", b, "/a"),
        ("/a/b[0]/c[1]", "c", 1, {}, "t", "/a/b[0]", b, "/a"),
        ("/a/b[1]", "b", 1, {}, None, "/a", {}, None),
    ]
    assert [(r.element, r.given) for r in rows if r.doc_id == 2] == [("unreadable", {})]
    assert sum(r.doc_id == 4 for r in rows) == 3001


def test_attributes_of_one_row_group_are_made_by_several_tasks(spark, tmp_path):
    n = 2 * substrate.ATTRIBUTE_ROWS + 1
    part = spark.range(n).select(F.col("id").alias("p_partkey"), *[F.lit("x").alias(c) for c in ("p_name", "p_brand", "p_type")], F.lit(2).alias("p_size"))
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    attrs = substrate.attrs(spark, str(tmp_path))
    assert attrs.rdd.getNumPartitions() == 3
    wide = catalog.facet_table(attrs, ["title", "realm"])
    assert plan(wide).count("Exchange") == 1  # the dealing of the parts is that of their attributes
    assert wide.where("title = 'x v2' AND realm = 'atmos'").count() == n


def test_files_are_gathered_in_one_exchange_of_bounded_tasks(spark, tmp_path, monkeypatch, sf_dir):
    monkeypatch.setattr(substrate, "FILE_ROWS", 1_000)
    lines = substrate.table(spark, sf_dir, "lineitem")
    files = substrate.crawl(spark, sf_dir)
    assert plan(files).count("Exchange") == 1
    assert files.rdd.getNumPartitions() == -(-lines.count() // 1_000) > 1


class _Handle:
    """A bucket's state and timers, with the number of calls for them."""

    def __init__(self):
        self.state, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.state is not None

    def get(self):
        self.calls += 1
        return self.state

    def update(self, state):
        self.calls, self.state = self.calls + 1, state

    def clear(self):
        self.calls, self.state = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_keys_of_a_bucket_share_calls_for_state():
    handle, memory = _Handle(), arrivals.Memory(10)
    memory.init(handle)

    def batch(watermark, **seen):
        """The rows of a batch, then the timers that are due: what is told of each key."""
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        told = list(memory.handleInputRows((0,), iter([Row(key=k, at=at) for k, ats in seen.items() for at in ats]), now)) if seen else []
        for at in sorted(t for t in handle.timers if t <= watermark):
            told += memory.handleExpiredTimer((0,), now, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
            handle.timers.discard(at)
        return sorted((r.key, r.what, r.at) for r in told)

    many = {f"k{i}": [0] for i in range(1000)}
    assert len(batch(0, **many)) == 1000 and handle.calls <= 5
    assert batch(0, a=[3_000, 5_000], b=[4_000]) == [("a", "new", 5_000), ("b", "new", 4_000)]
    # seen again: kept for longer, and an older sight changes nothing
    assert batch(9_999, k7=[8_000], a=[1_000]) == []
    handle.calls = 0
    assert batch(14_000) == sorted([(k, "expired", 10_000) for k in many if k != "k7"] + [("b", "expired", 14_000)])
    assert handle.calls <= 5 and handle.timers == {15_000}
    # seen in the batch in which its time is up: still known; back after it was gone: new
    assert batch(15_000, a=[16_000], b=[16_000]) == [("b", "new", 16_000)]
    assert batch(30_000) == [("a", "expired", 26_000), ("b", "expired", 26_000), ("k7", "expired", 18_000)]
    assert handle.state is None and not handle.timers


def exchanges(df):
    """The keys by which rows are dealt to tasks, one entry for each time."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"^\W*Exchange hashpartitioning\((.*)\), \w+", text, re.MULTILINE)


def test_lines_are_dealt_by_file_once(spark, sf_dir):
    found = exchanges(QUERIES["promote_attr"](spark, sf_dir))
    # lines, files, and the totals
    assert len(found) == 3 and not any("time" in keys for keys in found)


def test_short_keys_of_files_are_those_of_their_lines(spark, sf_dir):
    files = substrate.with_short_keys(substrate.members(spark, sf_dir)).select(*substrate.SHORT_KEYS).distinct()
    lines = substrate.lines(spark, sf_dir).select(*substrate.SHORT_KEYS).distinct()
    assert files.count() == lines.count() == files.join(lines, substrate.SHORT_KEYS).count()


def test_paths_meet_scans_at_the_depths_of_their_locations(spark):
    paths = ["/a/b/c/x.nc", "/a/x.nc", "/x.nc", "x.nc", "a/x.nc", "//a/x.nc", "/a//b/x.nc", "/a/b/", ""]
    places = ["/", "", "/a", "/a/", "/a/b", "a", "/a/b/c", "/a/", "//a", "/a//b", None]
    fact = "doc_id bigint, kind string, node_path string, ordinal int, location string, suffix string, regexp string, subdirs boolean, older_than string"
    scans = [(2 * i + deep, "scan", "/netcdf", 0, p, None, None, bool(deep), None) for i, p in enumerate(places) for deep in (0, 1)]
    got = descriptors.resolve(spark.createDataFrame(scans, fact), spark.createDataFrame([(p,) for p in paths], "path string"))

    def dirs(path):
        parts = path.split("/")[:-1]
        joined = ["/".join(parts[: n + 1]) for n in range(max(len(parts), 1))]
        return ["/" if path.startswith("/") and p == "" else p for p in joined]

    want = []
    for i, p in enumerate(places):
        bare = None if p is None else p if p == "/" else p.rstrip("/")
        for path in paths:
            hits = [n for n, d in enumerate(dirs(path)) if d == bare]
            want += [(2 * i, path) for n in hits if n == len(dirs(path)) - 1] + [(2 * i + 1, path) for _ in hits]
    assert sorted((r.doc_id, r.path) for r in got.collect()) == sorted(want)
    # a directory for each depth of a location, not an array of all directories for each file
    assert "lambda" not in plan(got) and "Generate inline" not in plan(got) and "posexplode" not in plan(got)


def test_stores_are_looked_up_once_for_all_datasets(spark, sf_dir):
    found = documents.compiler(spark, sf_dir)
    rows = found._rows_of(found.held["/data/docs/parts/tas.ncml", "/netcdf/aggregation[0]", None][0])
    assert rows.count() > 0 and "Join" not in plan(rows)


def test_files_are_compared_by_short_keys(spark, sf_dir):
    # lines are dealt by dataset: their cells stay there, and no path is dealt with them
    found = exchanges(QUERIES["compare_all_files"](spark, sf_dir))
    assert found and not any("lat" in keys for keys in found)


def test_files_of_documents_are_looked_up_once(spark, sf_dir, monkeypatch):
    calls, resolve = [], descriptors.resolve
    monkeypatch.setattr(descriptors, "resolve", lambda *given: calls.append(given) or resolve(*given))
    # lines are joined with files for all their variables at once
    found = QUERIES["descriptor_read"](spark, sf_dir)
    assert len(calls) == 1 and "Generate inline" not in plan(found)


def test_lines_are_read_once_for_all_documents(spark, sf_dir, monkeypatch):
    calls, read = [], substrate.read_records
    monkeypatch.setattr(substrate, "read_records", lambda *given: calls.append(given) or read(*given))
    found = QUERIES["descriptor_compile"](spark, sf_dir)
    assert len(calls) == 1 and "Exchange" not in plan(found)


def test_what_a_written_step_moved_is_gone(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    moved = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before = moved()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    made = compiler.saved(df, "test")
    for _ in range(100):
        if moved() <= before:
            break
        time.sleep(0.1)
    assert moved() <= before and made.count() == 7


def test_leaves_are_added_up_in_batches_no_larger_than_the_largest():
    assert compiler._batches([1, 2, 3, 4, 5], {1: 5, 2: 2, 3: 3, 5: 9}) == [[1, 2], [3, 4], [5]]
    assert compiler._batches([1, 2, 3], {1: 3, 2: 2, 3: 2}) == [[1], [2], [3]]
    assert compiler._batches([1, 2], {}) == [[1, 2]]
