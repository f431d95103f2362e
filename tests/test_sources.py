"""Scans over real files, descriptor documents, sinks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import names
from cubeweave.runtime import new_dir, shared_dir
from cubeweave.sources import descriptors, inventory, sinks, substrate

FILES = [
    "a/tasmin_day_M+1_historical_r1_19500101-19991231.nc",
    "a/tasmin_day_M+1_rcp85_r1_20000101-20991231.nc",
    "a/deep/tasmax_day_M+1_rcp85_r1_20000101-20991231.nc",
    "a/deep/readme.txt",
    "b/pr_day_M2_rcp85_r1_20000101-20991231.nc",
]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("tree")
    for f in FILES:
        path = top / f
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * len(f))
    return str(top)


@pytest.fixture(scope="module")
def listed(spark, root):
    return inventory.list_files(spark, root)


def found(df, root):
    return sorted(os.path.relpath(r.path, root) for r in df.collect())


def test_listing_reads_no_contents(listed, root):
    assert found(listed, root) == sorted(FILES)
    assert "content" not in listed.columns
    assert {r.length for r in listed.collect()} == {len(f) for f in FILES}


@pytest.mark.parametrize(
    "kwargs,want",
    [
        ({"suffix": ".nc"}, [f for f in FILES if f.startswith("a") and f.endswith(".nc")]),
        ({"suffix": "tasmin_*.nc"}, FILES[:2]),
        ({"suffix": ".nc", "subdirs": "False"}, FILES[:2]),
        ({"suffix": ".nc", "subdirs": "True"}, FILES[:3]),
        ({"regexp": r".*M\+1_rcp85.*\.nc$"}, FILES[1:3]),
        ({"regexp": r".*M\+1_rcp85"}, []),
    ],
)
def test_scan(listed, root, kwargs, want):
    assert found(inventory.scan(listed, os.path.join(root, "a"), **kwargs), root) == sorted(want)


def test_scan_takes_files_of_a_minimum_age(spark):
    rows = [("/d/old.nc", dt.datetime(2000, 1, 1)), ("/d/new.nc", dt.datetime(2000, 1, 10))]
    df = spark.createDataFrame(rows, "path string, mtime timestamp_ntz")
    now = F.lit("2000-01-11").cast("timestamp_ntz")
    got = inventory.scan(df, "/d", older_than=F.expr("INTERVAL '2' DAY"), as_of=now).collect()
    assert [r.path for r in got] == ["/d/old.nc"]


@pytest.mark.parametrize("glob", ["*/tas_*.nc", "a+b.nc", "r?i1", "*", "x*", "*.n?"])
@pytest.mark.parametrize("text", ["d/tas_1.nc", "a+b.nc", "aab.nc", "r1i1", "xyz", "q.nc", ""])
def test_glob_matches_like_a_shell(spark, glob, text):
    import fnmatch

    want = fnmatch.fnmatchcase(text, glob)
    df = spark.createDataFrame([(text, glob)], "t string, g string")
    got = df.select(F.col("t").rlike(names.glob_to_regex(glob)), F.rlike("t", names.glob_to_regex_column("g"))).first()
    assert tuple(got) == (want, want)


def test_common_path_is_that_of_the_standard_library(spark):
    groups = {
        "x": ["/a/b/c/1.nc", "/a/b/d/2.nc"],
        "y": ["/a/b/c/1.nc", "/a/b/c/2.nc"],
        "z": ["/a/bb/1.nc", "/a/b/1.nc", "/a/b/c/d/1.nc"],
    }
    rows = [(g, p) for g, ps in groups.items() for p in ps]
    df = spark.createDataFrame(rows, "g string, path string")
    got = {r.g: r.common_path for r in inventory.common_path(df, ["g"]).collect()}
    assert got == {g: os.path.commonpath(ps) for g, ps in groups.items()}
    single = inventory.common_path(df.where("path = '/a/b/d/2.nc'"), ["g"]).first()
    assert single.common_path == "/a/b/d"


def test_prefix_swap_leaves_other_occurrences(spark):
    df = spark.createDataFrame([("/root/x/root/y.nc",), ("/rootless/x.nc",)], "p string")
    got = [r[0] for r in df.select(names.swap_prefix("p", "/root", "/pub")).collect()]
    assert got == ["/pub/x/root/y.nc", "/rootless/x.nc"]


def test_walk_to_any_depth(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "c"), ("c", "d")], "parent string, child string")
    roots = spark.createDataFrame([("r",)], "node string")
    assert {r.node for r in inventory.walk(edges, roots, depth=0).collect()} == {"a"}
    assert {r.node for r in inventory.walk(edges, roots, depth=2).collect()} == {"a", "b", "c"}
    every = inventory.walk(edges, roots, depth=None).collect()
    assert {(r.node, r.depth) for r in every} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


NESTED = """
<netcdf recheckEvery="1 day"><attribute name="title" value="t"/><dimension name="rlat" orgName="lat"/>
 <variable name="tas_1" orgName="tas"><attribute name="units" type="String" value="K"/></variable>
 <aggregation dimName="realization" type="joinNew"><variableAgg name="tas"/>
  <netcdf coordValue="r1"><aggregation type="Union"><netcdf><aggregation dimName="time" type="joinExisting" timeUnitsChange="true">
   <scan location="/d/r1" subdirs="True" suffix="tas_*.nc"/><remove name="time_bnds" type="variable"/></aggregation></netcdf>
   <netcdf location="/d/fx.nc" ncoords="1"/></aggregation></netcdf>
 </aggregation></netcdf>"""


@pytest.fixture(scope="module")
def documents(spark):
    docs = [(1, NESTED), (2, '<netcdf location="/d/latest.nc"/>'), (3, "<netcdf/>")]
    return spark.createDataFrame([(i, x) for i, x in docs], "doc_id int, xml string")


def test_nested_descriptors_flatten(documents):
    facts = descriptors.facts(documents).collect()
    one = [f for f in facts if f.doc_id == 1]
    assert [f.type for f in one if f.kind == "aggregation"] == ["joinnew", "union", "joinexisting"]
    scan = next(f for f in one if f.kind == "scan")
    assert (scan.location, scan.suffix, scan.subdirs) == ("/d/r1", "tas_*.nc", True)
    assert next(f for f in one if f.kind == "aggregation" and f.type == "joinexisting").time_units_change is True
    assert [(f.location, f.ncoords) for f in one if f.kind == "member" and f.location] == [("/d/fx.nc", 1)]
    assert {f.org_name for f in one if f.org_name} == {"lat", "tas"}
    # a type left out means text
    assert {(f.name, f.type) for f in one if f.kind == "attribute"} == {("title", "String"), ("units", "String")}
    assert [f.location for f in facts if f.doc_id == 2 and f.kind == "dataset"] == ["/d/latest.nc"]
    assert [f.kind for f in facts if f.doc_id == 3] == ["dataset"]


def test_descriptors_resolve_to_files(spark, documents):
    paths = ["/d/r1/tas_1.nc", "/d/r1/sub/tas_2.nc", "/d/r1/pr_1.nc", "/d/r2/tas_1.nc", "/d/r1/tas_1.txt"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    got = descriptors.resolve(descriptors.facts(documents), files)
    assert sorted(r.path for r in got.collect()) == ["/d/fx.nc", "/d/r1/sub/tas_2.nc", "/d/r1/tas_1.nc"]


def test_edited_documents_survive_a_round_trip(spark, documents):
    edited = descriptors.add_attribute(documents, "title", F.lit("new"))
    edited = descriptors.add_removal(descriptors.add_removal(edited, "height", "variable"), "height", "variable")
    path = new_dir(spark, "test")
    sinks.write_descriptors(edited, path)
    back = descriptors.facts(sinks.read_descriptors(spark, path, key_type="int")).collect()
    titles = [(f.doc_id, f.value) for f in back if f.kind == "attribute" and f.name == "title"]
    assert sorted(titles) == [(1, "new"), (2, "new"), (3, "new")]
    assert sum(f.kind == "remove" and f.name == "height" for f in back) == 3
    assert sum(f.kind == "aggregation" for f in back) == 3
    assert sinks.modified_name("/x/lncm.ncml") == "/x/lncm_modified.ncml"


def test_key_search_descends_everywhere(documents):
    got = descriptors.key_values(documents.where("doc_id = 1"), "@location").collect()
    assert [r.value for r in got] == ["/d/r1", "/d/fx.nc"]


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert new_dir(spark, "x").startswith(shared_dir(spark))


def test_published_cube_is_read_by_folder(spark, sf_dir):
    path = new_dir(spark, "cube")
    cube = substrate.grid(spark, sf_dir)
    sinks.write_cube(cube, path)
    period, labels = ("1998-03-01", "1999-02-28"), ["M-A:r1"]
    got = sinks.read_cube(spark, path, period, labels)
    want = cube.where("realization = 'M-A:r1' AND time BETWEEN timestamp_ntz'1998-03-01' AND timestamp_ntz'1999-02-28'")
    assert got.count() == want.count() > 0
    assert got.select(cube.columns).exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year#" in filters and "realization#" in filters
    assert "PushedFilters: [IsNotNull(time)" in plan
