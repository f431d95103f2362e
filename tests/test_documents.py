"""Documents compiled to datasets over a small store."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import marks, names
from cubeweave.plans.compiler import Compiler, Store

DAY = dt.datetime(2000, 1, 1)


def at(day):
    return DAY + dt.timedelta(days=day)


@pytest.fixture(scope="module")
def store(spark):
    """Files /d/<variable>_<first day>.nc of two days and three places, value = 100 * day + x, pr ten times that."""
    rows, files = [], []
    for v, times in (("tas", 1), ("pr", 10)):
        for day in (0, 2, 4):
            path = f"/d/{v}_{at(day):%Y%m%d}.nc"
            files.append((path, v, f"{at(day):%Y-%m-%d}", f"{at(day + 1):%Y-%m-%d}", at(day)))
            rows += [(path, at(d), float(x), v, times * (100.0 * d + x)) for d in (day, day + 1) for x in range(3)]
    rows = spark.createDataFrame(rows, "path string, time timestamp_ntz, x double, variable string, value double")
    files = spark.createDataFrame(files, "path string, variable string, first string, last string, mtime timestamp_ntz")
    read = lambda f, keep, variables: rows.where(F.col("variable").isin(*variables)).join(f.select("path", *keep), "path")
    return Store("/d", files, read, ("time", "x"))


def compiled(spark, store, docs, as_of=None):
    df = spark.createDataFrame(list(docs.items()), "path string, xml string")
    return Compiler(df, [store], None if as_of is None else F.lit(as_of).cast("timestamp_ntz"))


def rows(ds, *args, **kwargs):
    return sorted(tuple(r) for r in ds.frame(*args, **kwargs).collect())


JOIN = '<aggregation type="joinExisting" dimName="time">%s</aggregation>'
SCAN = '<scan location="/d" regExp=".*/%s_[^/]*"/>'


def test_scans_lists_and_documents_give_the_same_rows(spark, store):
    listed = "".join(f'<netcdf location="tas_{at(d):%Y%m%d}.nc" ncoords="2"/>' for d in (0, 2, 4))
    c = compiled(spark, store, {
        "/d/list.ncml": f"<netcdf>{JOIN % listed}</netcdf>",
        "/e/scan.ncml": f"<netcdf><attribute name='o' value='inner'/>{JOIN % (SCAN % 'tas')}</netcdf>",
        "/e/outer.ncml": "<netcdf location='scan.ncml'><attribute name='o' value='outer'/></netcdf>",
        "/e/deep/up.ncml": "<netcdf><aggregation type='union'><netcdf location='../scan.ncml'/></aggregation></netcdf>",
    })
    want = sorted((at(d), float(x), 100.0 * d + x) for d in range(6) for x in range(3))
    for path in c.documents:
        assert rows(c.dataset(path)) == want
    assert (c.dataset("/e/scan.ncml").attributes, c.dataset("/e/outer.ncml").attributes) == ({"o": "inner"}, {"o": "outer"})
    assert rows(c.dataset("/e/outer.ncml"), period=("2000-01-02", "2000-01-03")) == [r for r in want if r[0] in (at(1), at(2))]


def test_a_list_of_many_files_is_one_leaf(spark, store):
    listed = "".join(f'<netcdf location="/d/tas_{i}.nc"/>' for i in range(5000)) + '<netcdf location="/d/tas_20000103.nc"/>'
    c = compiled(spark, store, {"/l.ncml": f"<netcdf>{JOIN % listed}</netcdf>"})
    assert sum(len(f) for f in c.facts.values()) == 2
    assert c.dataset("/l.ncml").kind == "leaf" and len(rows(c.dataset("/l.ncml"))) == 6


def test_unions_take_the_first_and_edits_apply_in_order(spark, store):
    docs = {
        "/u.ncml": f"""<netcdf><variable name="warm" orgName="tas"/><remove type="variable" name="tas"/><remove type="variable" name="pr"/>
            <aggregation type="union"><netcdf>{JOIN % (SCAN % 'tas')}</netcdf><netcdf>{JOIN % (SCAN % 'pr')}</netcdf></aggregation></netcdf>""",
        "/first.ncml": "<netcdf><aggregation type='union'><scan location='/d' suffix='.nc'/></aggregation></netcdf>",
        "/explicit.ncml": "<netcdf><explicit/><variable name='pr'/><aggregation type='union'><scan location='/d' suffix='.nc'/></aggregation></netcdf>",
        "/dims.ncml": f"<netcdf><dimension name='place' orgName='x'/>{JOIN % (SCAN % 'tas')}</netcdf>",
    }
    c = compiled(spark, store, docs)
    u = c.dataset("/u.ncml")
    assert u.variables == ("warm",) and u.frame().schema["warm"].metadata["orgName"] == "tas" and len(rows(u)) == 18
    # one file for each variable: the first by name
    assert {r[0] for r in rows(c.dataset("/first.ncml"))} == {at(0), at(1)}
    assert set(c.dataset("/first.ncml").variables) == {"tas", "pr"}
    assert c.dataset("/explicit.ncml").variables == ("pr",)
    assert c.dataset("/dims.ncml").coords == ("time", "place")


def test_stacks_by_label_date_mark_and_name(spark, store):
    agg = "<aggregation type='joinNew' dimName='run'><variableAgg name='tas'/>%s</aggregation>"
    c = compiled(spark, store, {
        "/label.ncml": "<netcdf>" + agg % "<netcdf location='/d/tas_20000101.nc' coordValue='a'/><netcdf location='/d/tas_20000103.nc' coordValue='b'/>" + "</netcdf>",
        "/mark.ncml": "<netcdf>" + agg % "<scan location='/d' regExp='.*/tas_[^/]*' dateFormatMark='tas_#yyyyMMdd'/>" + "</netcdf>",
        "/name.ncml": "<netcdf>" + agg % (SCAN % "tas") + "</netcdf>",
        "/old.ncml": "<netcdf>" + agg % "<scan location='/d' suffix='.nc' regExp='.*/tas_[^/]*' olderThan='36 hours'/>" + "</netcdf>",
    }, as_of="2000-01-05")
    assert {(r.run, r.time) for r in c.dataset("/label.ncml").frame().collect()} == {("a", at(0)), ("a", at(1)), ("b", at(2)), ("b", at(3))}
    assert {r.run for r in c.dataset("/label.ncml").frame(labels=["b"]).collect()} == {"b"}
    assert {(r.run, r.time) for r in c.dataset("/mark.ncml").frame().collect()} == {(at(d - d % 2), at(d)) for d in range(6)}
    assert {r.run for r in c.dataset("/name.ncml").frame().collect()} == {f"tas_2000010{i}.nc" for i in (1, 3, 5)}
    assert {r.run for r in c.dataset("/old.ncml").frame().collect()} == {"tas_20000101.nc", "tas_20000103.nc"}


def test_logical_views_values_and_promoted_attributes(spark, store):
    body = JOIN % (SCAN % "tas")
    c = compiled(spark, store, {
        "/section.ncml": f"<netcdf><variable name='tas' shape='time x'><logicalSection section='1:3,2'/></variable>{body}</netcdf>",
        "/slice.ncml": f"<netcdf><variable name='tas'><logicalSlice dimName='x' index='1'/></variable>{body}</netcdf>",
        "/reduce.ncml": f"<netcdf><variable name='tas' shape='x'><logicalSection section='1:1'/><logicalReduce dimNames='x'/></variable>{body}</netcdf>",
        "/long.ncml": f"<netcdf><variable name='tas'><logicalReduce dimNames='x'/></variable>{body}</netcdf>",
        "/relabel.ncml": f"<netcdf><variable name='x' shape='x' type='int'><values start='10' increment='5' npts='3'/></variable>{body}</netcdf>",
        "/listed.ncml": f"<netcdf><variable name='name' shape='x' type='string'><values>one two</values></variable>{body}</netcdf>",
        "/promote.ncml": "<netcdf><aggregation type='joinExisting' dimName='time'><promoteGlobalAttribute name='src' orgName='o'/>"
        + "".join(f"<netcdf location='/d/tas_2000010{i}.nc'><attribute name='o' value='v{i}'/></netcdf>" for i in (1, 3)) + "</aggregation></netcdf>",
    })
    assert rows(c.dataset("/section.ncml")) == [(at(d), 2.0, 100.0 * d + 2) for d in (1, 2, 3)]
    # an index counts along the whole dimension, whatever period is asked for
    assert rows(c.dataset("/section.ncml"), period=("2000-01-03", "2000-01-03")) == [(at(2), 2.0, 202.0)]
    assert rows(c.dataset("/slice.ncml")) == rows(c.dataset("/reduce.ncml")) == [(at(d), 100.0 * d + 1) for d in range(6)]
    with pytest.raises(Exception, match="more than one value along x"):
        c.dataset("/long.ncml").frame().collect()
    assert {r.x for r in c.dataset("/relabel.ncml").frame().collect()} == {10, 15, 20}
    assert {(r.x, r.name) for r in c.dataset("/listed.ncml").frame().collect()} == {(0.0, "one"), (1.0, "two"), (2.0, None)}
    assert {(r.time, r.src) for r in c.dataset("/promote.ncml").frame().collect()} == {(at(0), "v1"), (at(1), "v1"), (at(2), "v3"), (at(3), "v3")}


def test_tiles_as_files_and_as_aggregations(spark, store):
    tile = lambda d, section, end: f"<netcdf location='/d/tas_{at(d):%Y%m%d}.nc' section='{section}'{end}"
    plain = tile(0, "0:1,0:2", "/>") + tile(2, "2:3,3:4", "/>")
    nested = tile(0, "0:1,0:2", "><remove type='variable' name='q'/></netcdf>") + tile(2, "2:3,3:4", "><remove type='variable' name='q'/></netcdf>")
    agg = "<netcdf><aggregation type='tiled' dimName='time x'>%s</aggregation></netcdf>"
    c = compiled(spark, store, {"/plain.ncml": agg % plain, "/nested.ncml": agg % nested})
    # the third column of the second tile is outside its section
    want = sorted([(t, x, 100.0 * t + x) for t in (0, 1) for x in range(3)] + [(t, 3 + x, 100.0 * t + x) for t in (2, 3) for x in range(2)])
    assert rows(c.dataset("/plain.ncml")) == rows(c.dataset("/nested.ncml")) == want


def test_datasets_that_are_read_together_have_the_same_rows(spark, store):
    calls = []
    counted = replace(store, read=lambda *given: calls.append(given) or store.read(*given))
    new = "<netcdf><aggregation type='joinNew' dimName='%s'><variableAgg name='tas'/><scan location='/d' regExp='.*/tas_[^/]*' %s/></aggregation></netcdf>"
    twice = "".join(f"<netcdf location='/d/tas_20000101.nc' section='0:{i},0:2'/>" for i in (0, 1))
    c = compiled(spark, counted, {
        "/both.ncml": f"<netcdf>{JOIN % '<scan location=\"/d\" suffix=\".nc\"/>'}</netcdf>",
        "/twice.ncml": f"<netcdf>{JOIN % (twice + (SCAN % 'tas') * 2)}</netcdf>",
        "/first.ncml": "<netcdf><aggregation type='union'><scan location='/d' suffix='.nc'/></aggregation></netcdf>",
        "/mark.ncml": new % ("run", "dateFormatMark='tas_#yyyyMMdd'"), "/name.ncml": new % ("run", ""),
        "/tiles.ncml": f"<netcdf><aggregation type='tiled' dimName='time x'>{twice}</aggregation></netcdf>",
    })
    asked = [{"period": ("2000-01-02", "2000-01-03"), "variables": ["tas"]}, {"variables": ["pr"]}, {"variables": []}]
    frames = lambda p, ds: [ds.frame(), *[ds.frame(**a) for a in asked if p == "/both.ncml"]]
    told = lambda p, ds: [(f.dtypes, sorted(map(repr, f.collect()))) for f in frames(p, ds)]
    sets = {path: c.dataset(path) for path in sorted(c.documents)}
    alone = {path: told(path, ds) for path, ds in sets.items()}
    assert len(alone["/both.ncml"][0][1]) == 18 and len(alone["/twice.ncml"][0][1]) == 6 + 18
    calls.clear()
    c.gather()
    assert {path: told(path, ds) for path, ds in sets.items()} == alone and len(calls) == 1


def test_documents_that_can_not_be_read_say_why(spark, store):
    c = compiled(spark, store, {
        "/a.ncml": "<netcdf location='/b.ncml'/>", "/b.ncml": "<netcdf><aggregation type='union'><scan location='/' suffix='a.ncml'/></aggregation></netcdf>",
        "/empty.ncml": "<netcdf/>", "/odd.ncml": "<netcdf><aggregation type='sideways'><scan location='/d' suffix='.nc'/></aggregation></netcdf>",
        "/mixed.ncml": "<netcdf><variable name='tas'><logicalSlice dimName='x' index='1'/></variable><aggregation type='union'><scan location='/d' suffix='.nc'/></aggregation></netcdf>",
    })
    for path, why in [("/a.ncml", "contain each other: /a.ncml -> /b.ncml -> /a.ncml"), ("/empty.ncml", "nothing to read"), ("/odd.ncml", "unknown aggregation sideways"),
                      ("/mixed.ncml", "different logical views"), ("/none.ncml", "no document")]:
        with pytest.raises(ValueError, match=why):
            c.dataset(path)


def test_marks_and_locations(spark):
    df = spark.createDataFrame([("/x/tas_day_2000010112_P006_end.nc",), ("/x/short.nc",)], "p string")
    got = df.select(
        marks.date("p", "01234567#yyyyMMddHH").alias("a"), marks.date("p", "#_day_#yyyyMMdd").alias("b"), marks.date("p", "yyyyMMddHH#_P#").alias("c"), marks.hours("p", "#_P#HHH").alias("d"),
    ).collect()
    assert tuple(got[0]) == (dt.datetime(2000, 1, 1, 12), dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1, 12), 6) and tuple(got[1]) == (None,) * 4
    with pytest.raises(ValueError):
        marks.date("p", "no mark")
    places = spark.createDataFrame([("a/b", "/r"), ("../b", "/r/s"), ("/c/./d/", "/r"), ("..", "/")], "l string, b string")
    assert [r[0] for r in places.select(names.absolute("l", "b")).collect()] == ["/r/a/b", "/r/b", "/c/d", "/"]
    ages = spark.createDataFrame([("5 min",), ("1 day",), ("2.5 hours",), (None,)], "t string")
    assert [r[0] for r in ages.select(marks.seconds(F.col("t"))).collect()] == [300.0, 86400.0, 9000.0, None]
    with pytest.raises(Exception, match="no length of time: 3 moons"):
        spark.range(1).select(marks.seconds("3 moons")).collect()
