"""Cases that once went wrong outside the registered queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import numeric, times
from cubeweave.runtime import new_dir
from cubeweave.sources import descriptors, inventory, sinks, substrate
from cubeweave.streaming import arrivals


def test_decode_knows_units_by_all_names_and_no_others(spark):
    rows = [(1.5, "hour since 2000-01-01"), (2.0, "d since 2000-01-01"), (90.0, "Minutes since 2000-01-01 00:00:00"), (None, None)]
    df = spark.createDataFrame(rows, "v double, u string")
    got = [r.t for r in df.select(times.decode("v", "u").alias("t")).collect()]
    assert got == [dt.datetime(2000, 1, 1, 1, 30), dt.datetime(2000, 1, 3), dt.datetime(2000, 1, 1, 1, 30), None]
    with pytest.raises(Exception, match="unknown unit of time: months"):
        spark.createDataFrame([(1.0, "months since 2000-01-01")], "v double, u string").select(times.decode("v", "u").alias("t")).collect()


def test_total_with_more_decimals(spark):
    df = spark.createDataFrame([(1.2e-5,), (3.4e-5,)], "v double")
    assert df.select(numeric.total("v", 6).alias("s")).first().s == 4.6e-5


def test_walk_is_not_bounded_and_ends_in_a_cycle(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n12", "n3"), ("x", "x")]
    edges = spark.createDataFrame(chain, "parent string, child string")
    roots = spark.createDataFrame([("n0",), ("x",)], "node string")
    got = inventory.walk(edges, roots, None).where("root = 'n0'")
    assert {r.node: r.depth for r in got.collect()} == {f"n{i + 1}": i for i in range(12)}


def test_a_broken_snapshot_is_written_again(spark, tmp_path):
    path = str(tmp_path / "s")
    (tmp_path / "s" / "rows").mkdir(parents=True)
    assert inventory.snapshot(spark.range(3), path).count() == 3
    assert inventory.snapshot(spark.range(9), path).count() == 3


def test_packed_times_keep_their_hours(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, h), "a", 1.2e-5) for h in (0, 3, 6)]
    sinks.write_packed(spark.createDataFrame(rows, "time timestamp_ntz, r string, pr double"), str(tmp_path / "p"), ["time"], ["r"])
    got = spark.read.parquet(str(tmp_path / "p")).orderBy("time").collect()
    assert [r.time for r in got] == [19723.0, 19723.125, 19723.25] and {r.pr for r in got} == {1.2e-5}


def test_resolve_in_relative_trees(spark):
    xml = "<netcdf><aggregation type='union'><scan location='%s' suffix='.nc' subdirs='%s'/></aggregation></netcdf>"
    docs = spark.createDataFrame(
        [(1, xml % ("data", "true")), (2, xml % ("data/", "false")), (3, xml % ("data/sub/", "true")), (4, xml % ("/top/", "true")), (5, xml % ("/", "true"))],
        "doc_id int, xml string",
    )
    files = spark.createDataFrame([("data/a.nc",), ("data/sub/b.nc",), ("/top/c.nc",)], "path string")
    got = descriptors.resolve(descriptors.facts(docs), files).orderBy("doc_id", "path").collect()
    assert [(r.doc_id, r.path) for r in got] == [(1, "data/a.nc"), (1, "data/sub/b.nc"), (2, "data/a.nc"), (3, "data/sub/b.nc"), (4, "/top/c.nc"), (5, "/top/c.nc")]


def test_both_variables_of_every_row(spark, sf_dir):
    rows = substrate.records(spark, sf_dir).where("variable = 'pr'").agg(F.sum("value")).first()[0]
    assert rows == substrate.grid(spark, sf_dir).agg(F.sum("pr")).first()[0]
    gated = substrate.members(spark, sf_dir).groupBy("center", "run").agg(F.count_distinct("variable").alias("n"))
    assert {r.n for r in gated.collect()} == {1, 2}


def test_documents_of_any_depth(spark):
    """Six levels of groups and aggregations, and thirty: every element is a fact."""

    def nested(n):
        inner = "<enumTypedef name='sky'><enum key='0'>clear</enum></enumTypedef><attribute name='a' value='v'/><strange x='1'/>"
        groups = "".join(f"<group name='g{i}'>{inner}" for i in range(n)) + "</group>" * n
        return "<netcdf>" + f"<aggregation type='union'><netcdf>{groups}" * n + "</netcdf></aggregation>" * n + "</netcdf>"

    for n in (6, 30):
        docs = spark.createDataFrame([(1, nested(n)), (2, "no document"), (3, None)], "doc_id int, xml string")
        kinds = {(r.doc_id, r.kind): r["count"] for r in descriptors.facts(docs).groupBy("doc_id", "kind").count().collect()}
        assert kinds == {(1, "dataset"): 1, (1, "aggregation"): n, (1, "member"): n, (1, "group"): n * n, (1, "attribute"): n * n, (1, "enum"): n * n, (1, "strange"): n * n, (2, "unreadable"): 1}
    deepest = descriptors.facts(docs).where("kind = 'enum'").selectExpr("max_by(node_path, length(node_path))").first()[0]
    assert deepest.count("/aggregation[0]/netcdf[0]") == 30 and deepest.count("/group[0]") == 30


def test_edits_leave_the_rest_of_a_document(spark):
    xml = "<netcdf xmlns='urn:x' location='l'><!-- kept --><variable name='a'><logicalReduce dimNames='d'/></variable><odd>text</odd></netcdf>"
    docs = spark.createDataFrame([(1, xml), (2, None)], "doc_id int, xml string")
    edited = descriptors.rename_variable(descriptors.add_removal(docs, "t", "variable"), "a", "b")
    path = new_dir(spark, "test")
    sinks.write_descriptors(descriptors.set_variable_attribute(edited, "b", "units", F.lit('"K" & <more>')), path)
    back = sinks.read_descriptors(spark, path, key_type="int").where("doc_id = 1")
    text = back.first().xml
    assert "<!-- kept -->" in text and "logicalReduce" in text and "<odd>text</odd>" in text and 'xmlns="urn:x"' in text and 'location="l"' in text
    facts = descriptors.facts(back).collect()
    assert {(f.name, f.org_name) for f in facts if f.kind == "variable"} == {("b", "a")}
    assert [f.value for f in facts if f.kind == "attribute"] == ['"K" & <more>']
    assert [f.name for f in facts if f.kind == "remove"] == ["t"]


def test_unknown_leads_are_no_leads(spark, tmp_path):
    rows = [("2024010100", dt.datetime(2024, 1, 1), "TMP_TGL_2m", lead) for lead in (0, 3, 3, 1, None, 999)]
    spark.createDataFrame(rows, "cycle string, reftime timestamp_ntz, source string, lead int").write.parquet(str(tmp_path / "in"))
    stream = arrivals.source(spark, str(tmp_path / "in"), "cycle string, reftime timestamp_ntz, source string, lead int")
    arrivals.update_pass(arrivals.lead_sets(stream), str(tmp_path / "out"))
    assert [r.n_leads for r in arrivals.result(spark, str(tmp_path / "out")).collect()] == [2]
