"""Edits, gates, samples, catalogue and forecast rules on literal rows."""

import datetime as dt
import random
import warnings

import pytest
from pyspark.sql import functions as F

from cubeweave.operators import catalog, edit, forecast, select, tables

ATTRS = "dataset int, scope string, variable string, pos int, name string, value string"


@pytest.fixture(scope="module")
def attrs(spark):
    rows = [
        (1, "global", None, 1, "title", "a"), (1, "global", None, 2, "title", "b"), (1, "global", None, 3, "_x", "h"),
        (1, "variable", "tas", 4, "units", "K"), (1, "variable", "lat", 5, "_CoordinateAxisType", "Lat"),
        (1, "variable", "lat", 6, "units", "deg"), (2, "global", None, 1, "title", "c"),
    ]
    return spark.createDataFrame(rows, ATTRS)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_variable_attribute_upsert(attrs):
    out = edit.set_attribute(attrs, "variable", "pr", "units", F.lit("mm"))
    # the variable is made where there are variables; dataset 2 has none and stays as it is
    assert rows_of(out.where("variable = 'pr'"), "dataset", "name", "value") == [(1, "units", "mm")]
    out = edit.set_attribute(attrs, "variable", "tas", "units", F.lit("degC"))
    assert rows_of(out.where("variable = 'tas'"), "dataset", "value") == [(1, "degC")]
    assert out.count() == attrs.count()


def test_dataset_attribute_upsert_adds_to_a_list(attrs):
    out = edit.set_attribute(attrs, "global", None, "history", F.lit("h"))
    assert rows_of(out.where("name = 'history'"), "dataset", "value") == [(1, "h"), (2, "h")]


def test_last_duplicate_wins_and_axes_and_hidden_names_go(attrs):
    out = catalog.extract_attributes(attrs)
    assert rows_of(out, "dataset", "name", "value") == [(1, "title", "b"), (1, "units", "K"), (2, "title", "c")]


def test_renames_keep_the_first_name(spark):
    cube = spark.createDataFrame([(1, 2.0)], "lat int, tas double")
    out = edit.rename_variable(edit.rename_variable(cube, "tas", "t2m"), "t2m", "temp")
    assert edit.original_name(out, "temp") == "tas"
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert edit.rename_variable(cube, "zg", "z").columns == cube.columns
        assert edit.remove_variable(cube, "zg").columns == cube.columns
    assert len(seen) == 2


def test_scenario_prefix_rules():
    assert edit.prefixed("rcp45", "tas") == "rcp45_tas"
    assert edit.prefixed("rcp45", "rcp45_tas") == "rcp45_tas"
    assert edit.prefixed("allrcps", "tas") == edit.prefixed("nrcan", "tas") == "tas"


def test_delta_names(spark):
    got = spark.range(1).select(F.explode(edit.with_deltas(F.lit("v")))).collect()
    assert [r[0] for r in got] == [
        "v", "v_delta_1971_2000", "v_delta_1991_2020", "v_delta_1971_2000_delta_1991_2020",
    ]


@pytest.mark.parametrize("dtype,value,want", [("tinyint", -1, 255), ("smallint", -2, 65534), ("int", -1, 4294967295), ("tinyint", 7, 7)])
def test_unsigned(spark, dtype, value, want):
    df = spark.createDataFrame([(value,)], "v int").select(F.col("v").cast(dtype).alias("v"))
    assert df.select(edit.as_unsigned(F.col("v"), dtype)).first()[0] == want


def test_second_choice_leads_only_without_the_primary(spark):
    rows = [(1, v) for v in ("tas", "pr", "a")] + [(2, v) for v in ("pr", "a")] + [(3, "a")]
    df = spark.createDataFrame(rows, "g int, variable string")
    out = select.primary_first(df, ["g"], "tas", "pr")
    got = {g: [r.variable for r in out.where(f"g = {g}").orderBy("place").collect()] for g in (1, 2, 3)}
    assert got == {1: ["tas", "a", "pr"], 2: ["pr", "a"], 3: ["a"]}


def test_strict_guard_fails(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "g int, path string")
    assert select.check_bounds(df, ["g"], 1, 2).collect()
    with pytest.raises(Exception, match="unexpected number of files"):
        select.check_bounds(df, ["g"], 1, 1).collect()


def test_sample_of_a_skewed_group_is_whole_and_repeatable(spark):
    rows = [("hot", f"f{i}") for i in range(400)] + [(f"g{i}", "f") for i in range(5)]
    a = spark.createDataFrame(rows, "g string, path string")
    random.Random(1).shuffle(rows)
    b = spark.createDataFrame(rows, "g string, path string").repartition(7)
    take = lambda df: rows_of(select.sample(df, ["g"], "path", 0.1, 15, seed=3), "g", "path")
    assert take(a) == take(b)
    assert sum(g == "hot" for g, _ in take(a)) == 15 and len(take(a)) == 20
    # half to even: 0.1 * 25 is 2, not 3
    c = spark.createDataFrame([("g", f"f{i}") for i in range(25)], "g string, path string")
    assert select.sample(c, ["g"], "path", 0.1, 15, seed=3).count() == 2


def test_nearest_breaks_ties_downwards(spark):
    df = spark.createDataFrame([(x, 0.0) for x in (44.0, 45.0, 46.0)], "lat double, v double")
    assert select.nearest(df, {"lat": 44.5}).first().lat == 44.0


def test_most_common_step_and_its_tie(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 10, 17)]
    df = spark.createDataFrame([("s", d) for d in days], "station string, day date")
    got = select.common_step(df, ["station"], "day", F.trunc("day", "month")).first()
    assert (got.step, got.n_steps) == (1, 4)


def test_first_region_falls_back(spark):
    df = spark.createDataFrame([("a", -75.0, 46.0), ("b", -75.0, 30.0), ("c", -100.0, 60.0), ("d", 10.0, 10.0)], "s string, lon double, lat double")
    got = {r.s: r.region for r in select.first_region(df, ["s"]).collect()}
    assert got == {"a": "main", "b": "ghcn", "c": "none", "d": None}


def test_vocabulary(spark):
    terms = {"realm": {"aerosol": "AER"}, "frequency": ["day", "mon"]}
    rows = [(1, "global", None, 1, "realm", "aerosol"), (2, "global", None, 1, "realm", "wrong!")]
    df = spark.createDataFrame(rows, ATTRS)
    ok = catalog.check_values(df, catalog.vocabulary(spark, terms))
    assert rows_of(ok, "dataset", "ok") == [(1, True), (2, False)]
    filled = catalog.fill_defaults(df.where("dataset = 1"), {"license": ["free"], "frequency": ["day", "mon"], "realm": terms["realm"]}).first()
    assert (filled.license, filled.frequency, filled.n_missing) == ("free", None, 1)


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"realm": {"aerosol": "AER"}, "frequency": ["day"]}')
    (tmp_path / "b.json").write_text('{"model":\n {"M1": {"x": 1}}}')
    got = rows_of(catalog.read_vocabulary(spark, str(tmp_path)), "facet", "value", "code")
    assert got == [("frequency", "day", "day"), ("model", "M1", "M1"), ("realm", "aerosol", "AER")]


def test_collection_name(spark):
    urls = ["https://h.org/thredds/a/b/catalog.html", "http://h/a/b/?x=1", "http://h/a.html"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(catalog.collection_name("u")).collect()] == ["thredds_a_b", "a_b", "a"]


def test_lead_grid_and_threshold():
    assert len(forecast.LEADS) == 97 and forecast.LEADS[:2] == [0, 3] and forecast.LEADS[-3:] == [372, 378, 384]
    assert forecast.required_leads() == 86


def test_past_cycles(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 6),)], "now timestamp_ntz")
    got = df.select(forecast.past_cycles("now")).first()[0]
    assert sorted(c.strftime("%Y%m%d%H") for c in got) == ["2024022800", "2024022812", "2024022900", "2024022912", "2024030100"]


@pytest.mark.parametrize(
    "source,raw,want",
    [("TMP_TGL_2m", "t2m", "tas"), ("APCP_SFC_0", "paramId_0", "pr"), ("APCP_SFC_0", "unknown", "pr"), ("TMP_TGL_2m", "unknown", None), ("TMP_TGL_2m", "paramId_0", None)],
)
def test_published_names(spark, source, raw, want):
    df = spark.createDataFrame([(source, raw)], "s string, r string")
    assert df.select(forecast.published_name("s", "r")).first()[0] == want


def test_upsert_and_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert rows_of(tables.upsert(old, new, ["k"]), "k", "v", "action") == [(1, "a", "kept"), (2, "B", "replaced"), (3, "c", "created")]
    assert rows_of(tables.changes(old, new, ["k"], F.col("v")), "k", "change") == [(1, "removed"), (2, "changed"), (3, "new")]


def test_alignment_falls_back_to_buckets(spark):
    def series(*times):
        return spark.createDataFrame([(dt.datetime.fromisoformat(t), 1) for t in times], "t timestamp_ntz, v int")

    noon, midnight = series("2024-01-15T12:00", "2024-02-15T12:00"), series("2024-01-01", "2024-02-01")
    exact = select.align_or_bucket(noon, noon, [], "t", "month", "v")
    assert rows_of(exact, "bucket") == [(dt.date(2024, 1, 15),), (dt.date(2024, 2, 15),)]
    coarse = select.align_or_bucket(noon, midnight, [], "t", "month", "v")
    assert rows_of(coarse, "bucket") == [(dt.date(2024, 1, 1),), (dt.date(2024, 2, 1),)]


def test_entries_of_a_collection(spark, attrs):
    assets = spark.createDataFrame([(1, "/d/1.nc")], "dataset int, path string")
    got = {r.dataset: r for r in catalog.entries(attrs, "reanalysis", assets).collect()}
    assert list(got[1].asDict())[1:] == catalog.cells_of("reanalysis")
    assert (got[1].title, got[1].institute, got[1].variable_name, got[1].path) == ("b", "NA", ["tas"], "/d/1.nc")
    assert got[2].variable_name is None and got[2].path is None

    made = catalog.entries(attrs, "reanalysis", make=lambda table: table.select("dataset").distinct())
    assert made.columns == ["dataset"] and made.count() == 2


def test_datasets_without_the_asked_attributes_stay(spark, attrs):
    bare = spark.createDataFrame([(70, "global", None, 1, "_hidden", "x")], attrs.schema)
    every = attrs.unionByName(bare)
    assert {r.dataset: r.title for r in catalog.facet_table(every, ["title"]).collect()}[70] == "NA"
    report = {r.dataset: r for r in catalog.field_report(every).collect()}[70]
    assert report.n_missing == len(catalog.cells_of(report.collection, "dataset")) and report.n_extra == 0
    assert {r.dataset for r in catalog.fill_defaults(every, {"title": ["only"]}).collect()} >= {70}


def test_layout_as_a_table(spark):
    got = catalog.layout(spark).where("collection = 'forecast'").orderBy("place").collect()
    assert [r.column for r in got] == catalog.cells_of("forecast")
    assert [r.kind for r in got][-3:] == ["variable", "variable", "asset"]
