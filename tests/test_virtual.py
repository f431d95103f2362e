"""Aggregation semantics on small literal datasets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import ordering, times
from cubeweave.operators import compare, virtual
from cubeweave.plans.dataset import VirtualDataset


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def yearly(spark):
    """Five yearly files of one point; from the second on time restarts at zero."""
    rows = []
    for i, year in enumerate(range(1990, 1995)):
        n = 366 if year % 4 == 0 else 365
        origin = f"days since {1990 if i == 0 else year}-01-01 00:00:00"
        rows += [(f"f{year}", i, float(d), origin, float(year * 1000 + d)) for d in range(n)]
    return spark.createDataFrame(rows, "file string, ordinal int, time double, units string, tasmin double")


def test_changing_units_give_a_gapless_axis(yearly):
    decoded = yearly.select(times.decode("time", "units").alias("t"), "tasmin")
    got = decoded.agg(F.min("t"), F.max("t"), F.count_distinct("t")).first()
    assert got == (day("1990-01-01"), day("1994-12-31"), 365 * 5 + 1)


@pytest.mark.parametrize("unit,seconds", [("days", 86400), ("hours", 3600), ("minutes", 60), ("seconds", 1)])
def test_units(spark, unit, seconds):
    df = spark.createDataFrame([(1.5, f"{unit} since 2000-01-01 00:00:00")], "v double, u string")
    assert df.select(times.decode("v", "u")).first()[0] == day("2000-01-01") + dt.timedelta(seconds=1.5 * seconds)


def test_attributes_of_the_last_but_one_member(spark):
    rows = [("d", i, f"a{i}") for i in range(5)] + [("single", 0, "only")]
    df = spark.createDataFrame(rows, "dataset string, ordinal int, attr string")
    got = {r.dataset: r.attr for r in virtual.last_but_one(df, ["dataset"], "ordinal").collect()}
    assert got == {"d": "a3", "single": "only"}


def test_offsets_with_and_without_a_coarse_key(spark):
    rows = [("d", y, f"p{y}{m}", y + m) for y in range(3) for m in range(4)] + [("e", 0, "p", 7)]
    df = spark.createDataFrame(rows, "dataset string, year int, path string, ncoords int")
    plain = virtual.member_offsets(df, ["dataset"], ["path"])
    split = virtual.member_offsets(df, ["dataset"], ["path"], coarse="year")
    assert sorted(plain.select(split.columns).collect()) == sorted(split.collect())
    total, want = 0, []
    for d, y, p, n in sorted(r for r in rows if r[0] == "d"):
        want.append((p, total, total + n - 1))
        total += n
    got = plain.where("dataset = 'd'").select("path", "first_index", "last_index").orderBy("path").collect()
    assert [tuple(r) for r in got] == want


def test_previous_time_crosses_slices(spark):
    rows = [("s", day(t)) for t in ("2024-01-01", "2024-01-31", "2024-02-10", "2024-05-01")] + [("r", day("2024-03-03"))]
    df = spark.createDataFrame(rows, "station string, t timestamp_ntz")
    got = ordering.previous_time(df, ["station"], F.trunc(F.col("t").cast("date"), "month"), "t", "before")
    pairs = {(r.station, r.t): r.before for r in got.collect()}
    assert pairs[("s", day("2024-02-10"))] == day("2024-01-31")
    assert pairs[("s", day("2024-05-01"))] == day("2024-02-10")
    assert pairs[("s", day("2024-01-01"))] is None and pairs[("r", day("2024-03-03"))] is None


def test_union_takes_the_first_holder_of_a_name(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "x int, tas double")
    b = spark.createDataFrame([(2, 99.0, 5.0), (3, 99.0, 6.0)], "x int, tas double, pr double")
    got = virtual.union_variables([a, b], ["x"]).orderBy("x").collect()
    assert [tuple(r) for r in got] == [(1, 10.0, None), (2, 20.0, 5.0), (3, None, 6.0)]


def test_merge_flags_conflicts_and_drops_helpers(spark):
    a = spark.createDataFrame([(1, 1.0, 0), (2, None, 0), (3, 3.0, 0)], "x int, tas double, surface int")
    b = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0), (4, 5.0)], "x int, tas double")
    got = virtual.merge_outer([a, b], ["x"], helpers=("surface", "not_there")).orderBy("x").collect()
    assert [tuple(r) for r in got] == [(1, 1.0, False), (2, 2.0, False), (3, 3.0, True), (4, 5.0, False)]


def test_tiles(spark):
    df = spark.createDataFrame([("0:1,10:14", 1, 4), ("2:3,0:4", 0, 0), ("2:3,0:4", 5, 0)], "section string, y int, x int")
    got = virtual.place_tiles(df, "section", ["y", "x"]).collect()
    assert [tuple(r) for r in got] == [("0:1,10:14", 1, 14, True), ("2:3,0:4", 2, 0, True), ("2:3,0:4", 7, 0, False)]


def _cube(spark, variable, values):
    rows = [(day(t), float(x), v) for t, x, v in values]
    return spark.createDataFrame(rows, f"time timestamp_ntz, lat double, {variable} double")


def test_virtual_dataset_prunes_members_before_reading(spark):
    old = VirtualDataset.of(_cube(spark, "tas", [("1999-12-31", 1, 1.0)]), ["time", "lat"], ("1999-01-01", "1999-12-31"), origin="old")
    new = VirtualDataset.of(_cube(spark, "tas", [("2000-01-01", 1, 2.0)]), ["time", "lat"], ("2000-01-01", "2000-12-31"), origin="new")
    pr = VirtualDataset.of(_cube(spark, "pr", [("2000-01-01", 1, 9.0)]), ["time", "lat"])
    tas = VirtualDataset.concat([old, new])
    assert tas.attributes == {"origin": "old"} and tas.period == ("1999-01-01", "2000-12-31")
    both = VirtualDataset.merge([tas, pr]).with_attributes(title="t")
    stacked = VirtualDataset.stack({"a": both, "b": both}, "realization", ["tas", "pr"])
    assert stacked.frame().count() == 4
    one = stacked.frame(["tas"], period=("2000-01-01", "2000-12-31"), labels=["b"])
    assert [tuple(r) for r in one.select("realization", "lat", "tas").collect()] == [("b", 1.0, 2.0)]
    # the older member is not part of the plan, and of the other variable only the coordinates are
    assert tas.frame(period=("2000-01-01", "2000-12-31")).count() == 1
    plan = both.frame(["tas"])._jdf.queryExecution().optimizedPlan().toString()
    assert "max(pr" not in plan and "max(tas" in plan
    fx = spark.createDataFrame([(1.0, 123.0)], "lat double, orog double")
    assert {r.orog for r in both.attach(fx).frame(["tas"]).collect()} == {123.0}


def test_choosing_variables_keeps_the_rows(spark):
    tas = VirtualDataset.of(_cube(spark, "tas", [("2000-01-01", 1, 1.0), ("2000-01-02", 1, 2.0)]), ["time", "lat"])
    pr = VirtualDataset.of(_cube(spark, "pr", [("2000-01-02", 1, 9.0), ("2000-01-03", 1, 8.0)]), ["time", "lat"])
    merge = VirtualDataset.merge([tas, pr])
    assert merge.frame().count() == merge.frame(["tas"]).count() == merge.frame(["pr"]).count() == 3
    stack = VirtualDataset.stack({"a": merge, "b": tas}, "realization", ["tas"])
    assert [(r.realization, r.pr) for r in stack.frame(["pr"], labels=["b"]).collect()] == [("b", None)] * 2
    assert stack.frame(["tas"]).count() == 5
    with pytest.raises(ValueError, match="no members with the labels c"):
        stack.frame(labels=["a", "c"])


def test_the_last_day_of_a_period_is_whole(spark):
    hours = _cube(spark, "tas", [("2000-01-01 03:00", 1, 1.0), ("2000-01-02 03:00", 1, 2.0), ("2000-01-03 00:00", 1, 3.0)])
    leaf = VirtualDataset.of(hours, ["time", "lat"], ("2000-01-01", "2000-01-02"))
    assert leaf.frame(period=("2000-01-01", "2000-01-02")).count() == 2
    assert leaf.frame(period=("2000-01-01", "2000-01-02T02:00")).count() == 1
    both = VirtualDataset.concat([leaf, VirtualDataset.of(hours, ["time", "lat"], ("2000-01-03", "2000-01-03"))])
    assert both.frame(period=("2000-01-02T03:00", "2000-01-02T04:00")).count() == 1


def test_child_datasets_equal_their_union(spark):
    tasmin = _cube(spark, "tasmin", [("2000-01-01", 1, 1.0), ("2000-01-02", 1, 2.0)])
    tasmax = _cube(spark, "tasmax", [("2000-01-01", 1, 5.0)])
    parent = VirtualDataset.merge([VirtualDataset.of(d, ["time", "lat"]) for d in (tasmin, tasmax)]).frame()
    for v, child in (("tasmin", tasmin), ("tasmax", tasmax)):
        seen = parent.where(F.col(v).isNotNull()).select("time", "lat", v)
        assert seen.exceptAll(child).count() == 0 and child.exceptAll(seen).count() == 0


def test_comparison_tolerances(spark):
    rows = [(1, 1.0, 1.0014), (2, 1.0, 1.0016), (3, None, None), (4, 1.0, None)]
    left = spark.createDataFrame([(day("2000-01-01"), x, a) for x, a, _ in rows], "time timestamp_ntz, x int, tas double")
    right = spark.createDataFrame(
        [(day("2000-01-01"), x, b) for x, _, b in rows] + [(day("2000-01-01"), 5, 1.0)], "time timestamp_ntz, x int, tas double"
    )
    got = compare.compare_values(left, right, ["time", "x"], []).first()
    assert (got.n_cells, got.n_absent, got.n_failed) == (5, 1, 2)


def test_360_day_calendar(spark):
    rows = [(2000, 2, 29), (2001, 2, 29), (2001, 2, 30), (2001, 12, 30)]
    df = spark.createDataFrame(rows, "y int, m int, d int")
    got = [r[0] for r in df.select(times.from_calendar(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [dt.date(2000, 2, 29), None, None, dt.date(2001, 12, 30)]
