"""Calendars, calendar frequencies and alignment on them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cubeweave.functions import calendars, times
from cubeweave.operators import select

LENGTHS = {
    "noleap": lambda y: 365, "all_leap": lambda y: 366, "360_day": lambda y: 360, "julian": lambda y: 365 + (y % 4 == 0),
    "proleptic_gregorian": lambda y: 365 + (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)),
}


def months(name, y):
    if name == "360_day":
        return [30] * 12
    return [31, 28 + LENGTHS[name](y) - 365, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


@pytest.mark.parametrize("name", LENGTHS)
def test_every_day_of_a_calendar_both_ways(spark, name):
    """Days counted one by one, from year -3 to 405 and around 1900 and 2000."""
    want, n = {}, -sum(LENGTHS[name](y) for y in range(-3, 0))
    for y in range(-3, 2005):
        for m, size in enumerate(months(name, y), start=1):
            if y <= 405 or 1898 <= y <= 1901 or y >= 1999:
                want.update({n + d: (y, m, d + 1) for d in range(size)})
            n += size
    rows = spark.createDataFrame([(n, *d) for n, d in want.items()], "n bigint, y bigint, m int, d int").repartition(8)
    back = calendars.day_number(F.col("y"), F.col("m"), F.col("d"), name)
    found = calendars.date_of(F.col("n"), name)
    same = (found["year"] == F.col("y")) & (found["month"] == F.col("m")) & (found["day"] == F.col("d")) & (back == F.col("n"))
    assert rows.where(~same).take(3) == []


def test_the_standard_calendar_changes_in_1582(spark):
    rows = spark.createDataFrame([(i, "standard" if i % 2 else "gregorian") for i in range(-400, 400)], "i bigint, c string")
    reform = 578_101  # October 15, 1582
    found = rows.select("i", calendars.date_of(F.col("i") + reform, F.col("c")).alias("d"), "c")
    found = found.withColumn("back", calendars.day_number(F.col("d.year"), F.col("d.month"), F.col("d.day"), F.col("c")) - reform)
    got = {r.i: r for r in found.collect()}
    assert tuple(got[0].d) == (1582, 10, 15) and tuple(got[-1].d) == (1582, 10, 4) and tuple(got[-400].d) == (1581, 8, 31)
    assert all(r.back == i for i, r in got.items())
    assert tuple(got[300].d) == tuple((dt.date(1582, 10, 15) + dt.timedelta(days=300)).timetuple()[:3])


def test_decoding_aligns_on_the_date(spark):
    rows = [(58.5, "days since 2000-01-01 06:00:00", "noleap"), (59.0, "days since 2000-01-01", "noleap"), (59.0, "days since 2000-01-01", "all_leap"), (59.0, "days since 2001-01-01", "all_leap"),
            (59.0, "days since 2001-01-01", "360_day"), (29.0, "days since 2001-02-01", "360_day"), (1.5, "hours since 2000-02-29 23:00:00", "gregorian"), (None, "days since 2000-01-01", "noleap"), (1.0, "days since 2000-01-01", None)]
    df = spark.createDataFrame(rows, "v double, u string, c string")
    got = [r.t for r in df.select(times.decode("v", "u", F.col("c")).alias("t")).collect()]
    assert got == [dt.datetime(2000, 2, 28, 18), dt.datetime(2000, 3, 1), dt.datetime(2000, 2, 29), None, None, None, dt.datetime(2000, 3, 1, 0, 30), None, None]
    assert df.limit(1).select(times.decode("v", "u", "365_day").alias("t")).first().t == dt.datetime(2000, 2, 28, 18)
    with pytest.raises(ValueError, match="unknown calendar lunar"):
        times.decode("v", "u", "lunar")
    with pytest.raises(Exception, match="unknown calendar lunar"):
        df.select(times.decode("v", "u", F.lit("lunar").cast("string") if False else F.concat(F.lit("lun"), F.lit("ar"))).alias("t")).collect()


def series(name, *stamps):
    return [(name, t) for t in stamps]


def test_frequencies_as_named_elsewhere(spark):
    day = dt.datetime(2001, 1, 1)
    first = lambda n, step, hour=0: [dt.datetime(2001 + (m * step) // 12, (m * step) % 12 + 1, 1, hour) for m in range(n)]
    ends = [dt.datetime(2001, 3, 31), dt.datetime(2001, 6, 30), dt.datetime(2001, 9, 30), dt.datetime(2001, 12, 31)]
    rows = [
        *series("D", *[day + dt.timedelta(days=i) for i in range(40)]), *series("6h", *[day + dt.timedelta(hours=6 * i) for i in range(9)]),
        *series("W-MON", *[day + dt.timedelta(days=7 * i) for i in range(5)]), *series("MS", *first(7, 1, 12)), *series("2MS", *first(7, 2)), *series("QS-OCT", *first(5, 3)),
        *series("YS-JAN", *first(4, 12)), *series("QE-DEC", *ends), *series("30min", *[day + dt.timedelta(minutes=30 * i) for i in range(4)]),
        *series("uneven", day, day + dt.timedelta(days=1), day + dt.timedelta(days=3)), *series("short", day, day + dt.timedelta(days=1)),
        *series("QS-NOV", *[dt.datetime(2001, m, 1) for m in (2, 5, 8, 11)]), *series("YE-DEC", *[dt.datetime(y, 12, 31) for y in (2001, 2002, 2003)]),
    ]
    df = spark.createDataFrame(rows + rows[:3], "s string, t timestamp_ntz")
    got = {r.s: r.freq for r in select.frequency(df, ["s"], "t", F.trunc("t", "month")).collect()}
    assert got == {n: None if n in ("uneven", "short") else n for n, _ in rows}
    import pandas as pd

    for n, f in got.items():
        stamps = pd.DatetimeIndex(sorted({t for s, t in rows if s == n}))
        if len(stamps) >= 3:
            assert pd.infer_freq(stamps) == f


def test_alignment_falls_back_to_the_frequency(spark):
    month = lambda m, d=1: dt.datetime(2001, m, d)
    left = [("even", month(m), 1.0 * m) for m in range(1, 6)] + [("odd", month(1, 1), 1.0), ("same", month(2, 3), 5.0)]
    right = [("even", month(m, 1) + dt.timedelta(hours=12), 10.0 * m) for m in range(2, 7)] + [("odd", month(1, d), 1.0) for d in (2, 3, 7)] + [("same", month(2, 3), 6.0)]
    frame = lambda rows: spark.createDataFrame(rows, "s string, t timestamp_ntz, v double")
    got = select.align_inferred(frame(left), frame(right), ["s"], "t", "v", F.trunc("t", "month")).collect()
    even = sorted((r.bucket, r.left_value, r.right_value) for r in got if r.s == "even")
    assert even == [(month(m), 1.0 * m, 10.0 * m) for m in range(2, 6)]
    assert [(r.exact, r.freq, r.bucket) for r in got if r.s == "odd"] == [(False, None, None)]
    assert [(r.exact, r.left_value, r.right_value) for r in got if r.s == "same"] == [(True, 5.0, 6.0)]
