"""Calendars that are not the standard one: day numbers both ways, as column expressions.

Day 0 is January 1 of year 0 of the calendar itself. A date of such a calendar
is a struct (year, month, day, micros); it becomes a time of the standard calendar
only where that has the same day (``align on date``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cubeweave.functions.names import col

# fixed values: calendars by their names
NOLEAP, ALL_LEAP, DAYS_360, JULIAN, GREGORIAN, STANDARD = "noleap", "all_leap", "360_day", "julian", "proleptic_gregorian", "standard"
NAMES = (NOLEAP, ALL_LEAP, DAYS_360, JULIAN, GREGORIAN, STANDARD)
ALIASES = {"365_day": NOLEAP, "366_day": ALL_LEAP, "gregorian": STANDARD}
# fixed values: lengths of the months of a common year
MONTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)

_DAY = 86_400_000_000
#: October 15, 1582, the first day of the later part of the standard calendar, and what the days before it are numbered less than in the Julian one.
_REFORM, _APART = 578_101, 2

Named = str | Column


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.transform(F.array(value), then)[0]


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("bigint")


def _known(calendar: Named) -> Named:
    """A calendar by its own name. An unknown one is an error."""
    if isinstance(calendar, str):
        name = ALIASES.get(calendar.lower(), calendar.lower())
        if name not in NAMES:
            raise ValueError(f"unknown calendar {calendar}")
        return name
    lowered = F.lower(calendar)
    chosen = F.when(lowered.isNull() | lowered.isin(*NAMES), lowered)
    for alias, name in ALIASES.items():
        chosen = chosen.when(lowered == alias, F.lit(name))
    return chosen.otherwise(F.raise_error(F.concat(F.lit("unknown calendar "), lowered)).cast("string"))


def _pick(calendar: Named, values: dict[str, Column]) -> Column:
    if isinstance(calendar, str):
        return values[calendar]
    chosen = F.when(calendar.isNull(), F.lit(None))
    for name, value in values.items():
        chosen = chosen.when(calendar == name, value)
    return chosen


def _leap(y: Column, calendar: Named) -> Column:
    fourth = F.pmod(y, F.lit(4)) == 0
    gregorian = fourth & ((F.pmod(y, F.lit(100)) != 0) | (F.pmod(y, F.lit(400)) == 0))
    return _pick(calendar, {NOLEAP: F.lit(False), ALL_LEAP: F.lit(True), DAYS_360: F.lit(False), JULIAN: fourth, GREGORIAN: gregorian})


def _before_year(y: Column, calendar: Named) -> Column:
    """Days of the years 0 to y - 1."""
    common = y * 365
    julian = common + _div(y + 3, 4)
    gregorian = julian - _div(y + 99, 100) + _div(y + 399, 400)
    return _pick(calendar, {NOLEAP: common, ALL_LEAP: y * 366, DAYS_360: y * 360, JULIAN: julian, GREGORIAN: gregorian})


def _starts(leap: Column, calendar: Named) -> Column:
    """The 0-based days of a year on which its months begin."""

    def begin(lengths: tuple[int, ...]) -> Column:
        return F.array(*[F.lit(sum(lengths[:m])).cast("bigint") for m in range(12)])

    real = F.when(leap, begin((31, 29, *MONTHS[2:]))).otherwise(begin(MONTHS))
    return _pick(calendar, {n: begin((30,) * 12) if n == DAYS_360 else real for n in NAMES if n != STANDARD})


def _number(y: Column, m: Column, d: Column, calendar: Named) -> Column:
    return _before_year(y, calendar) + F.element_at(_starts(_leap(y, calendar), calendar), m.cast("int")) + d - 1


def _date(n: Column, calendar: Named) -> Column:
    mean = _pick(calendar, {NOLEAP: F.lit(365.0), ALL_LEAP: F.lit(366.0), DAYS_360: F.lit(360.0), JULIAN: F.lit(365.25), GREGORIAN: F.lit(365.2425)})

    def of_year(y: Column) -> Column:
        parts = F.struct((n - _before_year(y, calendar)).alias("day"), _starts(_leap(y, calendar), calendar).alias("starts"))
        return _let(parts, lambda p: _let(F.size(F.filter(p["starts"], lambda s: s <= p["day"])), lambda m: F.struct(
            y.alias("year"), m.alias("month"), (p["day"] - F.element_at(p["starts"], m) + 1).cast("int").alias("day"))))

    # the mean length of a year is off by less than one year
    def near(g: Column) -> Column:
        return F.when(_before_year(g, calendar) > n, g - 1).when(_before_year(g + 1, calendar) <= n, g + 1).otherwise(g)

    return _let(_let(F.floor(n / mean).cast("bigint"), near), of_year)


def day_number(year: Column, month: Column, day: Column, calendar: Named) -> Column:
    """Days since January 1 of year 0 of a calendar."""
    known = _known(calendar)

    def of(date: Column) -> Column:
        y, m, d = (date[c] for c in ("year", "month", "day"))
        old = y * 10000 + m * 100 + d < 15821015
        if isinstance(known, str) and known != STANDARD:
            return _number(y, m, d, known)
        mixed = F.when(old, _number(y, m, d, JULIAN) - _APART).otherwise(_number(y, m, d, GREGORIAN))
        return mixed if isinstance(known, str) else F.when(known == STANDARD, mixed).otherwise(_number(y, m, d, known))

    return _let(F.struct(*[c.cast("bigint").alias(n) for n, c in (("year", year), ("month", month), ("day", day))]), of)


def date_of(number: Column, calendar: Named) -> Column:
    """The date with that number: struct (year, month, day)."""
    known = _known(calendar)
    if isinstance(known, str):
        if known != STANDARD:
            return _let(number.cast("bigint"), lambda n: _date(n, known))
        return _let(number.cast("bigint"), lambda n: F.when(n < _REFORM, _date(n + _APART, JULIAN)).otherwise(_date(n, GREGORIAN)))
    old = number < _REFORM
    name = F.when((known == STANDARD) & old, JULIAN).when(known == STANDARD, GREGORIAN).otherwise(known)
    moved = number.cast("bigint") + F.when((known == STANDARD) & old, _APART).otherwise(0)
    return _let(F.struct(moved.alias("n"), name.alias("name")), lambda p: _date(p["n"], p["name"]))


def _origin(units: Column) -> tuple[Column, Column]:
    """Year, month and day, and the microseconds of the day, of ``<unit> since <origin>``."""
    text = F.trim(F.element_at(F.split(units, " since "), 2))
    part = lambda n: F.regexp_extract(text, r"^(-?\d+)-(\d+)-(\d+)", n).cast("bigint")
    time = lambda n: F.coalesce(F.regexp_extract(text, r"^\S+[ T](\d+)(?::(\d+))?(?::(\d+(?:\.\d+)?))?", n).try_cast("decimal(12,6)"), F.lit(0))
    micros = (time(1) * 3600 + time(2) * 60 + time(3)) * 1_000_000
    return F.struct(part(1).alias("year"), part(2).alias("month"), part(3).alias("day")), micros.cast("bigint")


def decode(offset: str | Column, units: str | Column, seconds: Column, calendar: Named) -> Column:
    """``offset`` in ``<unit> since <origin>``, whose unit has that many seconds, as a date of the calendar (year, month, day, micros)."""
    date, micros = _origin(col(units))
    passed = F.round(col(offset).cast("decimal(28,10)") * seconds * 1_000_000).cast("bigint") + micros
    parts = F.struct(day_number(date["year"], date["month"], date["day"], calendar).alias("from"), passed.alias("passed"))

    def of(p: Column) -> Column:
        return _let(date_of(p["from"] + _div(p["passed"], _DAY), calendar), lambda d: F.struct(
            d["year"].alias("year"), d["month"].alias("month"), d["day"].alias("day"), F.pmod(p["passed"], F.lit(_DAY)).alias("micros")))

    return _let(parts, of)


def encode(date: Column, units: str | Column, seconds: Column, calendar: Named) -> Column:
    """The offset of a date (year, month, day, micros) in ``<unit> since <origin>``, as a double."""
    origin, micros = _origin(col(units))
    number = lambda d: day_number(d["year"], d["month"], d["day"], calendar)
    passed = (number(date) - number(origin)) * _DAY + date["micros"] - micros
    return passed / (seconds * 1_000_000)


def on_standard(date: Column) -> Column:
    """The time with the same date, null where the standard calendar has no such day."""

    def of(d: Column) -> Column:
        text = F.concat_ws("-", F.lpad(d["year"].cast("string"), 4, "0"), F.lpad(d["month"].cast("string"), 2, "0"), F.lpad(d["day"].cast("string"), 2, "0"))
        return text.try_cast("date").cast("timestamp_ntz") + F.make_dt_interval(secs=(d["micros"] / F.lit(1_000_000)).cast("decimal(18,6)"))

    return _let(date, of)
