"""Times: units, calendars, cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.functions import calendars
from cubeweave.functions.names import col


def day_text(c: str | Column) -> Column:
    return col(c).cast("date").cast("string")


def within(time: str | Column, period: tuple[str, str]) -> Column:
    """Whether a time is in a period of ISO dates or times. A date at the end stands for its whole day.

    Both bounds are literals, so the comparison reaches the Parquet reader.
    """
    first, last = period
    end = col(time) < timestamp(last) + F.make_dt_interval(days=F.lit(1)) if len(last) <= 10 else col(time) <= timestamp(last)
    return (col(time) >= timestamp(first)) & end


def timestamp(text: str) -> Column:
    """A zone-less literal; comparing a stored time with it reaches the Parquet reader."""
    return F.lit(text).cast("timestamp_ntz")


def days_of_year(time: str) -> Column:
    """Number of distinct days of one year, as an aggregate.

    A day is a bit of one of six 64-bit masks: masks merge map-side, and no
    second exchange is needed as it is for a distinct count.
    """
    day = F.dayofyear(time) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), day % 61)
    masks = [F.bit_or(F.when(F.floor(day / 61) == i, bit).otherwise(F.lit(0).cast("bigint"))) for i in range(6)]
    return sum((F.bit_count(m).cast("bigint") for m in masks[1:]), F.bit_count(masks[0]).cast("bigint"))


def units_text(origin: Column) -> Column:
    return F.concat(F.lit("days since "), origin.cast("string"), F.lit(" 00:00:00"))


# fixed values: units of time by their names, in seconds
UNITS = {
    86400: ["days", "day", "d"],
    3600: ["hours", "hour", "hr", "h"],
    60: ["minutes", "minute", "min"],
    1: ["seconds", "second", "sec", "s"],
}


def unit_seconds(units: str | Column) -> Column:
    """Length of the unit of ``<unit> since <origin>``. A unit that has no fixed length, or no name here, is an error."""
    unit = F.lower(F.trim(F.element_at(F.split(col(units), " since "), 1)))
    known = [(unit.isin(*names), length) for length, names in UNITS.items()]
    seconds = F.when(unit.isNull(), F.lit(None).cast("bigint"))
    for is_it, length in known:
        seconds = seconds.when(is_it, F.lit(length).cast("bigint"))
    return seconds.otherwise(F.raise_error(F.concat(F.lit("unknown unit of time: "), unit)).cast("bigint"))


def decode(offset: str | Column, units: str | Column, calendar: str | Column | None = None) -> Column:
    """``offset`` in ``<unit> since <origin>`` as a time.

    With a calendar (a name, or a column of names) the count is that of the
    calendar, and the result the time with the same date: null for a day that
    the standard calendar does not have.
    """
    seconds = unit_seconds(units)
    if calendar is not None:
        return calendars.on_standard(calendars.decode(offset, units, seconds, calendar))
    origin = F.element_at(F.split(col(units), " since "), 2).cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=(col(offset) * seconds).cast("decimal(18,6)"))


def from_calendar(year: Column, month: Column, day: Column) -> Column:
    """A calendar date as a standard one; null when the standard calendar has no such day."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return text.try_cast("date")


def _replaced(cube: DataFrame, variable: str, value: Column, **attributes: str) -> DataFrame:
    metadata = {**cube.schema[variable].metadata, **attributes}
    return cube.withColumn(variable, value).withMetadata(variable, metadata)


def to_celsius(cube: DataFrame, variable: str) -> DataFrame:
    """Kelvin to degrees Celsius, with the new units in the column's metadata."""
    offset = F.lit("273.15").cast("decimal(5,2)")
    return _replaced(cube, variable, F.col(variable) - offset, units="degC", cell_methods="time: mean")


def to_daily_depth(cube: DataFrame, variable: str) -> DataFrame:
    """A precipitation rate to a depth per day."""
    return _replaced(
        cube, variable, F.col(variable) * F.lit(86400), units="mm",
        long_name="depth of water-equivalent precipitation", cell_methods="time: sum",
    )
