"""Times in file names, told by the marks of a scan.

Three kinds of marks name a place in a file name and a date format:

* ``prefix#format``: the text begins at the place of the ``#``;
* ``#text#format``: it follows the first occurrence of ``text``;
* ``format#text#``: it stands before that occurrence.

A format is a date pattern, or, for an offset, a run of H. Each mark becomes one column expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cubeweave.functions import names, times


def _cut(name: Column, mark: str) -> tuple[Column, str]:
    """The part of a file name that a mark points at (null where there is none), and the mark's format."""
    pieces = mark.split("#")
    if len(pieces) == 2:
        before, form = pieces
        start = F.lit(len(before) + 1)
    elif len(pieces) == 3 and pieces[1]:
        form = pieces[2] or pieces[0]
        at = F.instr(name, pieces[1])
        start = F.when(at > 0, at + len(pieces[1]) if pieces[2] else at - len(form))
    else:
        raise ValueError(f"no mark: {mark}")
    if not form:
        raise ValueError(f"a mark without a format: {mark}")
    width = len(form.replace("'", ""))
    return F.when(start > 0, F.substr(name, start, F.lit(width))), form


def date(path: str | Column, mark: str) -> Column:
    """The time that a mark finds in the name of a file, null where it finds none."""
    text, form = _cut(names.file_name(path), mark)
    return F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")


def hours(path: str | Column, mark: str) -> Column:
    """The number of hours that a mark finds, null where it finds none."""
    text, form = _cut(names.file_name(path), mark)
    if set(form) != {"H"}:
        raise ValueError(f"an offset is counted in hours: {mark}")
    return text.try_cast("int")


def seconds(interval: str | Column) -> Column:
    """``5 min``, ``1 day`` in seconds; a unit that has no fixed length, or no name here, is an error. Null stays null."""
    text = F.lower(F.trim(interval if isinstance(interval, Column) else F.lit(interval)))
    number = F.regexp_extract(text, r"^([0-9.]+)", 1).try_cast("double")
    unit = F.trim(F.regexp_replace(text, r"^[0-9.]+", ""))
    length = F.when(unit == "", F.lit(1))
    for size, known in times.UNITS.items():
        length = length.when(unit.isin(*known), F.lit(size))
    length = length.otherwise(F.raise_error(F.concat(F.lit("no length of time: "), text)).cast("int"))
    return F.when(text.isNotNull(), number * length)


def is_mark(text: str) -> bool:
    return bool(re.fullmatch(r"[^#]*#[^#]+|#[^#]+#[^#]+|[^#]+#[^#]+#", text))
