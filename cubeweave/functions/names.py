"""Paths, file names and patterns as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: str | Column) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: str | Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def parent(path: str | Column) -> Column:
    return F.regexp_replace(col(path), r"/[^/]*$", "")


def dirs(path: str | Column) -> Column:
    """Directory components, the file name left out."""
    parts = F.split(col(path), "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def swap_prefix(path: str | Column, old: str, new: str) -> Column:
    """Replace a leading directory; other occurrences of the text stay."""
    p = col(path)
    return F.when(
        (p == old) | p.startswith(old + "/"), F.concat(F.lit(new), F.substr(p, F.lit(len(old) + 1)))
    ).otherwise(p)


def glob_to_regex(glob: str) -> str:
    """A shell pattern as a regular expression to search for; every other sign is literal.

    Stars at the ends become missing anchors: a search for ``.*x`` would try
    every start again and again on a text without x.
    """
    core = glob.strip("*")
    body = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in core)
    return f"{'' if glob.startswith('*') else '^'}{body}{'' if glob.endswith('*') else '$'}"


def glob_to_regex_column(glob: str | Column) -> Column:
    """The same for a column of shell patterns."""
    literal = F.regexp_replace(col(glob), r"([\\.^$|()\[\]{}+])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(literal, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def facets(path: str | Column, names: list[str]) -> list[Column]:
    """Facets from a file name: one per ``_``-separated part, then the period's start and end."""
    parts = F.split(stem(path), "_")
    period = F.split(F.element_at(parts, -1), "-")
    return [
        *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)],
        F.element_at(period, 1).alias("start"),
        F.element_at(period, -1).alias("end"),
    ]


def scenario_parts(exp: str | Column) -> Column:
    """``historical+ssp245`` -> its parts, in order."""
    return F.split(col(exp), r"\+")


def tidy(name: Column) -> Column:
    """Clean-up of generated names: no doubled and no dangling separators."""
    return F.replace(F.replace(name, F.lit("__"), F.lit("_")), F.lit("_."), F.lit("."))


def one_line(text: str | Column) -> Column:
    return F.regexp_replace(col(text), r"\R", " ")


def absolute(location: str | Column, base: str | Column) -> Column:
    """A location, which may be relative to the directory ``base``, without ``.`` and ``..``."""
    whole = F.when(F.startswith(col(location), F.lit("/")), col(location)).otherwise(F.concat_ws("/", col(base), col(location)))
    empty = F.array().cast("array<string>")
    step = lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(p.isin("", "."), a).otherwise(F.array_append(a, p))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(whole, "/"), empty, step), "/"))
