"""Exact totals of values with a fixed number of decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cubeweave.functions.names import col


def total(c: str | Column, decimals: int = 2) -> Column:
    """Sum of values with so many decimals, as a double that does not depend on the order of rows.

    Whole units of the last decimal are summed as 64-bit integers, which stays
    inside generated code; a decimal sum of more than 18 digits does not. Give
    the decimals that the variable is stored with: what lies beyond is rounded.
    """
    scale = 10**decimals
    return F.sum(F.round(col(c).cast("double") * scale).cast("bigint")) / F.lit(float(scale))
