"""Intermediate tables in the folder that all executors share, and joins with tables of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.runtime import new_dir

#: Most keys whose rows are joined by broadcast.
HEAVY = 1000


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` and read it back: its lineage ends here, and a lost executor costs nothing."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has each key once and in ``rows`` how often ``rows`` has it.

    Keys with at least 1 / HEAVY of all rows are HEAVY at most: they are
    broadcast, and no task gets all rows of one of them.
    """
    least = table.agg(F.ceil(F.sum("rows") / HEAVY)).first()[0] or 1
    heavy, light = table.where(F.col("rows") >= max(least, HEAVY)).drop("rows"), table.where(F.col("rows") < max(least, HEAVY)).drop("rows")
    few = F.broadcast(heavy)
    return rows.join(few, keys).unionByName(rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys))
