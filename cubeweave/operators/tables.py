"""Changes to keyed tables: upsert, delete, diff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sides(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old rows and new rows, the new one where both have a key; ``action`` tells what happened.

    One grouping of both sides, so a key is moved once.
    """
    rest = [c for c in old.columns if c not in key]
    action = (
        F.when(F.max("_side") == 0, "kept").when(F.min("_side") == 1, "created").otherwise("replaced").alias("action")
    )
    return _sides(old, new).groupBy(*key).agg(*[F.max_by(c, "_side").alias(c) for c in rest], action)


def delete_with_children(
    parents: DataFrame, children: DataFrame, wiped: DataFrame, key: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Children and parents left after some parents are deleted; children go first."""
    return children.join(wiped, key, "left_anti"), parents.join(wiped, key, "left_anti")


def changes(old: DataFrame, new: DataFrame, key: list[str], content: Column) -> DataFrame:
    """Keys that are new, changed or removed between two snapshots, by a hash of their content."""
    hashed = lambda df: df.select(*key, F.sha2(content, 256).alias("hash"))
    state = _sides(hashed(old), hashed(new)).groupBy(*key).agg(
        F.max(F.when(F.col("_side") == 0, F.col("hash"))).alias("_old"),
        F.max(F.when(F.col("_side") == 1, F.col("hash"))).alias("_new"),
    )
    change = (
        F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    )
    return state.select(*key, change.alias("change")).where(F.col("change").isNotNull())
