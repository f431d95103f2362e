"""Small tables written out in the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return repr(value)


def table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows as literals: the planner knows their size, and no Python worker is started."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    cells = ", ".join(
        "(" + ", ".join(f"CAST({_text(v)} AS {t})" for v, (_, t) in zip(row, fields)) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t({', '.join(n for n, _ in fields)})")
