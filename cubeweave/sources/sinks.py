"""Writers, each with the reader that takes its output back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeweave.functions import times


def write_table(df: DataFrame, path: str) -> None:
    """A header and rows as gzip CSV; list columns become text first."""
    flat = [
        F.array_join(n, "|", "NA").alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes
    ]
    df.select(*flat).write.mode("errorifexists").option("header", True).option("compression", "gzip").csv(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_descriptors(docs: DataFrame, path: str, key: str = "doc_id", xml: str = "xml") -> None:
    """Documents as XML text, each in one ``document`` element that carries its key. Null texts are left out."""
    body = F.regexp_replace(xml, r"^\s*<\?xml[^>]*\?>", "")
    text = F.concat(F.lit('<document key="'), F.replace(F.col(key).cast("string"), F.lit('"'), F.lit("&quot;")), F.lit('">'), body)
    docs.where(F.col(xml).isNotNull()).select(text.alias("value")).write.mode("errorifexists").option("lineSep", _END).text(path)


#: What ends a document in the files of ``write_descriptors``.
_END = "</document>\n"


def read_descriptors(spark: SparkSession, path: str, key: str = "doc_id", key_type: str = "bigint") -> DataFrame:
    text = spark.read.option("lineSep", _END).text(path)
    parts = lambda n: F.regexp_extract("value", r'(?s)^<document key="([^"]*)">(.*)$', n)
    return text.select(F.replace(parts(1), F.lit("&quot;"), F.lit('"')).cast(key_type).alias(key), parts(2).alias("xml"))


def modified_name(path: str) -> str:
    """Default output name of an edited document."""
    return f"{path.removesuffix('.ncml')}_modified.ncml"


def write_json_by(df: DataFrame, by: str, path: str) -> None:
    """One JSON object per row, in one folder per value of ``by``."""
    body = F.to_json(F.struct(*[c for c in df.columns if c != by]))
    df.select(by, body.alias("value")).write.mode("errorifexists").partitionBy(by).text(path)


def read_json_by(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_packed(df: DataFrame, path: str, times: list[str], partition: list[str]) -> None:
    """Packed cube: times as double days since 1970 with fractions, 64-bit and decimal values as single, zstd Parquet.

    The rebalance hint gathers the rows of a partition into few files and
    splits the partitions that are too large for one task.
    """
    packed = []
    for name, dtype in df.dtypes:
        if name in times:
            since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name).cast("timestamp_ntz"))
            packed.append((since / F.lit(86_400_000_000.0)).alias(name))
        elif dtype == "bigint" or dtype.startswith("decimal"):
            packed.append(F.col(name).cast("float").alias(name))
        else:
            packed.append(F.col(name))
    (
        df.select(*packed)
        .hint("rebalance", *partition)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(*partition)
        .parquet(path)
    )


def write_cube(cube: DataFrame, path: str, label: str = "realization") -> None:
    """A published cube: zstd Parquet, one folder per label and year, sorted by
    time and place inside a file so that row groups can be skipped."""
    order = [c for c in ("time", "lat", "lon", "station") if c in cube.columns]
    (
        cube.withColumn("year", F.year("time"))
        .hint("rebalance", label, "year")
        .sortWithinPartitions(label, "year", *order)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy(label, "year")
        .parquet(path)
    )


def read_cube(
    spark: SparkSession, path: str, period: tuple[str, str] | None = None, labels: list[str] | None = None, label: str = "realization"
) -> DataFrame:
    """A published cube. A period (ISO dates, the last one whole, or times) and labels leave only the folders they meet."""
    cube = spark.read.parquet(path)
    if labels is not None:
        cube = cube.where(F.col(label).isin(*labels))
    if period is not None:
        first, last = period
        cube = cube.where(F.col("year").between(int(first[:4]), int(last[:4])) & times.within("time", period))
    return cube.drop("year")
