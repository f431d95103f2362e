"""Sharding by extendible hashing.

Every row has an address of 60 bits: 32 of its key's digest, then 28 of a digest
of id and text, so that rows of one hot key can still be told apart. A bucket
is a prefix of the address. Buckets with more bytes than the limit split on one
more bit, others stay; what remains are the shards. The directory maps address
prefixes to shards.

``STEP`` bits are counted at a time, and only for rows of buckets that are still
too large, so a bucket's rows are never brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.llm.tables import save

BITS = 60
STEP = 12
#: Bytes of UTF-8 text of a shard.
LIMIT = 16 << 20


def _digits(text: Column, n: int) -> Column:
    return F.substring(F.md5(F.encode(text, "UTF-8")), 1, n)


def address(key: Column, row_id: Column, text: Column) -> Column:
    """The 60-bit address of a row; nulls count as empty texts."""
    clean = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    tie = F.concat_ws("/", clean(row_id), clean(text))
    return F.conv(F.concat(_digits(clean(key), 8), _digits(tie, 7)), 16, 10).cast("bigint")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The shards of rows (address, bytes).

    Returns level, slot (address prefix of level * STEP bits), depth, prefix,
    shard_bytes, shard_rows: one row for each slot in use. A bucket at the last bit
    that is still too large is a shard all the same: its rows are equal.
    """
    found, open_rows, level = None, rows, 1
    while True:
        top, low = level * STEP, (level - 1) * STEP
        slots = open_rows.groupBy(F.shiftright("address", BITS - top).alias("slot")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        depths = F.explode(F.sequence(F.lit(low), F.lit(top))).alias("depth")
        under = slots.select("slot", "bytes", "n", depths).withColumn("prefix", F.expr(f"shiftright(slot, {top} - depth)"))
        slots = save(under, "slots")
        sizes = slots.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        # a bucket is a shard if it fits and the one above it does not; the one above the first depth of a later level never does
        above = sizes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("upper"), F.col("shard_bytes").alias("upper_bytes"))
        sizes = sizes.withColumn("upper", F.expr("shiftright(prefix, 1)")).join(above, ["depth", "upper"], "left")
        fits = (F.col("shard_bytes") <= limit) | (F.col("depth") == BITS)
        whole = sizes.where(fits & (F.col("upper_bytes").isNull() | (F.col("upper_bytes") > limit)))
        whole = slots.select("slot", "depth", "prefix").join(whole, ["depth", "prefix"])
        new = save(whole.select(F.lit(level).alias("level"), "slot", "depth", "prefix", "shard_bytes", "shard_rows"), "directory")
        found = new if found is None else found.unionByName(new)
        if top == BITS:
            return found
        large = save(slots.where(F.col("depth") == top).join(new.select("slot"), "slot", "left_anti").select("slot"), "large")
        if large.isEmpty():
            return found
        slot = F.shiftright("address", BITS - top)
        open_rows = save(open_rows.join(large, slot == large["slot"], "left_semi"), "addresses")
        level += 1


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, limit: int = LIMIT) -> DataFrame:
    """The shard of each row of ``docs``: shards hold at most ``limit`` bytes of text.

    key_col: rows of one key stay together as far as the limit allows (default: the id).
    Returns the id column, address, bytes, shard (the address prefix, as bits), shard_bytes,
    shard_rows and fits (false for a shard of equal rows that are together larger than the limit, such as one row).

    Null and empty texts have no bytes and go where their ids lead. Null ids
    and keys count as empty ones. Repeated rows share a shard. An empty table
    gives no rows. Other columns are not read.
    """
    key, row_id, text = F.col(key_col or id_col), F.col(id_col), F.col(text_col)
    rows = docs.select(row_id.alias("id"), address(key, row_id, text).alias("address"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    rows = save(rows, "addresses")
    found = directory(rows.select("address", "bytes"), limit)
    levels = found.agg(F.coalesce(F.max("level"), F.lit(1))).first()[0]
    keys = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("address", BITS - n * STEP).alias("slot")) for n in range(1, levels + 1)]))
    placed = rows.select("*", keys.alias("k")).select("id", "address", "bytes", "k.*").join(found, ["level", "slot"])
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return placed.select(F.col("id").alias(id_col), "address", "bytes", name.alias("shard"), "shard_bytes", "shard_rows", (F.col("shard_bytes") <= limit).alias("fits"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, limit: int = LIMIT) -> None:
    """Write the rows of ``docs``, all columns, to one folder for each shard (column _shard of the written table)."""
    placed = shards(docs, id_col, text_col, key_col, limit).select(F.col("address").alias("_address"), F.concat(F.lit("s"), "shard").alias("_shard")).distinct()
    mine = docs.withColumn("_address", address(F.col(key_col or id_col), F.col(id_col), F.col(text_col)))
    mine.join(placed, "_address").drop("_address").repartition("_shard").write.partitionBy("_shard").parquet(path)


#: The same in SQL for DuckDB.
SQL = f"""
WITH r AS (SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
  ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) || substr(md5(CAST(doc_id AS VARCHAR) || '/' || coalesce(text, '')), 1, 7))::BIGINT AS address FROM documents),
d AS (SELECT doc_id, unnest(range({BITS + 1}))::INT AS depth, address, bytes FROM r),
b AS (SELECT depth, address >> ({BITS} - depth) AS prefix, sum(bytes) AS shard_bytes, count(*) AS shard_rows FROM d GROUP BY ALL),
s AS (SELECT b.* FROM b LEFT JOIN b AS u ON u.depth = b.depth - 1 AND u.prefix = b.prefix >> 1
  WHERE (b.shard_bytes <= {LIMIT} OR b.depth = {BITS}) AND (u.depth IS NULL OR u.shard_bytes > {LIMIT}))
SELECT doc_id, address, bytes, CASE WHEN depth = 0 THEN '' ELSE substr(lpad(bin(prefix), {BITS}, '0'), {BITS + 1} - depth) END AS shard,
  shard_bytes::BIGINT AS shard_bytes, shard_rows, shard_bytes <= {LIMIT} AS fits
FROM r JOIN s ON s.prefix = r.address >> ({BITS} - s.depth)
"""
