"""The training-text pipeline: its stages in order, and a runner.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeweave.llm.decontaminate import contaminated
from cubeweave.llm.near_dedup import near_duplicates
from cubeweave.llm.personal import sanitise
from cubeweave.llm.quality import passing
from cubeweave.llm.sentencepieces import encode
from cubeweave.llm.tables import save

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; of the others the lines that failed go. n_chars follows the text."""
    return passing(docs, cleaned=True).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates (five words, 80 %): the document with the least id of each group stays.

    Texts that share an id are told apart: each stays unless it is a copy. Of
    equal rows, and of copies under one id, one stays. Documents without
    an id can not be told apart and stay.
    """
    marks = near_duplicates(docs, keyed=True).where("doc_id is not null").select("doc_id", "digest", "group")
    alone = marks.where("group is null").select("doc_id", "digest").distinct()
    first = marks.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*")
    kept = alone.unionByName(first).distinct().withColumn("stays", F.lit(True))
    keyed = docs.withColumn("digest", F.coalesce(F.xxhash64("text"), F.lit(0)))
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    marked = keyed.join(kept, ["doc_id", "digest"], "left").where("stays or doc_id is null")
    return marked.withColumn("row", row).dropDuplicates(["doc_id", "digest", "row"]).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go. They are known by their texts, so null and repeated ids do no harm."""
    digest = F.md5(F.encode("text", "UTF-8"))
    found = contaminated(docs.select(digest.alias("digest"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="digest")
    return docs.withColumn("digest", digest).join(found.select("digest").distinct(), "digest", "left_anti").select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are replaced; n_chars follows the text."""
    return sanitise(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text (binary, little-endian unsigned 32-bit), and the digest of what they decode to."""
    coded = encode(docs, _model(), decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("sentencepiece", tokens),
]

#: Near duplicates, alignment and encoding are not SQL; tests/llm holds a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = save(docs, "stage")
    return docs
