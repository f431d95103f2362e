"""The registered queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cubeweave.llm import periodic_runs, personal, prefix_trie, quality, repeated_passages, rule_classifier, secrets, sharding, token_shards, url_lists

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cubeweave.llm.sentencepieces import digests

    return digests(table(spark, sf_dir, "documents"), _model())


@query("op3_decontaminate")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cubeweave.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cubeweave.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op9_quality_rules", quality.SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digests(table(spark, sf_dir, "documents"))


@query("op5_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digests(table(spark, sf_dir, "documents"))


@query("op2_secrets")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_url_lists", url_lists.SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_lists.filter_urls(url_lists.captures_of(pages), url_lists.entries_of(pages), id_col="page_id")


@query("op7_sharding", sharding.SQL)
def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


@query("op4_token_shards")
def materialise_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(spark, table(spark, sf_dir, "documents"), _model())


@query("op13_periodic_runs")
def runs_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.repeating(table(spark, sf_dir, "documents"))))


@query("op12_prefix_trie", prefix_trie.SQL)
def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.branched(prefix_trie.turns(table(spark, sf_dir, "conversations"))))


@query("op11_repeated_passages")
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.digests(table(spark, sf_dir, "documents"))
