"""One query for each operator, over its whole table, with the SQL that states it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import centroids, chat, divergence, embed_dedup, langid, licenses, minhash, mixing, packing, rules, sharding, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents")).select("doc_id", "slot", "shard")


SQL["op1_sharding"] = sharding.ORACLE


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.by_document(mixing.mix(table(spark, folder, "documents")))


SQL["op2_mixing"] = mixing.ORACLE


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(table(spark, folder, "conversations"))


SQL["op6_chat_format"] = chat.ORACLE


@query
def op7_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


@query
def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op8_topk"] = topk.ORACLE


@query
def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


@query
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


SQL["op11_divergence"] = divergence.ORACLE


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


SQL["op12_centroids"] = centroids.ORACLE


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
