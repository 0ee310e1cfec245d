"""A corpus from raw documents: toxicity, language, near duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before has kept. All but the last
return rows with the columns of ``documents``; the last returns the packed pieces. An empty table stays empty
in every stage, and columns that no stage reads go along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, minhash, mixing, packing, toxicity
from tidemark.plans.scratch import written

SURE = 0.5  # least posterior of the language
FAR = 0.28  # how far the fit to the language may lie below 0 (training texts) on the way to -1 (nothing known),
SHORT = 0.15  # and what a text of one letter has besides; it falls with the root of the number of letters


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score below 0.5). It learns from the labels.
    Null and empty texts score as texts without any landmark; repeated rows share a fate; rows with a null
    id take part."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.predict(docs, model) < 0.5)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows: not ``und``, at least SURE of it, and its letters not
    much less probable than in the language's training texts, so most texts in a language that was not learned go,
    and letter junk. Null texts and texts without letters go; repeated rows share a fate;
    rows with a null id or language take part; without anything to learn from, all go."""
    model = langid.train(docs.filter(~langid.held_out("doc_id", 4, 2)))
    said = docs.withColumn("_pipeline_said", langid.predict(docs, model))
    near = F.col("_pipeline_said.fit") >= -(FAR + SHORT / F.sqrt(F.greatest("_pipeline_said.letters", F.lit(1))))
    return said.filter((F.col("_pipeline_said.lang_pred") != "und") & (F.col("_pipeline_said.score") >= SURE) & near).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the
    smallest id, a null id last, ties by a hash of id and text. Rows are told apart by that hash, so null and
    repeated ids are judged row by row; rows equal in both are one document. Each document without words is
    kept."""
    keyed = docs.withColumn("_pipeline_key", F.xxhash64("doc_id", "text"))
    groups = minhash.near_duplicates(keyed, id_col="_pipeline_key").select(F.col("doc_id").alias("_pipeline_key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_pipeline_key")).alias("first")
    kept = groups.distinct().join(keyed.select("_pipeline_key", "doc_id").distinct(), "_pipeline_key").groupBy("component_id").agg(first)
    return keyed.join(kept.select("first._pipeline_key"), "_pipeline_key", "left_semi").dropDuplicates(["_pipeline_key"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, as rows: a copy of a document is a row if the mix takes at least
    half of its words, so a row is a whole text and a source is off its target by half a text at most. A
    document without words adds nothing to the mix and goes. A null source is a source; rows equal in id, text
    and source are documents of their own in the mix, and come out as many times as it takes them in all."""
    keyed = docs.withColumn("_pipeline_key", F.xxhash64("doc_id", "text", "source"))
    copies = written(mixing.mix(keyed, id_col="_pipeline_key"))
    taken = copies.filter(2 * F.col("taken") >= F.col("size")).filter("taken > 0").groupBy("doc_id").agg(F.count("*").alias("_pipeline_copies"))
    rows = keyed.join(taken.withColumnRenamed("doc_id", "_pipeline_key"), "_pipeline_key").dropDuplicates(["_pipeline_key"])
    return rows.withColumn("_pipeline_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_pipeline_copies"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of whole texts; copies of a text are kept apart. Texts without words have no piece; null ids and
    sources take part."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models and near duplicates are not expressible in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
