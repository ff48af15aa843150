"""A corpus from documents to token shards: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import decontaminate, mixing, shards, simhash, toxicity
from changeloom.llm.common import fresh, staged

#: Documents from this toxicity on are rejected.
TOXIC = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below ``TOXIC``; the lexicon is learned from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    name = fresh(docs, "toxicity")
    return toxicity.score(docs, lexicon, name=name).filter(F.col(name) < TOXIC).select(*_columns(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs).select(*_columns(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*_columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    times = mixing.mix(docs).filter("mix_times > 0")
    turn = fresh(times, "turn")
    return times.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("mix_times").cast("int")))).select(*_columns(docs))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order, in the shared folder; the rows say what each sequence holds and where it is."""
    return shards.materialise(docs)


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token output", as_tokens),
]
#: Fingerprints, tiles and token ids have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
