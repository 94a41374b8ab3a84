"""Documents to training shards: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import table
from clickloom.llm.decontaminate import contamination
from clickloom.llm.mixture import mix
from clickloom.llm.near_dup import near_duplicates
from clickloom.llm.shards import shards
from clickloom.llm.toxicity import toxicity
from clickloom.session import materialize, pin_session

#: Limit of a shard; small corpora have several as well.
SHARD_BYTES = 1 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from all labels of the table."""
    pin_session(spark)
    scored = toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    found = contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each repetition of a document that the mix has."""
    mixed = mix(docs.select(*COLUMNS)).where("repeats > 0")
    return mixed.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that they belong to."""
    return shards(docs.select(*COLUMNS), SHARD_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Signatures, suffix arrays and compressors are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
