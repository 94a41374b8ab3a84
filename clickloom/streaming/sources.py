"""Streams of behaviour events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.behavior import behavior_col, behavior_from_code
from clickloom.schema import STREAM_SCHEMA
from clickloom.sources.adapters import behavior_from_events


def _files(spark: SparkSession, schema: T.StructType, max_files: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def json_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages that land as JSON files."""
    return normalize(_files(spark, STREAM_SCHEMA, max_files).json(path))


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str) -> DataFrame:
    """Messages of a Kafka topic; needs the Kafka connector on the cluster's class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return normalize(decode_messages(raw))


def decode_messages(raw: DataFrame, schema: T.StructType = STREAM_SCHEMA) -> DataFrame:
    """Binary or text ``value`` with JSON -> columns."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("message")).select("message.*")


def normalize(messages: DataFrame) -> DataFrame:
    """Integer codes -> behaviour enum, event time under the name used everywhere."""
    return messages.withColumn("behavior_type", behavior_from_code(behavior_col())).withColumnRenamed("ts", "datetime")


def event_files_stream(spark: SparkSession, path: str, max_files: int | None = None, legal_only: bool = True, extra=()) -> DataFrame:
    """Files of the events table as they arrive, as a behaviour stream with event time ``datetime``."""
    schema = spark.read.parquet(path).schema
    events = _files(spark, schema, max_files).parquet(path)
    return behavior_from_events(events, legal_only, *extra)
