"""Text and CSV files. Schemas are declared; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.schema import CLEAN_SCHEMA, EXPORT_COLUMNS, ODS_SCHEMA, RAW_SCHEMA, SAMPLE_SCHEMA

_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(
    spark: SparkSession, path, schema: T.StructType, header: bool, glob: str | None = None
) -> DataFrame:
    """CSV by position; a field that does not parse becomes NULL and the row stays."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("timestampFormat", _TIME_FORMAT)
    # the header is skipped, columns are matched by position
    reader = reader.option("enforceSchema", "true").option("header", str(header).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def read_raw_log(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMA, header=False)


def read_clean_log(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, CLEAN_SCHEMA, header=True)


def read_sample_log(spark: SparkSession, path) -> DataFrame:
    """The small form with a header and integer behaviour codes."""
    return read_csv(spark, path, SAMPLE_SCHEMA, header=True)


def read_landing_log(spark: SparkSession, path, header: bool = False) -> DataFrame:
    """Every field as the text it arrived in."""
    return read_csv(spark, path, ODS_SCHEMA, header=header)


def read_lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for reports whose size does not grow with the log."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").option("timestampFormat", _TIME_FORMAT).csv(path)


def export_detail(df: DataFrame, path: str) -> None:
    """Filtered detail as CSV, written in parallel."""
    write_csv(df.select(*EXPORT_COLUMNS), path)
