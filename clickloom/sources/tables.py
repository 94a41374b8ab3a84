"""Parquet and catalog tables: overwrite, partitioned overwrite, verified load and fallback."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.quality import load_verification, require_rows


def read_table(spark: SparkSession, source: str, columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet path (anything with a slash) or a catalog table, optionally only some columns."""
    if "/" in source:
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.parquet(source)
    else:
        df = spark.table(source)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a whole layer or report and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str, sort_by: list[str] | None = None) -> DataFrame:
    """Overwrite only the partitions that ``df`` has rows for.

    Rows are rebalanced by the partition column: a small day becomes one file, a day that holds a
    large part of all rows is split over many tasks."""
    spread = df.hint("rebalance", F.col(key))
    if sort_by:
        spread = spread.sortWithinPartitions(key, *sort_by)
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key).parquet(path)
    names = [field for field in df.schema.fields if field.name != key] + [df.schema[key]]
    return df.sparkSession.read.schema(T.StructType(names)).parquet(path).select(*df.columns)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType, finished: bool = False) -> DataFrame:
    """A Parquet table by its declared schema; no rows if nothing was written there yet, or, with ``finished``, if writing it was
    cut short. Overwriting single partitions leaves no mark of being finished."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS") if finished else spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def drop_partition(spark: SparkSession, path: str, key: str, value: str) -> None:
    """Remove the files of one partition of a Parquet table; the value is one that needs no escaping, such as a day."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{key}={value}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_clean(df: DataFrame, path: str) -> DataFrame:
    """Materialize a clean log, ordered within files so that scans can skip by user and time."""
    return write_table(df.sortWithinPartitions("user_id", "timestamp"), path)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a catalog table from a query."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def load_and_verify(df: DataFrame, path: str) -> DataFrame:
    """Repeatable bulk load: replace the content, read it back from storage, report it, fail if empty."""
    loaded = write_table(df, path)
    return load_verification(require_rows(loaded))


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """The same load into a relational table: emptied, kept with its definition and refilled."""
    df.write.mode("overwrite").option("truncate", "true").options(**options).jdbc(url, table)


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options: str) -> DataFrame:
    return spark.read.options(**options).jdbc(url, table).select(*columns)


def first_available(*candidates) -> tuple[DataFrame, str]:
    """First source that opens and has rows, with its label; candidates are (label, open function)."""
    problems = []
    for label, open_source in candidates:
        try:
            df = open_source()
            if not df.isEmpty():
                return df, label
            problems.append(f"{label}: no rows")
        except PySparkException as error:
            problems.append(f"{label}: {error.getCondition() or 'not readable'}")
        except Py4JJavaError as error:  # a JDBC driver's own errors
            problems.append(f"{label}: {error.java_exception.getClass().getSimpleName()}")
    raise FileNotFoundError("; ".join(problems))
