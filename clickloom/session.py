"""Session settings and the shared folder for tables that jobs hand to each other."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_PINNED = {
    # Event times are UTC wall time everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session built elsewhere."""
    for key, value in _PINNED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "clickloom", master: str | None = None, **conf) -> SparkSession:
    """Session for a job. Sizes (executors, shuffle partitions) come from the cluster's defaults
    unless given: keyword ``spark_sql_shuffle_partitions=8`` sets ``spark.sql.shuffle.partitions``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _PINNED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return pin_session(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees, as named by ``spark.checkpoint.dir``.

    A session without that setting uses a folder below its warehouse, which all executors share too."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate").rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one subfolder per application so that it can be
    removed as a whole when the application is over."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/clickloom-{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate table once and read it back, for results with several readers.

    Survives executor loss, keeps column pruning and gives later joins true sizes. Options are the Parquet writer's."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_and_free(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same, and the shuffle files that writing it took are deleted at once, not when the driver's memory is tidied up."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return materialize(df, name, **options)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)
