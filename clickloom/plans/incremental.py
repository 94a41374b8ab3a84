"""Layers that grow with the landing: only new files are read, and only the days they touch are rebuilt.

A manifest lists the files that were taken in. A batch is all files that it does not list. Its rows go to the
landing layer by day and batch; the days found there are then rebuilt from the landing layer's rows of these days, each in
detail, rollup, bitmaps and reports by day, so a row that comes again in a later file still counts once. Reports over all days merge
the parts by day and never read detail. The manifest is written last: a batch that did not get there is taken in again under
the same number and overwrites what it left."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.behavior import parse_bigint
from clickloom.functions.rates import rate_decimal
from clickloom.functions.time import epoch_to_day
from clickloom.operators.cleaning import to_dwd, to_ods
from clickloom.operators.distinct import bitmap_rollup, users_of_bitmaps
from clickloom.operators.ranking import top_k
from clickloom.operators.rollup import regroup
from clickloom.plans.metrics import funnel_of
from clickloom.plans.warehouse import daily_from_rollup, hourly_rollup, rated_hours
from clickloom.schema import ODS_COLUMNS
from clickloom.sources.tables import read_if_there, write_partitioned

MANIFEST = "path string, length bigint, modified timestamp, batch bigint"


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_if_there(spark, f"{root}/manifest", _schema(spark, MANIFEST))


def new_files(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """Files below ``landing`` that the manifest does not list, by path, length and time; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    found = found.select("path", "length", F.col("modificationTime").alias("modified"))
    return found.join(manifest(spark, root), ["path", "length", "modified"], "left_anti")


def take_in(spark: SparkSession, landing: str, root: str, read=None) -> list[str]:
    """Take in what landed since the last time; the days that were rebuilt. ``read(paths)`` opens files, by default Parquet."""
    files = new_files(spark, landing, root).orderBy("path").collect()  # names only, as a file listing has them
    if not files:
        return []
    batch = (manifest(spark, root).agg(F.max("batch")).first()[0] or 0) + 1
    paths = [row.path for row in files]
    landed = to_ods(read(paths) if read else spark.read.parquet(*paths))
    # Rows without a day are kept for audits under a day of their own; no later layer asks for them.
    day = F.coalesce(epoch_to_day(parse_bigint(F.col("timestamp"))), F.lit("none"))
    ods = landed.withColumns({"dt": day, "batch": F.lit(batch)})
    spread = ods.hint("rebalance", F.col("dt")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    spread.partitionBy("dt", "batch").parquet(f"{root}/ods")
    kept = spark.read.schema(_schema(spark, ", ".join(f"{name} string" for name in ODS_COLUMNS) + ", dt string, batch bigint")).parquet(f"{root}/ods")
    days = [row.dt for row in kept.where((F.col("batch") == batch) & (F.col("dt") != "none")).select("dt").distinct().orderBy("dt").collect()]
    if days:
        _rebuild(kept.where(F.col("dt").isin(days)).select(*ODS_COLUMNS), root, days)
    rows = spark.createDataFrame(files, "path string, length bigint, modified timestamp").withColumn("batch", F.lit(batch).cast("bigint"))
    write_partitioned(rows, f"{root}/manifest", "batch")
    return days


def _rebuild(ods: DataFrame, root: str, days: list[str]) -> None:
    """All layers by day from the landing layer's rows of some whole days."""

    def written(df: DataFrame, name: str, sort_by=None) -> DataFrame:
        return write_partitioned(df, f"{root}/{name}", "dt", sort_by).where(F.col("dt").isin(days))

    detail = written(to_dwd(ods), "dwd", ["user_id", "datetime"])
    rollup = written(hourly_rollup(detail), "rollup")
    pv, buy = (F.count_if(F.col("behavior_type") == kind).alias(name) for kind, name in (("pv", "pv"), ("buy", "buy_cnt")))
    parts = {
        "dws": daily_from_rollup(regroup(rollup, "dt")),
        "ads_hourly": rated_hours(rollup, "dt", "hour"),
        "bitmaps": bitmap_rollup(detail, "dt"),
        "categories": detail.groupBy("dt", "category_id").agg(pv, buy),
    }
    # independent jobs share the executors instead of waiting for each other's last task
    with ThreadPoolExecutor(len(parts)) as pool:
        jobs = [pool.submit(written, df, name) for name, df in parts.items()]
    for job in jobs:
        job.result()


def category_report(spark: SparkSession, root: str, top_n: int = 20, min_pv: int = 100) -> DataFrame:
    """Categories over all days from the parts by day: category_id, pv, buy_cnt, buy_rate."""
    parts = spark.read.parquet(f"{root}/categories")
    summed = parts.groupBy("category_id").agg(F.sum("pv").alias("pv"), F.sum("buy_cnt").alias("buy_cnt")).where(F.col("pv") > min_pv)
    return top_k(summed.withColumn("buy_rate", rate_decimal(F.col("buy_cnt"), F.col("pv"))), top_n, ["pv"], "category_id")


def funnel_report(spark: SparkSession, root: str) -> DataFrame:
    """Funnel over all days from the bitmaps by day: layer_name, user_cnt, pct_of_pv."""
    bitmaps = spark.read.parquet(f"{root}/bitmaps")
    return funnel_of(users_of_bitmaps(bitmaps, pv_users=("pv",), intent_users=("cart", "fav"), buy_users=("buy",)))
