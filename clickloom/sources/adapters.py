"""The given tables as behaviour logs and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.behavior import choose
from clickloom.functions.time import epoch_to_datetime
from clickloom.schema import ODS_COLUMNS

# Event types and the behaviours they stand for.
EVENT_BEHAVIORS = {"view": "pv", "click": "fav", "signup": "cart", "purchase": "buy"}
CATEGORIES = 20


def open_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _item() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def behavior_from_events(events: DataFrame, legal_only: bool = False, *extra: str) -> DataFrame:
    """Events as a behaviour log. Types without a behaviour stay as they are, an illegal enum value,
    unless ``legal_only``, where the filter is on the source column and reaches the scan.
    ``extra`` source columns are kept, an ``item_id`` that is already there is used."""
    if legal_only:
        events = events.where(F.col("event_type").isin(*EVENT_BEHAVIORS))
    named = events.select(
        *extra,
        "user_id",
        "item_id" if "item_id" in events.columns else _item().alias("item_id"),
        choose(F.col("event_type"), EVENT_BEHAVIORS, F.col("event_type")).alias("behavior_type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    return named.select(
        *extra,
        "user_id",
        "item_id",
        (F.col("item_id") % CATEGORIES).alias("category_id"),
        "behavior_type",
        "timestamp",
        epoch_to_datetime(F.col("timestamp")).alias("datetime"),
    )


def behavior(spark: SparkSession, folder: str, legal_only: bool = True) -> DataFrame:
    return behavior_from_events(open_events(spark, folder), legal_only)


def dirty_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Events as landed text with repeated rows, blank users and missing items."""
    events = open_events(spark, folder)
    copies = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    # parsed inside the generator, so that no later filter repeats the parsing
    repeated = events.select("*", F.inline(F.array_repeat(F.struct(_item().alias("item_id")), copies)))
    marked = behavior_from_events(repeated, False, "event_id")
    texts = marked.select("event_id", *[F.col(name).cast("string").alias(name) for name in ODS_COLUMNS])
    return texts.select(
        F.when(F.col("event_id") % 97 == 0, "").otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 89 != 0, F.col("item_id")).alias("item_id"),
        *ODS_COLUMNS[2:],
    )


def sales_behavior(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a behaviour log for recommendations: customer, part and a fixed mapping of flags."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"
    )
    returned, status = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (
        F.when(returned == "R", "buy")
        .when((returned == "N") & (status == "F"), "cart")
        .when(returned == "A", "fav")
        .otherwise("pv")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), kind.alias("behavior_type")
    )


# Fixed value: the order status that stands for a paid order.
PAID_STATUS = "F"


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their status and a decimal amount."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("datetime"),
    )


def goods(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as the goods that events name: item_id and price."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    return parts.select(F.col("p_partkey").alias("item_id"), F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
