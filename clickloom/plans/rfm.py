"""Recency, frequency, breadth: buyer scores and segments."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.behavior import behavior_col
from clickloom.functions.rates import people_label, percent, ratio
from clickloom.functions.rfm import is_key_segment, recency_score, segment, segment_order, volume_score
from clickloom.functions.time import whole_hours_between


def rfm_users(df: DataFrame) -> DataFrame:
    """Buyers with r_hours, f_cnt, m_items, their scores and segment.

    Recency counts back from the newest event of any kind, a scalar subquery. Purchases are
    combined per (user, item) first, so a heavy buyer's distinct items are counted in parallel."""
    window_end = df.select(F.max("datetime")).scalar()
    per_item = (
        df.where((behavior_col() == "buy") & F.col("user_id").isNotNull())
        .groupBy("user_id", "item_id")
        .agg(F.max("datetime").alias("last_buy"), F.count("*").alias("buys"))
    )
    buyers = per_item.groupBy("user_id").agg(
        F.max("last_buy").alias("last_buy"),
        F.sum("buys").alias("f_cnt"),
        F.count("item_id").alias("m_items"),
    )
    aged = buyers.select("user_id", whole_hours_between(F.col("last_buy"), window_end).alias("r_hours"), "f_cnt", "m_items")
    scored = aged.withColumns(
        {
            "r_score": recency_score(F.col("r_hours")),
            "f_score": volume_score(F.col("f_cnt")),
            "m_score": volume_score(F.col("m_items")),
        }
    )
    return scored.withColumn("customer_layer", segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def _sized(df: DataFrame) -> DataFrame:
    sizes = rfm_users(df).groupBy("customer_layer").agg(F.count("*").alias("user_cnt"))
    # at most eight rows reach this window
    return sizes.withColumn("buyers", F.sum("user_cnt").over(Window.partitionBy()))


def rfm_segments(df: DataFrame) -> DataFrame:
    """customer_layer, user_cnt, pct with one decimal, largest first."""
    sized = _sized(df)
    shared = sized.select("customer_layer", "user_cnt", percent(F.col("user_cnt"), F.col("buyers"), 1).alias("pct"))
    return shared.orderBy(F.desc("user_cnt"), F.asc("customer_layer"))


def rfm_report(df: DataFrame) -> DataFrame:
    """customer_layer, user_cnt, pct as a fraction, is_key, label, in business order.

    Without buyers the result is empty and keeps its columns."""
    share = ratio(F.col("user_cnt"), F.col("buyers"))
    return (
        _sized(df)
        .orderBy(segment_order(F.col("customer_layer")))
        .select(
            "customer_layer",
            "user_cnt",
            share.alias("pct"),
            is_key_segment(F.col("customer_layer")).alias("is_key"),
            people_label(F.col("user_cnt"), share).alias("label"),
        )
    )
