"""Layered warehouse: landing (ODS), detail (DWD), daily summary (DWS) and report tables (ADS)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.behavior import behavior_col
from clickloom.functions.rates import rate_decimal
from clickloom.functions.time import hour_of
from clickloom.operators.cleaning import to_dwd, to_ods
from clickloom.operators.quality import compare_grouped
from clickloom.operators.ranking import top_k
from clickloom.operators.rollup import people, people_with, regroup, user_rollup
from clickloom.plans.metrics import category_heat, funnel_layers, traffic
from clickloom.sources.tables import write_partitioned, write_table


def hourly_rollup(dwd: DataFrame) -> DataFrame:
    """(dt, hour, user) counters: the one pass over detail that DWS, hourly report and funnel share."""
    keyed = dwd.select("dt", "user_id", "behavior_type", hour_of(F.col("datetime")).alias("hour"))
    return user_rollup(keyed, "dt", "hour")


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    """Daily summary from a rollup at (dt, user)."""
    counted = rollup.groupBy("dt").agg(
        F.sum("pv").alias("pv"),
        people().alias("uv"),
        F.sum("fav").alias("fav_cnt"),
        F.sum("cart").alias("cart_cnt"),
        F.sum("buy").alias("buy_cnt"),
        people_with("buy").alias("buy_users"),
    )
    return counted.withColumns(
        {
            "cart_rate": rate_decimal(F.col("cart_cnt"), F.col("pv")),
            "buy_rate": rate_decimal(F.col("buy_cnt"), F.col("pv")),
            "cart2buy_rate": rate_decimal(F.col("buy_cnt"), F.col("cart_cnt")),
        }
    )


def daily_metrics(dwd: DataFrame) -> DataFrame:
    """DWS: dt, pv, uv, fav_cnt, cart_cnt, buy_cnt, buy_users, cart_rate, buy_rate, cart2buy_rate."""
    return daily_from_rollup(user_rollup(dwd, "dt"))


def rated_hours(rollup: DataFrame, *keys: str) -> DataFrame:
    rated = traffic(rollup, *keys)
    return rated.withColumn("buy_rate", rate_decimal(F.col("buy_cnt"), F.col("pv")))


def ads_hourly(dwd: DataFrame, by_day: bool = True) -> DataFrame:
    """ADS: [dt,] hour, pv, uv, buy_cnt, buy_rate."""
    keys = ("dt", "hour") if by_day else ("hour",)
    keyed = dwd.select(*keys[:-1], "user_id", "behavior_type", hour_of(F.col("datetime")).alias("hour"))
    return rated_hours(user_rollup(keyed, *keys), *keys)


def ads_category(dwd: DataFrame, top_n: int | None = 20, min_pv: int = 100) -> DataFrame:
    """ADS: category_id, pv, buy_cnt, buy_rate."""
    ranked = category_heat(dwd, None, min_pv)
    rated = ranked.withColumn("buy_rate", rate_decimal(F.col("buy_cnt"), F.col("pv")))
    return top_k(rated, top_n, ["pv"], "category_id")


def ads_funnel(dwd: DataFrame) -> DataFrame:
    """ADS: layer_name, user_cnt, pct_of_pv."""
    return funnel_layers(user_rollup(dwd))


def reconcile_hours(source: DataFrame, dwd: DataFrame) -> DataFrame:
    """Page views per hour by the source's own datetime against the derived one."""

    def views(df, moment):
        return df.where(behavior_col() == "pv").groupBy(hour_of(moment).alias("hour")).agg(F.count("*").alias("cnt"))

    return compare_grouped(
        views(source, F.col("datetime")), views(dwd, F.col("datetime")), ["hour"], ["cnt"]
    )


LAYERS = ("ods", "dwd", "rollup", "dws", "ads_hourly", "ads_category", "ads_funnel")


def build_warehouse(raw: DataFrame, root: str) -> dict[str, str]:
    """Write all layers below ``root``; each layer reads only what the layer before it wrote."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in LAYERS}
    ods = write_table(to_ods(raw), paths["ods"])
    dwd = write_partitioned(to_dwd(ods), paths["dwd"], "dt", sort_by=["user_id", "datetime"])
    rollup = write_table(hourly_rollup(dwd), paths["rollup"])
    reports = {
        "dws": daily_from_rollup(regroup(rollup, "dt")),
        "ads_hourly": rated_hours(rollup, "dt", "hour"),
        "ads_category": ads_category(dwd),
        "ads_funnel": funnel_layers(regroup(rollup)),
    }
    # independent jobs share the executors instead of waiting for each other's last task
    with ThreadPoolExecutor(len(reports)) as pool:
        written = [pool.submit(write_table, report, paths[name]) for name, report in reports.items()]
    for job in written:
        job.result()
    return paths
