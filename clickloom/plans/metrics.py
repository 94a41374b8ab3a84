"""Traffic, conversion and category reports over a behaviour log.

Input columns: user_id, item_id, category_id, behavior_type, datetime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.behavior import (
    behavior_col,
    behavior_name,
    behavior_order,
    counters,
)
from clickloom.functions.rates import people_label, percent, points_label, ratio, ratio_or_zero
from clickloom.functions.time import day_of, hour_of
from clickloom.operators.cleaning import slice_condition
from clickloom.operators.ranking import preview, top_k
from clickloom.operators.rollup import people, people_with, total, user_rollup
from clickloom.schema import (
    BEHAVIORS,
    COUNT_FUNNEL_STAGES,
    DETAIL_ROWS,
    FUNNEL_LAYERS,
    FUNNEL_STAGES,
    MERGED_FUNNEL_STAGES,
    TRAFFIC_METRICS,
)


def _rows(df: DataFrame, names: list[str], rows: list[list[Column]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn each row of ``df`` into one row per entry of ``rows``: wide to long in place."""
    made = [F.struct(*[value.alias(name) for name, value in zip(names, row)]) for row in rows]
    return df.select(*keep, F.inline(F.array(*made)))


def _overall(df: DataFrame) -> DataFrame:
    return user_rollup(df).agg(
        total("actions").alias("actions"), people().alias("uv"), *[total(kind).alias(kind) for kind in BEHAVIORS]
    )


def overall_kpis(df: DataFrame) -> DataFrame:
    """total_records, uv, pv, fav_cnt, cart_cnt, buy_cnt, cart_rate, buy_rate."""
    return _overall(df).select(
        F.col("actions").alias("total_records"),
        "uv",
        "pv",
        F.col("fav").alias("fav_cnt"),
        F.col("cart").alias("cart_cnt"),
        F.col("buy").alias("buy_cnt"),
        ratio(F.col("cart"), F.col("pv"), 4).alias("cart_rate"),
        ratio(F.col("buy"), F.col("pv"), 4).alias("buy_rate"),
    )


def core_metrics(df: DataFrame) -> DataFrame:
    """pv, uv, fav, cart, buy, cart_rate, buy_rate, actions_per_user; zero where undefined."""
    return _overall(df).select(
        "pv",
        "uv",
        "fav",
        "cart",
        "buy",
        ratio_or_zero(F.col("cart"), F.col("pv")).alias("cart_rate"),
        ratio_or_zero(F.col("buy"), F.col("pv")).alias("buy_rate"),
        ratio_or_zero(F.col("actions"), F.col("uv")).alias("actions_per_user"),
    )


def demo_kpis(df: DataFrame) -> DataFrame:
    """Counts, three rates and per-user averages; zero where undefined."""
    return _overall(df).select(
        "pv",
        "uv",
        F.col("fav").alias("fav_cnt"),
        F.col("cart").alias("cart_cnt"),
        F.col("buy").alias("buy_cnt"),
        ratio_or_zero(F.col("cart"), F.col("pv")).alias("cart_rate"),
        ratio_or_zero(F.col("buy"), F.col("pv")).alias("buy_rate"),
        ratio_or_zero(F.col("buy"), F.col("cart")).alias("cart2buy_rate"),
        ratio_or_zero(F.col("actions"), F.col("uv")).alias("actions_per_user"),
        ratio_or_zero(F.col("pv"), F.col("uv")).alias("pv_per_user"),
    )


def real_kpis(df: DataFrame) -> DataFrame:
    """Counts, cart, fav and buy rate and page views per user; NULL where undefined."""
    return _overall(df).select(
        "pv",
        "uv",
        "fav",
        "cart",
        "buy",
        ratio(F.col("cart"), F.col("pv")).alias("cart_rate"),
        ratio(F.col("fav"), F.col("pv")).alias("fav_rate"),
        ratio(F.col("buy"), F.col("pv")).alias("buy_rate"),
        ratio(F.col("pv"), F.col("uv")).alias("pv_per_user"),
    )


def traffic(rollup: DataFrame, *keys: str) -> DataFrame:
    """pv, uv and buy_cnt per key from a rollup at these keys."""
    return rollup.groupBy(*keys).agg(
        F.sum("pv").alias("pv"), people().alias("uv"), F.sum("buy").alias("buy_cnt")
    )


def _by_hour(df: DataFrame, name: str) -> DataFrame:
    return df.select("user_id", "behavior_type", hour_of(F.col("datetime")).alias(name))


def hourly_traffic(df: DataFrame) -> DataFrame:
    """hour_of_day, pv, uv, buy_cnt."""
    rollup = user_rollup(_by_hour(df, "hour_of_day"), "hour_of_day")
    return traffic(rollup, "hour_of_day").orderBy("hour_of_day")


def hourly_long(df: DataFrame) -> DataFrame:
    """The hourly curve as (hour, metric, value)."""
    wide = traffic(user_rollup(_by_hour(df, "hour"), "hour"), "hour")
    labelled = wide.select("hour", *[F.col(name).alias(label) for name, label in TRAFFIC_METRICS.items()])
    return labelled.unpivot(["hour"], list(TRAFFIC_METRICS.values()), "metric", "value")


def hour_behavior(df: DataFrame) -> DataFrame:
    """Counts per hour and behaviour, in the order of behaviours."""
    grouped = _by_hour(df, "hour").groupBy("hour", "behavior_type").agg(F.count("*").alias("cnt"))
    named = grouped.select("hour", behavior_name(behavior_col()).alias("behavior_name"), "cnt", behavior_order(behavior_col()).alias("place"))
    return named.orderBy("place", "hour").drop("place")


def behavior_mix(df: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Counts per behaviour in the order of behaviours; optionally zero for absent ones."""
    counted = df.agg(*counters())
    rows = _rows(
        counted,
        ["behavior_type", "behavior_name", "cnt", "place"],
        [
            [F.lit(kind), behavior_name(F.lit(kind)), F.col(kind), F.lit(place)]
            for place, kind in enumerate(BEHAVIORS)
        ],
    )
    return (rows if fill_missing else rows.where(F.col("cnt") > 0)).orderBy("place")


def _funnel_users(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        people_with("pv").alias("pv_users"),
        people_with("cart", "fav").alias("intent_users"),
        people_with("buy").alias("buy_users"),
    )


def funnel_wide(df: DataFrame) -> DataFrame:
    """pv_users, intent_users, buy_users, from one scan and one shuffle."""
    return _funnel_users(user_rollup(df))


def funnel_long(df: DataFrame) -> DataFrame:
    """layer_name, user_cnt, pct_of_pv."""
    return funnel_layers(user_rollup(df))


def funnel_layers(rollup: DataFrame) -> DataFrame:
    return funnel_of(_funnel_users(rollup))


def funnel_of(users: DataFrame) -> DataFrame:
    """The three layers from one row (pv_users, intent_users, buy_users)."""
    steps = zip(FUNNEL_LAYERS, ("pv_users", "intent_users", "buy_users"))
    return _rows(
        users,
        ["layer_name", "user_cnt", "pct_of_pv"],
        [[F.lit(name), F.col(c), percent(F.col(c), F.col("pv_users"), 2)] for name, c in steps],
    )


def funnel_rates(df: DataFrame) -> DataFrame:
    """stage, users, rate (of the first stage, zero where undefined) and printable label."""
    steps = list(zip(FUNNEL_STAGES, ("pv_users", "intent_users", "buy_users")))
    rows = []
    for place, (name, column) in enumerate(steps):
        share = F.lit(1.0) if place == 0 else ratio_or_zero(F.col(column), F.col("pv_users"))
        label = people_label(F.col(column), None if place == 0 else share)
        rows.append([F.lit(name), F.col(column), share, label])
    return _rows(funnel_wide(df), ["stage", "users", "rate", "label"], rows)


def count_funnel(df: DataFrame, merged: bool = False) -> DataFrame:
    """Funnel by number of actions: four stages, or three with favourites and carts together."""
    if merged:
        values = [F.col("pv"), F.col("fav") + F.col("cart"), F.col("buy")]
        steps = list(zip(MERGED_FUNNEL_STAGES, values))
    else:
        steps = [(label, F.col(kind)) for label, kind in COUNT_FUNNEL_STAGES]
    rows = [[F.lit(place), F.lit(name), value] for place, (name, value) in enumerate(steps, 1)]
    return _rows(df.agg(*counters()), ["place", "stage", "cnt"], rows)


def category_top(df: DataFrame, top_n: int | None = 10, min_pv: int = 100) -> DataFrame:
    """category_id, pv, buy_cnt, buy_rate of the categories with more than ``min_pv`` views."""
    return category_heat(df, top_n, min_pv).withColumn("buy_rate", F.round("buy_rate", 4))


def category_heat(df: DataFrame, top_n: int | None = 10, min_pv: int = 100) -> DataFrame:
    """The same with the rate as it is."""
    grouped = df.groupBy("category_id").agg(
        F.count_if(behavior_col() == "pv").alias("pv"), F.count_if(behavior_col() == "buy").alias("buy_cnt")
    )
    rated = grouped.where(F.col("pv") > min_pv).withColumn("buy_rate", ratio(F.col("buy_cnt"), F.col("pv")))
    return top_k(rated, top_n, ["pv"], "category_id")


def top_buyers(df: DataFrame, top_n: int = 10) -> DataFrame:
    """user_id, total_actions, buy_cnt."""
    per_user = user_rollup(df).select("user_id", F.col("actions").alias("total_actions"), F.col("buy").alias("buy_cnt"))
    return top_k(per_user, top_n, ["buy_cnt", "total_actions"], "user_id")


def pivot_counts(df: DataFrame, key: str, column: str, values) -> DataFrame:
    """Counts per key with one column per value, zero where absent; one shuffle."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == value).alias(str(value)) for value in values])


def user_behavior_table(df: DataFrame) -> DataFrame:
    """One row per user, one column per behaviour."""
    return pivot_counts(df, "user_id", "behavior_type", BEHAVIORS)


def behavior_stack(df: DataFrame) -> DataFrame:
    """Stacked bars per user: each behaviour's count and the sum of those below it.

    The counts of a user are already in one row, so the running sum needs no window."""
    rows, below = [], F.lit(0).cast("bigint")
    for kind in BEHAVIORS:
        rows.append([F.lit(kind), F.col(kind), below])
        below = below + F.col(kind)
    return _rows(user_behavior_table(df), ["behavior_type", "cnt", "bottom"], rows, keep=("user_id",))


def buy_detail(df: DataFrame) -> DataFrame:
    return df.where(behavior_col() == "buy").select("user_id", "item_id", "category_id", "datetime")


def detail_preview(df: DataFrame, rows: int = DETAIL_ROWS) -> DataFrame:
    """The first rows of a slice for display, with behaviour names."""
    named = df.select("user_id", "item_id", "category_id", behavior_name(behavior_col()).alias("behavior_name"), "datetime")
    return preview(named, rows, ["user_id", "datetime", "item_id", "behavior_name"])


def _slice_and_whole(df: DataFrame, inside: Column) -> DataFrame:
    """Counters of a slice (``cur_*``) and of the whole log (``base_*``) from one scan."""
    per_user = df.groupBy("user_id").agg(*counters(prefix="base_"), *counters(inside, "cur_"))
    known = F.col("user_id").isNotNull()
    sums = [
        F.coalesce(F.sum(f"{side}{name}"), F.lit(0)).alias(f"{side}{name}")
        for side in ("base_", "cur_")
        for name in ("actions", *BEHAVIORS)
    ]
    return per_user.agg(
        *sums,
        F.count("user_id").alias("base_uv"),
        F.count_if(known & (F.col("cur_actions") > 0)).alias("cur_uv"),
    )


def kpi_delta(df: DataFrame, hours=None, behaviors=None) -> DataFrame:
    """Slice against the whole log: counts, rates and the difference in percentage points.

    Rates and differences are NULL when the slice has no page views."""
    both = _slice_and_whole(df, slice_condition(hours, behaviors))
    picked = [F.col(f"cur_{name}").alias(name) for name in ("pv", "uv", "cart", "buy")]
    rates = []
    for kind in ("cart", "buy"):
        current = ratio(F.col(f"cur_{kind}"), F.col("cur_pv"))
        base = ratio_or_zero(F.col(f"base_{kind}"), F.col("base_pv"))
        points = (current - base) * 100
        rates += [
            current.alias(f"{kind}_rate"),
            base.alias(f"base_{kind}_rate"),
            points.alias(f"{kind}_rate_delta"),
            points_label(points).alias(f"{kind}_rate_label"),
        ]
    return both.select(*picked, *rates)


def slice_coverage(df: DataFrame, hours=None, behaviors=None) -> DataFrame:
    """Rows in the slice, rows in all and their share."""
    inside = slice_condition(hours, behaviors)
    counted = df.agg(F.count_if(inside).alias("rows_hit"), F.count("*").alias("row_cnt"))
    return counted.withColumn("share", ratio(F.col("rows_hit"), F.col("row_cnt")))


def gmv_daily(orders: DataFrame, paid: str = "paid") -> DataFrame:
    """dt, gmv, order_cnt, pay_users, avg_order_value from paid orders.

    Input columns: order_id, user_id, amount (decimal), status, datetime. Rows are combined per (day, order,
    user), the first row of an order counts for it, and then per (day, user)."""
    rows = orders.where(F.col("status") == paid).groupBy(day_of(F.col("datetime")).alias("dt"), "order_id", "user_id")
    first = F.row_number().over(Window.partitionBy("dt", "order_id").orderBy("user_id")) == 1
    counted = rows.agg(F.sum("amount").alias("gmv")).withColumn("orders", (first & F.col("order_id").isNotNull()).cast("int"))
    per_user = counted.groupBy("dt", "user_id").agg(F.sum("gmv").alias("gmv"), F.sum("orders").alias("orders"))
    summed = per_user.groupBy("dt").agg(
        F.sum("gmv").alias("gmv"), F.sum("orders").alias("order_cnt"), F.count("user_id").alias("pay_users")
    )
    return summed.withColumn("avg_order_value", F.round(F.col("gmv") / F.col("pay_users"), 2))


