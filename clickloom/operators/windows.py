"""Event-time windows over a behaviour log; the tumbling builder serves batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.behavior import behavior_col, counters
from clickloom.functions.rates import ratio
from clickloom.functions.time import plus_minutes, window_label
from clickloom.operators.rollup import COUNTERS, people

_DAY = 86400


def window_users(df: DataFrame, size: str, slide: str | None = None, time: str = "datetime") -> DataFrame:
    """One row per (window, user): the first half of an exact distinct count in batch and stream."""
    return df.groupBy(F.window(time, size, slide).alias("window"), "user_id").agg(*counters())


def fold_window_users(per_user: DataFrame) -> DataFrame:
    """(window, user) rows -> one row per window."""
    folded = per_user.groupBy("window").agg(
        people().alias("uv"), *[F.sum(name).alias(name) for name in COUNTERS]
    )
    return folded.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "pv",
        "uv",
        "cart",
        "buy",
        F.col("actions").alias("events"),
        ratio(F.col("buy"), F.col("actions")).alias("buy_rate"),
    )


def with_window_label(windows: DataFrame) -> DataFrame:
    return windows.withColumn("window", window_label(F.col("window_start"), F.col("window_end")))


def tumbling_windows(df: DataFrame, minutes: int = 5, time: str = "datetime") -> DataFrame:
    """window_start, window_end, window, pv, uv, cart, buy, events, buy_rate."""
    counted = with_window_label(fold_window_users(window_users(df, f"{minutes} minutes", time=time)))
    return counted.select(
        "window_start", "window_end", "window", "pv", "uv", "cart", "buy", "events", "buy_rate"
    )


def user_windows(df: DataFrame, minutes: int = 5, time: str = "datetime") -> DataFrame:
    """The same counters per window and user."""
    return window_users(df, f"{minutes} minutes", time=time).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "user_id",
        "pv",
        "cart",
        "buy",
        F.col("actions").alias("events"),
    )


def user_panes(df: DataFrame, slide_minutes: int, time: str = "datetime") -> DataFrame:
    """One row per (pane, user), a pane being one slide long; ``pane`` is its start in epoch seconds."""
    second, slide = F.unix_seconds(F.col(time)), F.lit(slide_minutes * 60)
    return df.select("user_id", "behavior_type", (second - F.pmod(second, slide)).alias("pane")).groupBy("pane", "user_id").agg(*counters())


def windows_of_panes(panes: DataFrame, size_minutes: int, slide_minutes: int) -> DataFrame:
    """(pane, user) rows -> start (epoch seconds), uv and the counters of all windows that hold a pane.

    A user's pane adds that user to the windows which no earlier pane of the same user reaches, a gap-free range that
    follows from the previous pane. Rows are then summed per (pane, first new window), at most
    panes x (size / slide) rows whatever the number of events, and only these are spread over the windows."""
    if size_minutes % slide_minutes:
        raise ValueError("the window size must be a multiple of the slide")
    slide, reach = slide_minutes * 60, (size_minutes - slide_minutes) * 60
    previous = F.lag("pane").over(Window.partitionBy("user_id").orderBy("pane"))
    oldest = F.col("pane") - reach
    first_new = F.greatest(oldest, F.coalesce(previous + slide, oldest))
    summed = (
        panes.withColumn("first_new", first_new)
        .groupBy("pane", "first_new")
        .agg(people().alias("users"), *[F.sum(name).alias(name) for name in COUNTERS])
    )
    spread = summed.withColumn("start", F.explode(F.sequence(oldest, F.col("pane"), F.lit(slide))))
    new_users = F.when(F.col("start") >= F.col("first_new"), F.col("users")).otherwise(0)
    return spread.groupBy("start").agg(F.sum(new_users).alias("uv"), *[F.sum(name).alias(name) for name in COUNTERS])


def without_gaps(found: DataFrame, size_minutes: int, slide_minutes: int) -> DataFrame:
    """Windows by ``start`` from the first pane on, those without events as zeros.

    Every window fills the gap up to the next one; the log is not asked again. One row for each window takes part, a
    number that depends on the time span alone. Gaps are cut into days, so a stray early event cannot build one huge array."""
    slide, reach = slide_minutes * 60, (size_minutes - slide_minutes) * 60
    order, all_rows = Window.orderBy("start"), Window.partitionBy()
    bounded = found.withColumn("last", F.coalesce(F.lead("start").over(order) - slide, F.col("start")))
    bounded = bounded.withColumn("low", F.min("start").over(all_rows) + reach)
    span = _DAY if _DAY % slide == 0 else slide * 1000
    days = bounded.withColumn("day", F.explode(F.sequence(F.col("start"), F.col("last"), F.lit(span))))
    filled = days.withColumn("at", F.explode(F.sequence(F.col("day"), F.least(F.col("day") + (span - slide), F.col("last")), F.lit(slide))))
    own = F.col("at") == F.col("start")
    return filled.where(F.col("at") >= F.col("low")).select(
        F.col("at").alias("start"), *[F.when(own, F.col(name)).otherwise(0).alias(name) for name in ("uv", *COUNTERS)]
    )


def named_windows(found: DataFrame, size_minutes: int) -> DataFrame:
    values = {"pv": "pv", "uv": "uv", "cart": "cart", "buy": "buy", "events": "actions"}
    begin = F.timestamp_seconds(F.col("start"))
    return found.select(
        begin.alias("window_start"),
        plus_minutes(begin, size_minutes).alias("window_end"),
        F.date_format(begin, "HH:mm").alias("window"),
        *[F.col(source).alias(name) for name, source in values.items()],
    )


def sliding_windows(df: DataFrame, size_minutes: int = 15, slide_minutes: int = 5, time: str = "datetime") -> DataFrame:
    """Sliding windows from the slide of the first event on, empty windows included, in one scan.

    Events are never copied into the windows they fall in: they are first combined to one row per (pane, user)."""
    found = windows_of_panes(user_panes(df, slide_minutes, time), size_minutes, slide_minutes)
    return named_windows(without_gaps(found, size_minutes, slide_minutes), size_minutes)


def turnover_windows(df: DataFrame, goods: DataFrame, minutes: int = 5, time: str = "datetime") -> DataFrame:
    """Purchases and their turnover per tumbling window, for batch and stream alike: window_start, window_end, buys, turnover, unpriced.

    ``goods`` (item_id, price) is the static side of the join and read again by every micro-batch; it has one row for an item. A
    purchase of an item without a price counts as ``unpriced`` and adds nothing. Amounts are decimals, so sums do not depend on order."""
    buys = df.where(behavior_col() == "buy").select(time, "item_id")
    priced = buys.join(goods.select("item_id", F.col("price").cast("decimal(18,2)").alias("price")), "item_id", "left")
    counted = priced.groupBy(F.window(time, f"{minutes} minutes").alias("window")).agg(
        F.count("*").alias("buys"), F.coalesce(F.sum("price"), F.lit(0).cast("decimal(28,2)")).alias("turnover"),
        F.count_if(F.col("price").isNull()).alias("unpriced"),
    )
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "buys", "turnover", "unpriced")


def peak_windows(windows: DataFrame) -> DataFrame:
    """The window of most page views and the one of most purchases, the earlier one on ties."""
    columns = ["window_start", "window", "pv", "uv", "buy"]

    def best(measure):
        earlier = -F.unix_seconds("window_start")
        return F.max(F.struct(F.col(measure).alias("top"), earlier.alias("earlier"), *columns))

    found = windows.agg(best("pv").alias("peak_pv"), best("buy").alias("busiest_buy"))
    rows = found.unpivot([], ["peak_pv", "busiest_buy"], "kind", "row")
    return rows.where(F.col("row").isNotNull()).select("kind", *[F.col(f"row.{name}").alias(name) for name in columns])


def time_span(df: DataFrame, time: str = "datetime") -> DataFrame:
    """Rows, first and last event time and the minutes between them."""
    return df.agg(
        F.count("*").alias("row_cnt"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        ((F.unix_seconds(F.max(time)) - F.unix_seconds(F.min(time))) / 60).alias("span_minutes"),
    )
