"""The ten-row sample with known results, and the decisions on zero, rounding and ties."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickloom.operators import cleaning, windows
from clickloom.plans import metrics, rfm, warehouse
from tests.conftest import rows_of

# user, item, category, code, epoch seconds
SAMPLE = [
    (1001, 201, 11, 1, 1611111110),
    (1002, 202, 12, 1, 1611111220),
    (1001, 203, 13, 4, 1611111330),
    (1003, 201, 11, 1, 1611111440),
    (1002, 204, 14, 3, 1611111550),
    (1004, 205, 15, 1, 1611111660),
    (1003, 202, 12, 4, 1611111770),
    (1001, 204, 14, 2, 1611111880),
    (1005, 206, 16, 1, 1611111990),
    (1004, 203, 13, 4, 1611112100),
]


@pytest.fixture
def sample(spark):
    df = spark.createDataFrame(SAMPLE, "user_id long, item_id long, category_id long, behavior_type int, timestamp long")
    return cleaning.with_datetime(cleaning.with_named_codes(df))


def test_sample_kpis(sample):
    row = metrics.demo_kpis(sample).first()
    assert (row["pv"], row["uv"], row["fav_cnt"], row["cart_cnt"], row["buy_cnt"]) == (5, 5, 1, 1, 3)
    assert (row["cart_rate"], row["buy_rate"], row["cart2buy_rate"]) == (0.2, 0.6, 3.0)
    assert (row["actions_per_user"], row["pv_per_user"]) == (2.0, 1.0)


def test_sample_funnel_and_hours(sample):
    assert rows_of(metrics.funnel_wide(sample)) == [(5, 2, 3)]
    assert rows_of(metrics.hourly_traffic(sample)) == [(2, 3, 3, 1), (3, 2, 4, 2)]
    assert rows_of(metrics.funnel_long(sample)) == [("1-浏览", 5, 100.0), ("2-加购或收藏", 2, 40.0), ("3-购买", 3, 60.0)]


def test_sample_windows(sample):
    found = rows_of(windows.tumbling_windows(sample), "window", "pv", "uv", "cart", "buy")
    assert found == [
        ("02:50~02:55", 2, 2, 0, 0),
        ("02:55~03:00", 1, 3, 1, 1),
        ("03:00~03:05", 1, 3, 0, 1),
        ("03:05~03:10", 1, 2, 0, 1),
    ]


def test_sample_segments(sample):
    users = rows_of(rfm.rfm_users(sample), "user_id", "r_hours", "f_cnt", "m_items")
    assert users == [(1001, 0, 1, 1), (1003, 0, 1, 1), (1004, 0, 1, 1)]
    assert rows_of(rfm.rfm_segments(sample)) == [("一般发展客户", 3, 100.0)]


def test_sample_is_outside_the_cleaning_range(sample):
    assert cleaning.clean_behavior(sample.drop("datetime")).count() == 0


def test_zero_denominators(log):
    no_views = log([(1, 1, 1, "buy", 0), (1, 1, 1, "cart", 0)])
    plain = metrics.overall_kpis(no_views).first()
    assert plain["cart_rate"] is None and plain["buy_rate"] is None and plain["pv"] == 0
    safe = metrics.core_metrics(no_views).first()
    assert safe["cart_rate"] == 0.0 and safe["actions_per_user"] == 2.0
    assert metrics.real_kpis(no_views).first()["fav_rate"] is None
    assert rows_of(metrics.funnel_rates(no_views), "users", "rate") == [(0, 1.0), (1, 0.0), (1, 0.0)]
    assert warehouse.daily_metrics(no_views.withColumn("dt", F.lit("d"))).first()["buy_rate"] is None


def test_empty_input_counts_zero(log):
    row = metrics.overall_kpis(log([])).first()
    assert (row["total_records"], row["uv"], row["pv"]) == (0, 0, 0)
    assert metrics.core_metrics(log([])).first()["actions_per_user"] == 0.0
    assert metrics.kpi_delta(log([]), (0, 1)).first()["cart_rate_delta"] is None
    assert metrics.slice_coverage(log([])).first()["share"] is None


def test_rates_round_half_up(log):
    df = log([(1, 1, 1, "pv", 0)] * 800 + [(1, 1, 1, "buy", 0)] * 57)
    assert metrics.overall_kpis(df).first()["buy_rate"] == 0.0713
    daily = warehouse.daily_metrics(df.withColumn("dt", F.lit("2024-01-01"))).first()
    assert daily["buy_rate"] == Decimal("0.0713") and daily["cart2buy_rate"] is None


def test_missing_users_are_not_users(log):
    df = log([(None, 1, 1, "pv", 0), (None, 2, 1, "buy", 0), (1, 1, 1, "pv", 0)])
    assert metrics.overall_kpis(df).first()["uv"] == 1
    assert rows_of(metrics.funnel_wide(df)) == [(1, 0, 0)]
    assert metrics.overall_kpis(df).first()["total_records"] == 3


def test_category_threshold_is_strict_and_ties_go_to_the_lower_id(log):
    rows = [(1, 1, cat, "pv", 0) for cat, n in ((1, 100), (2, 101), (4, 102), (3, 102)) for _ in range(n)]
    found = [row["category_id"] for row in metrics.category_top(log(rows)).collect()]
    assert found == [3, 4, 2]
    assert [row["category_id"] for row in metrics.category_top(log(rows), top_n=1).collect()] == [3]


def test_top_buyers_order(log):
    rows = [(5, 1, 1, "buy", 0), (4, 1, 1, "buy", 0), (4, 1, 1, "pv", 0), (3, 1, 1, "buy", 0), (9, 1, 1, "pv", 0)]
    found = [tuple(row) for row in metrics.top_buyers(log(rows), 3).collect()]
    assert found == [(4, 2, 1), (3, 1, 1), (5, 1, 1)]


def test_stack_is_a_running_sum(log):
    df = log([(1, 1, 1, kind, 0) for kind in ("pv", "pv", "cart", "buy")])
    assert [tuple(row) for row in metrics.behavior_stack(df).collect()] == [
        (1, "pv", 2, 0),
        (1, "fav", 0, 2),
        (1, "cart", 1, 2),
        (1, "buy", 1, 3),
    ]


def test_mix_can_show_absent_behaviours(log):
    df = log([(1, 1, 1, "buy", 0), (1, 1, 1, "pv", 0)])
    assert [row["behavior_type"] for row in metrics.behavior_mix(df).collect()] == ["pv", "buy"]
    filled = [(row["behavior_type"], row["cnt"]) for row in metrics.behavior_mix(df, True).collect()]
    assert filled == [("pv", 1), ("fav", 0), ("cart", 0), ("buy", 1)]


def test_delta_compares_slice_and_whole(log):
    df = log([(1, 1, 1, "pv", 0), (1, 1, 1, "buy", 0), (2, 1, 1, "pv", 3600)])
    row = metrics.kpi_delta(df, (0, 0)).first()
    assert (row["pv"], row["uv"], row["buy_rate"], row["base_buy_rate"]) == (1, 1, 1.0, 0.5)
    assert row["buy_rate_delta"] == 50.0 and row["buy_rate_label"] == "+50.00pct"
    hidden = metrics.kpi_delta(df, None, ["buy"]).first()
    assert hidden["buy_rate"] is None and hidden["buy_rate_delta"] is None and hidden["buy_rate_label"] is None


def test_gmv_counts_orders_and_buyers_once(spark):
    rows = [
        (1, 7, Decimal("10.00"), "paid", "2024-01-01 10:00:00"),
        (2, 7, Decimal("5.01"), "paid", "2024-01-01 23:59:59"),
        (3, 8, Decimal("0.02"), "paid", "2024-01-01 00:00:00"),
        (4, 9, Decimal("99.00"), "open", "2024-01-01 00:00:00"),
    ]
    orders = spark.createDataFrame(rows, "order_id long, user_id long, amount decimal(18,2), status string, datetime string")
    row = metrics.gmv_daily(orders.withColumn("datetime", F.to_timestamp("datetime"))).first()
    assert (str(row["dt"]), row["gmv"], row["order_cnt"], row["pay_users"]) == ("2024-01-01", Decimal("15.03"), 3, 2)
    assert row["avg_order_value"] == Decimal("7.52")


def test_labels_have_separators(log):
    df = log([(user, 1, 1, "pv", 0) for user in range(1234)] + [(1, 1, 1, "buy", 0)])
    labels = rows_of(metrics.funnel_rates(df), "stage", "label")
    assert labels[0][1] == "1,234 人" and labels[2][1] == "1 人（0.1%）"


@pytest.mark.parametrize(
    "seconds, hours, score",
    [(0, 0, 5), (3600, 1, 5), (7199, 1, 5), (7200, 2, 4), (3 * 3600, 3, 4), (6 * 3600 + 1800, 6, 3), (9 * 3600, 9, 2), (10 * 3600, 10, 1)],
)
def test_recency_is_cut_to_whole_hours(log, seconds, hours, score):
    df = log([(1, 1, 1, "buy", 100_000 - seconds), (2, 1, 1, "pv", 100_000)])
    row = rfm.rfm_users(df).first()
    assert (row["r_hours"], row["r_score"]) == (hours, score)


def test_volume_scores_and_all_segments(log):
    # user -> (hours before the end, purchases, distinct items)
    wanted = {
        1: (0, 5, 5, "重要价值客户"),
        3: (20, 3, 2, "重要保持客户"),
        5: (0, 2, 1, "一般价值客户"),
        6: (0, 1, 1, "一般发展客户"),
        7: (20, 2, 1, "一般保持客户"),
        8: (20, 1, 1, "一般挽留客户"),
    }
    end, rows = 1_000_000, [(99, 1, 1, "pv", 1_000_000)]
    for user, (hours, buys, items, _) in wanted.items():
        rows += [(user, i % items, 1, "buy", end - hours * 3600) for i in range(buys)]
    found = {row["user_id"]: row for row in rfm.rfm_users(log(rows)).collect()}
    assert {user: row["customer_layer"] for user, row in found.items()} == {u: w[3] for u, w in wanted.items()}
    assert [found[user]["f_score"] for user in (1, 3, 5, 6)] == [5, 4, 3, 2]
    report = rfm.rfm_report(log(rows)).collect()
    assert [row["is_key"] for row in report] == [True, True, False, False, False, False]
    assert report[0]["label"] == "1 人（16.7%）"
    assert sum(row["user_cnt"] for row in report) == len(wanted)


def test_segment_expression_covers_every_combination(spark):
    from clickloom.functions.rfm import segment, segment_order

    scores = [(r, f, m) for r in (2, 3) for f in (2, 3) for m in (2, 3)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    names = df.select(segment(F.col("r"), F.col("f"), F.col("m")).alias("name"))
    places = {row["place"] for row in names.select(segment_order(F.col("name")).alias("place")).collect()}
    assert places == set(range(8))


def test_no_buyers_gives_an_empty_report_with_columns(log):
    report = rfm.rfm_report(log([(1, 1, 1, "pv", 0)]))
    assert report.collect() == [] and report.columns == ["customer_layer", "user_cnt", "pct", "is_key", "label"]


def test_hourly_reconcile_marks_differences(log):
    source = log([(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 7200)])
    shifted = log([(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 3600)])
    compared = warehouse.reconcile_hours(source, shifted)
    assert rows_of(compared, "hour", "matches") == [(0, True), (1, False), (2, False)]
