import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from clickloom.operators import quality
from tests.conftest import rows_of


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (2, "a")], "a int, b string")
    assert rows_of(quality.missing_counts(df)) == [("a", 1), ("b", 2)]
    assert rows_of(quality.duplicate_count(df)) == [(4, 1)]
    assert rows_of(quality.duplicate_count(df.limit(0))) == [(0, 0)]


def test_line_audit_wants_exactly_five_fields(spark):
    lines = ["1,2,3,pv,4", "1,2,3,pv,4 ", "1,2,3,buy,4", "1,2,3,pv", "1,2,3,pv,4,5", "", ",,,pv,"]
    found = quality.audit_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert rows_of(found) == [("buy", 1, 4), ("pv", 3, 4)]


def check_description(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    row = quality.describe_values(df, ["v"]).first()
    known = [v for v in values if v is not None]
    assert row["count"] == len(known)
    assert [row["min"], row["p25"], row["p50"], row["p75"], row["max"]] == pytest.approx(
        [min(known), *np.percentile(known, [25, 50, 75]), max(known)]
    )
    assert row["mean"] == pytest.approx(np.mean(known))
    if len(known) > 1:
        assert row["std"] == pytest.approx(np.std(known, ddof=1))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=1, max_size=50).filter(lambda v: any(x is not None for x in v)))
def test_description_of_few_values(spark, values):
    check_description(spark, values)


def test_description_of_many_values_with_a_hot_one(spark):
    rng = np.random.default_rng(3)
    few, many = rng.integers(0, 10**9, 40_000), rng.integers(-(10**9), 10**9, 160_000)
    check_description(spark, [7] * 20_000 + few.tolist())
    check_description(spark, [7] * 60_000 + many.tolist())


def test_description_of_a_million_rows_with_a_hot_value(spark):
    n = 1_200_000
    df = spark.range(n).selectExpr("IF(id % 3 = 0, 7, pmod(id * 7919, 1000003) - 400000) AS v", "IF(id < 2, id, NULL) AS w")
    found = {row["column_name"]: row for row in quality.describe_values(df, ["v", "w"]).collect()}
    ids = np.arange(n)
    values = np.where(ids % 3 == 0, 7, ids * 7919 % 1000003 - 400000)
    assert [found["v"][f"p{p}"] for p in (25, 50, 75)] == np.percentile(values, [25, 50, 75]).tolist()
    assert [found["w"][f"p{p}"] for p in (25, 50, 75)] == [0.25, 0.5, 0.75]


def test_large_ids_beside_fractions_keep_their_digits(spark):
    df = spark.createDataFrame([(2**60 + 1, 0.5)], "a long, b double")
    assert quality.describe_values(df, ["a", "b"]).where("column_name = 'a'").first()["mean"] == 2.0**60
    assert quality.describe_values(df.limit(0), ["a", "b"]).isEmpty()


def test_profile_and_audit_never_multiply_rows(spark):
    log = spark.createDataFrame(
        [(1, 5, 1, "pv", 9, "2024-01-01 00:00:00"), (1, 6, None, "pv", 9, "2024-01-01 00:30:00")],
        "user_id long, item_id long, category_id long, behavior_type string, timestamp long, datetime string",
    ).withColumn("datetime", F.col("datetime").cast("timestamp"))
    profile = quality.clean_profile(log)
    assert profile.first()[-3:] == (1, 2, 1)
    landed = spark.createDataFrame(
        [("1", "2", "3", "pv", "4"), ("1", "2", "3", "pv", "4"), ("1", "x", "3", "pv", "4"), ("", "2", "3", "pv", "4"), ("1", "2", "3", None, "4")],
        "user_id string, item_id string, category_id string, behavior_type string, timestamp string",
    )
    audit = quality.layer_audit(landed)
    assert rows_of(audit) == [(5, 1, 4)]
    assert rows_of(quality.layer_audit(landed.limit(0))) == [(0, 0, 0)]
    for df in (profile, audit):
        assert "Expand" not in df._jdf.queryExecution().toString()


def test_brackets_are_used_and_hold_for_many_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "SKETCH_ACCURACY", 2_000)
    rng = np.random.default_rng(5)
    check_description(spark, rng.integers(0, 50, 60_000).tolist())
    check_description(spark, [1] * 40_000 + rng.integers(0, 10**6, 20_001).tolist())


def test_description_of_doubles_and_several_columns(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None)], "a long, b double")
    found = {row["column_name"]: row for row in quality.describe_values(df, ["a", "b"]).collect()}
    assert found["a"]["p50"] == 2.0 and found["b"]["p50"] == 1.0 and found["b"]["count"] == 2


def test_frame_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    assert rows_of(quality.frame_difference(a, b)) == [(1, 1), (3, -1)]
    assert quality.frame_difference(a, a).isEmpty()


def test_compare_grouped_is_null_safe(spark):
    a = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, v int")
    b = spark.createDataFrame([(1, None), (2, 6), (4, 1)], "k int, v int")
    compared = quality.compare_grouped(a, b, ["k"], ["v"])
    assert rows_of(compared, "k", "matches") == [(1, True), (2, False), (3, False), (4, False)]
    assert quality.mismatches(compared).count() == 3


def test_empty_load_fails(spark):
    with pytest.raises(quality.EmptyLoadError):
        quality.require_rows(spark.createDataFrame([], "behavior_type string"))


def test_load_report_is_ordered(spark):
    df = spark.createDataFrame([("pv",), ("pv",), ("buy",), ("cart",)], "behavior_type string")
    assert [tuple(row) for row in quality.load_verification(df).collect()] == [("pv", 2, 4), ("buy", 1, 4), ("cart", 1, 4)]
