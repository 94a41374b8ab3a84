from pyspark.sql import functions as F

from clickloom.operators import cleaning, quality
from clickloom.schema import ODS_SCHEMA, RAW_SCHEMA
from tests.conftest import rows_of

LOW, HIGH = 1511568000, 1512345600  # 2017-11-25 and 2017-12-04, midnight UTC


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def ods(spark, rows):
    return spark.createDataFrame(rows, ODS_SCHEMA)


DIRTY = [
    (1, 10, 100, "pv", LOW),  # first second of the range
    (1, 10, 100, "pv", LOW),  # exact copy
    (2, 10, 100, "buy", HIGH),  # first second after the range
    (3, 10, 100, "buy", HIGH - 1),
    (4, 10, 100, "click", LOW),  # no legal behaviour
    (None, 10, 100, "pv", LOW),
    (5, None, 100, "pv", LOW),
    (5, 10, None, "pv", LOW),
    (5, 10, 100, None, LOW),
    (5, 10, 100, "pv", None),
]


def test_clean_keeps_complete_legal_rows_in_range_once(spark):
    clean = cleaning.clean_behavior(raw(spark, DIRTY))
    assert rows_of(clean, "user_id", "timestamp") == [(1, LOW), (3, HIGH - 1)]


def test_clean_report_counts_each_step(spark):
    row = quality.clean_report(raw(spark, DIRTY)).first()
    kept = [row[n] for n in ("raw_rows", "after_missing", "after_enum", "after_range", "after_dedup")]
    assert kept == [10, 5, 4, 3, 2]
    gone = [row[n] for n in ("removed_missing", "removed_enum", "removed_range", "removed_dedup")]
    assert gone == [5, 1, 1, 1]
    assert row["retention"] == 0.2


def test_clean_report_of_nothing(spark):
    row = quality.clean_report(raw(spark, [])).first()
    assert row["raw_rows"] == 0 and row["after_dedup"] == 0 and row["retention"] is None


def test_report_agrees_with_the_cleaned_rows(spark):
    many = [(i % 7 or None, i % 3, 1, ["pv", "buy", "error"][i % 3], LOW + i % 20) for i in range(500)]
    source = raw(spark, many)
    assert quality.clean_report(source).first()["after_dedup"] == cleaning.clean_behavior(source).count()


def test_cleaning_is_idempotent(spark):
    once = cleaning.clean_behavior(raw(spark, DIRTY))
    again = cleaning.clean_behavior(once.drop("datetime"))
    assert rows_of(once) == rows_of(again)


def test_detail_deduplicates_text_before_typing(spark):
    rows = [
        ("1", "10", "100", "pv", "1511658000"),
        ("1", "10", "100", "pv", "1511658000"),
        ("01", "10", "100", "pv", "1511658000"),  # another text, so another row
        ("", "10", "100", "pv", "1511658000"),
        ("2", None, "100", "pv", "1511658000"),
        ("2", "10", "100", "pay", "1511658000"),
        ("2", "10", "100", "pv", ""),
        ("x", "10", "100", "pv", "1511658000"),  # no number
    ]
    detail = cleaning.to_dwd(ods(spark, rows))
    assert rows_of(detail) == [(1, 10, 100, "pv", "浏览", "2017-11-26 01:00:00", "2017-11-26")] * 2


def test_detail_names_all_behaviours(spark):
    rows = [("1", "1", "1", kind, "0") for kind in ("pv", "fav", "cart", "buy")]
    names = dict(rows_of(cleaning.to_dwd(ods(spark, rows)), "behavior_type", "behavior_name"))
    assert names == {"pv": "浏览", "fav": "收藏", "cart": "加购", "buy": "购买"}


def test_landing_changes_nothing_but_types(spark):
    landed = cleaning.to_ods(raw(spark, DIRTY))
    assert landed.schema == ODS_SCHEMA
    assert landed.count() == len(DIRTY)
    assert landed.where(F.col("user_id").isNull()).count() == 1


def test_slice_has_both_hours_and_empty_choice_means_all(log):
    df = log([(1, 1, 1, "pv", hour * 3600) for hour in range(24)] + [(1, 1, 1, "buy", 9 * 3600)])
    assert cleaning.slice_behavior(df, (8, 10)).count() == 4
    assert cleaning.slice_behavior(df, (8, 10), []).count() == 4
    assert cleaning.slice_behavior(df, (8, 10), ["buy"]).count() == 1
    assert cleaning.slice_behavior(df).count() == 25


def test_prepare_adds_hour_and_name(log):
    row = cleaning.prepare(log([(1, 1, 1, "cart", 5 * 3600 + 59)])).first()
    assert (row["hour"], row["behavior_name"]) == (5, "加购")


def test_codes_become_the_enum(spark):
    df = spark.createDataFrame([(code,) for code in (1, 2, 3, 4, 9)], "behavior_type int")
    kinds = [row[0] for row in cleaning.with_named_codes(df).collect()]
    assert kinds == ["pv", "fav", "cart", "buy", None]
