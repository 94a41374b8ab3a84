"""Layers that grow with the landing, and distinct users merged from parts."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import distinct
from clickloom.plans import incremental, warehouse
from clickloom.schema import ODS_COLUMNS
from tests.conftest import rows_of

DAY = 86400


def landed(spark, *rows):
    return spark.createDataFrame([tuple(map(str, row)) for row in rows], ", ".join(f"{name} string" for name in ODS_COLUMNS))


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


@pytest.fixture
def grow(spark, tmp_path):
    def run(*rows):
        if rows:
            landed(spark, *rows).write.mode("append").parquet(str(tmp_path / "landing"))
        return incremental.take_in(spark, str(tmp_path / "landing"), str(tmp_path / "layers"))

    return run


FIRST = [(1, 10, 5, "pv", 100), (1, 10, 5, "pv", 100), (2, 11, 5, "buy", 200), (3, 12, 6, "cart", DAY + 5), ("", 9, 9, "pv", 7), (4, 9, 9, "pv", "x")]
SECOND = [(3, 12, 6, "cart", DAY + 5), (2, 13, 6, "pv", DAY + 9), (5, 14, 7, "fav", 2 * DAY)]


def test_second_batch_rebuilds_its_days_alone_and_equals_a_full_build(spark, grow, tmp_path):
    assert grow(*FIRST) == ["1970-01-01", "1970-01-02"]
    before = files(tmp_path / "layers")
    assert grow(*SECOND) == ["1970-01-02", "1970-01-03"]
    after = files(tmp_path / "layers")
    first_day = {k for k in before if "dt=1970-01-01" in k}
    assert first_day and all(after.get(k) == before[k] for k in first_day)
    assert grow() == [] and files(tmp_path / "layers") == after  # nothing new landed

    full = warehouse.build_warehouse(landed(spark, *FIRST, *SECOND), str(tmp_path / "full"))
    for name in ("dwd", "rollup", "dws", "ads_hourly"):
        mine, whole = (spark.read.parquet(path) for path in (str(tmp_path / "layers" / name), full[name]))
        whole = whole.select(*[F.col(c).cast(mine.schema[c].dataType) for c in mine.columns])
        assert mine.exceptAll(whole).isEmpty() and whole.exceptAll(mine).isEmpty()
    funnel = incremental.funnel_report(spark, str(tmp_path / "layers"))
    assert rows_of(funnel) == rows_of(spark.read.parquet(full["ads_funnel"]))
    report = incremental.category_report(spark, str(tmp_path / "layers"), min_pv=0)
    assert rows_of(report, "category_id", "pv", "buy_cnt") == [(5, 1, 1), (6, 1, 0)]


def test_a_batch_without_its_manifest_is_taken_in_again(spark, grow, tmp_path):
    grow(*FIRST)
    import shutil

    shutil.rmtree(tmp_path / "layers" / "manifest")  # as if the job had ended just before
    assert grow() == ["1970-01-01", "1970-01-02"]
    assert spark.read.parquet(str(tmp_path / "layers" / "ods")).count() == len(FIRST)
    assert rows_of(incremental.manifest(spark, str(tmp_path / "layers")), "batch")[0] == (1,)


def test_merged_bitmaps_count_users_once(spark):
    rows = [(day, user, kind) for day in range(4) for user in (0, 1, 32768, 32769, 10**12 + day, None) for kind in ("pv", "buy") if user != 1 or kind == "pv"]
    log = spark.createDataFrame(rows, "day int, user_id long, behavior_type string")
    parts = distinct.bitmap_rollup(log, "day")
    assert rows_of(distinct.users_of_bitmaps(parts, "day", users=(), buyers=("buy",), none=("fav",))) == [(d, 5, 4, 0) for d in range(4)]
    assert rows_of(distinct.users_of_bitmaps(parts, users=(), buyers=("buy", "cart"))) == [(8, 7)]
    halves = distinct.merge_bitmaps(parts.withColumn("half", F.floor(F.col("day") / 2)), "half")
    assert rows_of(distinct.users_of_bitmaps(halves, "half", users=())) == [(0, 6), (1, 6)]
    assert rows_of(distinct.users_of_bitmaps(parts.where("day > 9"), users=())) == [(0,)]


def test_sketches_stay_within_their_error(spark):
    log = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("user_id"), F.lit("pv").alias("behavior_type"))
    found = distinct.users_of_sketches(distinct.sketch_rollup(log, "day")).first()["users"]
    assert abs(found - 20_000) / 20_000 < 5 * distinct.SKETCH_ERROR


def test_trailing_days_end_with_the_last_day(spark):
    parts = spark.createDataFrame([("2024-01-01",), ("2024-01-04",)], "dt string")
    assert rows_of(distinct.trailing_days(parts, 3), "dt", "until") == [
        ("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-01-02"), ("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-04"),
    ]
