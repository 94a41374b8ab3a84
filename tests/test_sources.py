import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.operators.quality import EmptyLoadError
from clickloom.plans import warehouse
from clickloom.schema import CLEAN_SCHEMA, ODS_SCHEMA
from clickloom.sources import files, tables
from tests.conftest import rows_of


def test_raw_csv_keeps_rows_with_bad_fields(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("1,2,3,pv,1511658000\n1,x,3,pv,1511658000\n,2,3,buy,1511658000\n1,2,3\n")
    rows = files.read_raw_log(spark, str(tmp_path / "raw.csv")).collect()
    assert [tuple(r) for r in rows] == [
        (1, 2, 3, "pv", 1511658000),
        (1, None, 3, "pv", 1511658000),
        (None, 2, 3, "buy", 1511658000),
        (1, 2, 3, None, None),
    ]


def test_clean_csv_roundtrip(spark, tmp_path, log):
    df = log([(1, 2, 3, "pv", 1511658000), (2, 2, 3, "buy", 1511658001)])
    files.write_csv(df, str(tmp_path / "clean"))
    back = files.read_clean_log(spark, str(tmp_path / "clean"))
    assert back.schema == CLEAN_SCHEMA and rows_of(back) == rows_of(df)


def test_sample_and_landing_readers(spark, tmp_path):
    (tmp_path / "s.csv").write_text("user_id,item_id,category_id,behavior_type,timestamp\n1001,201,11,4,1611111110\n")
    assert rows_of(files.read_sample_log(spark, str(tmp_path / "s.csv"))) == [(1001, 201, 11, 4, 1611111110)]
    landed = files.read_landing_log(spark, str(tmp_path / "s.csv"), header=True)
    assert landed.schema == ODS_SCHEMA and landed.first()["user_id"] == "1001"


def test_lines_and_report_file(spark, tmp_path):
    files.write_csv(spark.range(3).toDF("n"), str(tmp_path / "report"), single_file=True)
    assert len(list((tmp_path / "report").glob("part-*"))) == 1
    assert sorted(r["value"] for r in files.read_lines(spark, str(tmp_path / "report")).collect()) == ["0", "1", "2", "n"]


def test_export_has_five_columns(spark, tmp_path, log):
    files.export_detail(log([(1, 2, 3, "pv", 0)]).coalesce(1), str(tmp_path / "e"))
    lines = [r["value"] for r in files.read_lines(spark, str(tmp_path / "e")).collect()]
    assert lines == ["user_id,item_id,category_id,behavior_type,datetime", "1,2,3,pv,1970-01-01 00:00:00"]


def test_partition_overwrite_touches_only_given_days(spark, tmp_path):
    path = str(tmp_path / "dwd")
    both = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x long, dt string")
    tables.write_partitioned(both, path, "dt")
    back = tables.write_partitioned(both.where("dt = '2024-01-02'").withColumn("x", F.lit(9).cast("long")), path, "dt", ["x"])
    assert rows_of(back) == [(1, "2024-01-01"), (9, "2024-01-02")]
    assert back.schema["dt"].dataType.simpleString() == "string"


def test_hot_day_is_written_by_many_tasks_and_small_days_by_one(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(300_000).select(
            F.rand(1).alias("x"), F.when(F.col("id") >= 5000, "hot").otherwise((F.col("id") % 5).cast("string")).alias("dt")
        )
        tables.write_partitioned(df.repartition(8), str(tmp_path / "t"), "dt")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files_of = lambda day: len(list((tmp_path / "t" / f"dt={day}").glob("part-*")))
    assert files_of("hot") == 8 and all(files_of(day) == 1 for day in range(5))


def test_clean_table_is_ordered_within_files(spark, tmp_path, log):
    df = log([(user, 1, 1, "pv", stamp) for user in (3, 1, 2) for stamp in (5, 4)]).coalesce(1)
    back = tables.write_clean(df, str(tmp_path / "clean"))
    assert [(r["user_id"], r["timestamp"]) for r in back.collect()] == [(1, 4), (1, 5), (2, 4), (2, 5), (3, 4), (3, 5)]


def test_load_is_repeatable_and_verified(spark, tmp_path, log):
    path = str(tmp_path / "load")
    for _ in range(2):
        report = tables.load_and_verify(log([(1, 1, 1, "pv", 0), (1, 1, 1, "buy", 0)]), path)
    assert rows_of(report) == [("buy", 1, 2), ("pv", 1, 2)]
    with pytest.raises(EmptyLoadError):
        tables.load_and_verify(log([]), str(tmp_path / "none"))


def test_replace_table(spark):
    tables.replace_table(spark.range(3), "replaced")
    assert tables.replace_table(spark.range(2), "replaced").count() == 2
    assert rows_of(tables.read_table(spark, "replaced", ["id"])) == [(0,), (1,)]
    spark.sql("DROP TABLE replaced")


def test_first_available_skips_missing_and_empty(spark):
    missing = ("missing", lambda: spark.read.parquet("/tmp/clickloom-does-not-exist"))
    absent = ("absent table", lambda: spark.table("no_such_table"))
    empty = ("empty", lambda: spark.range(0))
    df, label = tables.first_available(missing, absent, empty, ("file", lambda: spark.range(1)))
    assert label == "file" and df.count() == 1
    with pytest.raises(FileNotFoundError, match="missing: PATH_NOT_FOUND; empty: no rows"):
        tables.first_available(missing, empty)


def test_warehouse_layers(spark, tmp_path):
    rows = [
        ("1", "10", "100", "pv", "1511658000"),
        ("1", "10", "100", "pv", "1511658000"),
        ("1", "10", "100", "buy", "1511658001"),
        ("2", "11", "100", "cart", "1511744400"),
        ("", "11", "100", "cart", "1511744400"),
    ]
    paths = warehouse.build_warehouse(spark.createDataFrame(rows, ODS_SCHEMA), str(tmp_path))
    read = lambda name: spark.read.parquet(paths[name])
    assert read("ods").count() == 5 and read("dwd").count() == 3
    assert sorted(p.name for p in (tmp_path / "dwd").glob("dt=*")) == ["dt=2017-11-26", "dt=2017-11-27"]
    assert rows_of(read("dws"), "dt", "pv", "uv", "buy_users") == [("2017-11-26", 1, 1, 1), ("2017-11-27", 0, 1, 0)]
    assert rows_of(read("ads_hourly"), "dt", "hour", "uv") == [("2017-11-26", 1, 1), ("2017-11-27", 1, 1)]
    assert rows_of(read("ads_funnel"), "user_cnt") == [(1,), (1,), (1,)]
    assert read("ads_category").count() == 0


def test_layers_from_the_shared_rollup_equal_the_direct_ones(spark, log):
    from clickloom.operators.cleaning import to_dwd, to_ods
    from clickloom.operators.rollup import regroup

    df = log([(i % 9, i % 4, i % 3, ("pv", "fav", "cart", "buy")[i % 4], i * 997) for i in range(400)])
    dwd = to_dwd(to_ods(df))
    rollup = warehouse.hourly_rollup(dwd)
    assert rows_of(warehouse.daily_from_rollup(regroup(rollup, "dt"))) == rows_of(warehouse.daily_metrics(dwd))


def test_shared_dir_comes_from_the_session(spark):
    wanted = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if wanted:
        assert session.shared_dir(spark) == wanted.rstrip("/")
    assert session.shared_path(spark, "a") != session.shared_path(spark, "a")


def test_shared_dir_without_a_setting_is_below_the_warehouse(spark):
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        assert session.shared_dir(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))
