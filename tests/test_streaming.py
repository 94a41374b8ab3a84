import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom import catalog
from clickloom.operators import windows
from clickloom.schema import STREAM_SCHEMA
from clickloom.streaming import jobs
from clickloom.streaming.sources import decode_messages, json_stream, normalize
from tests.conftest import rows_of

START = datetime(2024, 1, 1)


def message(user, minutes, code=1, item="1"):
    at = START + timedelta(minutes=minutes)
    return {"user_id": user, "item_id": item, "category_id": "1", "behavior_type": code, "ts": at.strftime("%Y-%m-%dT%H:%M:%S.000Z")}


class Topic:
    """A folder that receives one file of messages per batch."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def send(self, *messages):
        (self.path / f"{self.n:03}.json").write_text("".join(json.dumps(m) + "\n" for m in messages))
        self.n += 1


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def run(spark, topic, tmp_path, name="out"):
    counted = jobs.stream_windows(json_stream(spark, str(topic.path)))
    query = jobs.start_to_table(counted, str(tmp_path / name), str(tmp_path / f"{name}-cp"), partitions=2)
    query.awaitTermination()
    return spark.read.schema(counted.schema).parquet(str(tmp_path / name)), query


def test_windows_close_behind_the_watermark_and_count_users_once(spark, topic, tmp_path):
    topic.send(message("a", 0), message("a", 1, 4), message("b", 2, 3), message("b", 6), message("c", 12))
    found, _ = run(spark, topic, tmp_path)
    rows = rows_of(found, "window_start", "pv", "uv", "cart", "buy", "events", "buy_rate")
    assert rows == [
        (START, 1, 2, 1, 1, 3, pytest.approx(1 / 3)),
        (START + timedelta(minutes=5), 1, 1, 0, 0, 1, 0.0),
    ]


def test_restart_continues_from_the_checkpoint(spark, topic, tmp_path):
    topic.send(message("a", 0), message("b", 3))
    found, _ = run(spark, topic, tmp_path)
    assert found.count() == 0  # the window is still open
    topic.send(message("a", 4), message("c", 11))
    found, _ = run(spark, topic, tmp_path)
    assert rows_of(found, "window_start", "uv", "events") == [(START, 2, 3)]
    topic.send(message("d", 30))
    found, _ = run(spark, topic, tmp_path)
    assert rows_of(found, "uv", "events") == [(1, 1), (2, 3)]


def test_late_row_is_dropped_and_reported(spark, topic, tmp_path):
    topic.send(message("a", 0), message("b", 20))
    run(spark, topic, tmp_path)
    topic.send(message("c", 1), message("b", 21))  # window 00:00 is closed by now
    found, query = run(spark, topic, tmp_path)
    assert rows_of(found, "window_start", "uv") == [(START, 1)]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped >= 1


def test_stream_equals_batch_for_closed_windows(spark, topic, tmp_path):
    rows = [message(f"u{i % 5}", i * 0.7, 1 + i % 4) for i in range(60)]
    topic.send(*rows[:25])
    topic.send(*rows[25:])
    streamed, _ = run(spark, topic, tmp_path)
    batch = normalize(spark.read.schema(STREAM_SCHEMA).json(str(topic.path)))
    compared = jobs.reconcile_windows(streamed, windows.tumbling_windows(batch))
    missing = [r for r in compared.collect() if not r["matches"]]
    assert compared.count() == 9 and len(missing) == 1
    assert missing[0]["left_pv"] is None  # only the open window


def part_files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


@pytest.fixture
def keyed(spark, tmp_path):
    schema = spark.createDataFrame([], "window_start timestamp, pv long, dt string").schema
    return jobs.KeyedTable(spark, str(tmp_path / "keyed"), schema, ["window_start"])


def batch_of(spark, *rows):
    return jobs.by_day(spark.createDataFrame([(START + timedelta(minutes=m), pv) for m, pv in rows], "window_start timestamp, pv long"))


def test_keyed_table_replaces_keys_and_keeps_few_files(spark, keyed, tmp_path):
    assert keyed.read().count() == 0
    for n in range(12):
        keyed.merge(batch_of(spark, (5 * n, n), (0, n)) if n else batch_of(spark, (0, 0)), n)
    assert rows_of(keyed.read(), "window_start", "pv") == [(START + timedelta(minutes=5 * n), n or 11) for n in range(12)]
    assert len(part_files(tmp_path / "keyed")) == 1  # one day, however many batches
    keyed.merge(batch_of(spark), 12)
    assert keyed.read().count() == 12


def test_keyed_table_takes_a_replayed_batch_once(spark, keyed, tmp_path):
    keyed.merge(batch_of(spark, (0, 1), (1440, 2)), 0)
    before = part_files(tmp_path / "keyed")
    keyed.merge(batch_of(spark, (1440, 3)), 1)
    after = part_files(tmp_path / "keyed")
    assert {k for k in before if before[k] == after.get(k)} == {k for k in before if "01-01" in k}  # the other day's files stay
    # A replay whose rows are read again, when the first attempt ended before or after the table was written.
    keyed.merge(batch_of(spark, (1440, 3)), 1)
    assert rows_of(keyed.read(), "pv") == [(1,), (3,)]
    assert keyed.merge(batch_of(spark, (0, 9)), 0) is None  # long taken in
    assert rows_of(keyed.read(), "pv") == [(1,), (3,)]


def test_early_windows_grow_with_every_batch(spark, topic, tmp_path):
    def step():
        return jobs.early_windows(json_stream(spark, str(topic.path)), str(tmp_path / "early"), str(tmp_path / "early-cp"), partitions=2)

    topic.send(message("1", 0), message("2", 1, 4), message("1", 6))
    assert rows_of(step(), "window_start", "pv", "uv", "buy", "events", "revisions") == [(START, 1, 2, 1, 2, 1), (START + timedelta(minutes=5), 1, 1, 0, 1, 1)]
    topic.send(message("1", 7), message("3", 8, 3), message("4", 12))  # a restart: user 1 is known in the second window
    found = step()
    assert rows_of(found, "window_start", "uv", "events", "revisions") == [
        (START, 2, 2, 1), (START + timedelta(minutes=5), 2, 3, 2), (START + timedelta(minutes=10), 1, 1, 1),
    ]
    batch = windows.tumbling_windows(normalize(spark.read.schema(STREAM_SCHEMA).json(str(topic.path))))
    assert all(row["matches"] for row in jobs.reconcile_windows(found, batch).collect())


def test_sliding_stream_equals_sliding_windows(spark, topic, tmp_path):
    messages = [message(f"{i % 7}" if i % 5 else None, i * 1.9, 1 + i % 4) for i in range(50)]
    for k in (0, 20, 35):
        topic.send(*messages[k : {0: 20, 20: 35, 35: 50}[k]])
        stream = json_stream(spark, str(topic.path))
        found = jobs.sliding_stream(stream.withColumn("user_id", F.col("user_id").cast("bigint")), str(tmp_path / "s"), str(tmp_path / "s-cp"), 15, 5, partitions=2)
    log = normalize(spark.read.schema(STREAM_SCHEMA).json(str(topic.path)))
    columns = ("window_start", "window_end", "window", "pv", "uv", "cart", "buy", "events")
    wanted = rows_of(windows.sliding_windows(log, 15, 5), *columns)
    newest = START + timedelta(minutes=90)  # the last closed pane begins at 85
    assert rows_of(found, *columns) == [row for row in wanted if row[1] <= newest]


def test_correction_replaces_only_days_that_differ(spark, keyed, tmp_path):
    keyed.merge(batch_of(spark, (0, 1), (1440, 2), (2880, 3)), 0)
    before = part_files(tmp_path / "keyed")
    right = batch_of(spark, (0, 1), (1440, 5), (1445, 6))
    assert rows_of(jobs.correct_windows(keyed, right)) == [("2024-01-02", 2), ("2024-01-03", 1)]
    now = keyed.read().select(*right.columns)
    assert now.exceptAll(right).isEmpty() and right.exceptAll(now).isEmpty()
    kept = {k: v for k, v in part_files(tmp_path / "keyed").items() if "01-01" in k}
    assert kept == {k: v for k, v in before.items() if "01-01" in k}
    assert jobs.correct_windows(keyed, right).isEmpty()


def test_repeats_count_once_across_batches(spark, topic, tmp_path):
    def step():
        stream = jobs.without_repeats(json_stream(spark, str(topic.path)), ["user_id", "item_id", "datetime"], "10 minutes")
        query = jobs.start_to_table(stream, str(tmp_path / "once"), str(tmp_path / "once-cp"), partitions=2)
        query.awaitTermination()
        return rows_of(spark.read.schema(stream.schema).parquet(str(tmp_path / "once")), "user_id"), query

    topic.send(message("1", 0), message("1", 0), message("2", 1))
    step()
    topic.send(message("2", 1), message("3", 9))
    assert step()[0] == [("1",), ("2",), ("3",)]
    topic.send(message("4", 60))
    step()
    topic.send(message("1", 0), message("5", 61))  # by now behind the watermark, and dropped by the engine
    found, query = step()
    assert found == [("1",), ("2",), ("3",), ("4",), ("5",)] and jobs.dropped_rows(query) == 1
    state = [op["numRowsTotal"] for progress in query.recentProgress for op in progress["stateOperators"]]
    assert state[-1] <= 2  # rows of the first batches are forgotten


def test_turnover_counts_purchases_without_a_price(spark, topic, tmp_path):
    goods = spark.createDataFrame([("1", "2.50"), ("2", "1.25")], "item_id string, price string")
    topic.send(message("a", 0, 4), message("b", 1, 4, "2"), message("b", 2, 4, "9"), message("a", 3), message("a", 20, 4))
    counted = jobs.stream_turnover(json_stream(spark, str(topic.path)), goods)
    found = jobs.run_to_table(counted, str(tmp_path / "t"), str(tmp_path / "t-cp"), 2)
    assert [tuple(map(str, row)) for row in rows_of(found, "buys", "turnover", "unpriced")] == [("3", "3.75", "1")]


def test_messages_decode_from_kafka_shape(spark):
    raw = spark.createDataFrame([(json.dumps(message("7", 1, 4)).encode(),), (b"no json",)], "value binary")
    rows = normalize(decode_messages(raw)).collect()
    assert (rows[0]["user_id"], rows[0]["behavior_type"], rows[0]["datetime"]) == ("7", "buy", START + timedelta(minutes=1))
    assert rows[1]["user_id"] is None


def test_settings_are_restored_after_start(spark, topic, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    topic.send(message("a", 0))
    run(spark, topic, tmp_path)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_each_late_row_is_returned(spark, tmp_path):
    """Every 37th row comes one batch late, copies and rows without a time included; not only how many were late."""
    rows = [(i, START + timedelta(minutes=i), i % 5, "view", 1.0, '{"k": 3}') for i in range(200)] + [(37, START + timedelta(minutes=37), 2, "view", 1.0, None)] * 2
    rows += [(74, None, 1, "click", 1.0, None)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.late_rows(spark, str(tmp_path)).collect()
    # Batches are quarters of 50 ids; the window of a row one batch late is closed if five minutes more were seen before.
    assert sorted((r["event_id"], r["batch"]) for r in found) == [(0, 1), (37, 1), (37, 1), (37, 1), (74, 2), (111, 3), (185, 4)]
