"""Windowed aggregation of a stream, a result table keyed by window, early results, corrections and late rows."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.behavior import behavior_col
from clickloom.operators.quality import compare_grouped, mismatches
from clickloom.operators.rollup import COUNTERS
from clickloom.operators.windows import fold_window_users, named_windows, turnover_windows, user_panes, window_users, windows_of_panes, without_gaps
from clickloom.session import materialize
from clickloom.sources.tables import drop_partition, read_if_there, write_partitioned, write_table

WATERMARK = "5 seconds"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_windows(
    stream: DataFrame, size: str = "5 minutes", slide: str | None = None, delay: str = WATERMARK, time: str = "datetime"
) -> DataFrame:
    """Windows of a stream with an exact number of users, for output mode ``append``.

    Two chained aggregations: state is spread over (window, user), so the current window is not one
    key, and a window leaves the second one when the watermark has passed its end."""
    return fold_window_users(window_users(stream.withWatermark(time, delay), size, slide, time))


@contextmanager
def _state_settings(spark: SparkSession, partitions: int | None):
    """State in RocksDB, split into as many partitions as there are cores unless given; a running
    query keeps the settings it started with."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_to_table(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Append finished windows to a Parquet table; exactly once, restarts from its checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, stream.sparkSession, checkpoint, partitions, available_now)


def start_to_function(
    stream: DataFrame, handle, checkpoint: str, partitions: int | None = None, available_now: bool = True, mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)``, written out, so that using it several times does not run the stream's
    operators again."""
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: handle(materialize(batch, "batch"), batch_id)).outputMode(mode)
    return _start(writer, stream.sparkSession, checkpoint, partitions, available_now)


def _start(writer, spark, checkpoint, partitions, available_now):
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _state_settings(spark, partitions):
        return writer.start()


def run_to_table(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Process what is there, then return the table written."""
    start_to_table(stream, path, checkpoint, partitions).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


class KeyedTable:
    """A Parquet table with one row for each key, kept by the micro-batches of one stream.

    A batch replaces the rows of its keys and adds new ones. Only the partitions that it touches are read and
    rewritten, each as few files, so the number of files depends on the number of partitions and not on that of batches. The
    touched partitions as they shall be are first written beside the table, with the batch id: a batch that is replayed, because the job
    ended in the middle, copies them once more and changes nothing. ``partition`` is a column that follows from the key, such as the
    day of a window. Readers see whole partitions, but may see some of a batch before others."""

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], partition: str = "dt") -> None:
        self.spark, self.path, self.keys, self.partition = spark, path, keys, partition
        self.schema = schema

    @property
    def _next(self) -> str:
        return f"{self.path}_next"

    def read(self) -> DataFrame:
        return read_if_there(self.spark, self.path, self.schema)

    def touched(self, batch: DataFrame) -> DataFrame:
        """The table's rows in partitions that ``batch`` has rows of. Their names, a few per batch, prune the scan."""
        names = [row[0] for row in batch.select(self.partition).distinct().collect()]
        return self.read().where(F.col(self.partition).isin(names)) if names else self.read().where("false")

    def merge(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """Take in a batch that has each key once; the touched partitions as they are now, None for an empty batch."""
        batch = batch.select(*[field.name for field in self.schema.fields])
        staged = read_if_there(self.spark, self._next, T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]), finished=True)
        done = staged.agg(F.max("batch_id")).first()[0]
        if done is None or done < batch_id:
            old = self.touched(batch).join(batch.select(*self.keys), self.keys, "left_anti").select(*batch.columns)
            staged = write_table(old.unionByName(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint")), self._next)
        elif done > batch_id:
            return None
        staged = staged.where(F.col("batch_id") == batch_id).drop("batch_id")
        if staged.isEmpty():
            return None
        write_partitioned(staged, self.path, self.partition, sort_by=self.keys)
        return staged


def by_day(windows: DataFrame, time: str = "window_start") -> DataFrame:
    return windows.withColumn("dt", F.date_format(time, "yyyy-MM-dd"))


def keep_windows(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Finished windows into a result table keyed by ``window_start``; process what is there and return the table."""
    dated = by_day(stream)
    table = KeyedTable(stream.sparkSession, path, dated.schema, ["window_start"])
    start_to_function(dated, table.merge, checkpoint, partitions).awaitTermination()
    return table.read()


#: Stands for a missing user in keyed tables, where a join by equality would not find NULL again.
NO_USER = -1


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("user_id", F.coalesce("user_id", F.lit(NO_USER).cast(rows.schema["user_id"].dataType)))


def _without_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("user_id", F.when(F.col("user_id") != F.lit(NO_USER).cast(rows.schema["user_id"].dataType), F.col("user_id")))


#: Partitions of the tables that hold (window, user) and (pane, user): an hour, as a batch of a running stream touches one or two; days suit
#: batches that cover many hours.
HOURS, DAYS = "yyyy-MM-dd-HH", "yyyy-MM-dd"


def early_windows(
    stream: DataFrame, path: str, checkpoint: str, size: str = "5 minutes", delay: str = WATERMARK, time: str = "datetime",
    grain: str = HOURS, partitions: int | None = None,
) -> DataFrame:
    """Windows before they are finished: after each micro-batch the result table has every window as far as it is known.

    The counters of (window, user) are streaming state, in mode ``update``: a batch hands over only those that changed. They replace
    what is known of these users in a table partitioned by ``grain``, and the windows touched are summed anew from it. Columns
    as in ``stream_windows``, and ``revisions``, the number of batches that changed the window."""
    spark = stream.sparkSession
    changed = window_users(stream.withWatermark(time, delay), size, time=time).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "user_id", *COUNTERS,
        F.date_format("window.start", grain).alias("part"),
    )
    users = KeyedTable(spark, f"{path}_users", changed.schema, ["window_start", "user_id"], "part")
    columns = "window_start timestamp, window_end timestamp, pv bigint, uv bigint, cart bigint, buy bigint, events bigint, buy_rate double, revisions bigint, dt string"
    table = KeyedTable(spark, path, spark.createDataFrame([], columns).schema, ["window_start"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = _with_keys(batch)
        known = users.merge(batch, batch_id)
        if known is None:
            return
        fresh = known.join(batch.select("window_start").distinct(), "window_start", "left_semi")
        named = _without_keys(fresh).select(F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"), "user_id", *COUNTERS)
        # Written once: what the merge below compares, counts and writes must be the same.
        summed = materialize(by_day(fold_window_users(named)), "early")
        before = table.touched(summed).select("window_start", F.col("revisions").alias("before"))
        counted = summed.join(before, "window_start", "left").withColumn("revisions", F.coalesce("before", F.lit(0)) + 1)
        table.merge(counted, batch_id)

    start_to_function(changed, handle, checkpoint, partitions, mode="update").awaitTermination()
    return table.read()


def sliding_stream(
    stream: DataFrame, path: str, checkpoint: str, size_minutes: int = 30, slide_minutes: int = 1, delay: str = WATERMARK, time: str = "datetime",
    grain: str = HOURS, partitions: int | None = None,
) -> DataFrame:
    """Finished sliding windows of a stream, equal to ``sliding_windows`` as far as they are finished.

    State holds (pane, user), so an event is counted once and not copied into the windows it falls in. Panes that the watermark has passed
    leave the state together, into a table partitioned by ``grain``; each batch then sums the windows whose last pane is closed, from the panes
    of one window length. ``delay`` is the watermark's."""
    spark = stream.sparkSession
    slide, reach = slide_minutes * 60, (size_minutes - slide_minutes) * 60
    counted = window_users(stream.withWatermark(time, delay), f"{slide_minutes} minutes", time=time)
    panes = counted.select(
        F.unix_seconds("window.start").alias("pane"), "user_id", *COUNTERS, F.date_format("window.start", grain).alias("part")
    )
    held = KeyedTable(spark, f"{path}_panes", panes.schema, ["pane", "user_id"], "part")
    schema = spark.createDataFrame([], "window_start timestamp, window_end timestamp, window string, pv bigint, uv bigint, cart bigint, buy bigint, events bigint, dt string").schema
    table = KeyedTable(spark, path, schema, ["window_start"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = _with_keys(batch)
        first, newest = batch.agg(F.min("pane"), F.max("pane")).first()
        if newest is None:
            return
        # Panes of earlier batches are older than all of this one; the last of them tells which windows are out already.
        known = held.read().where(F.col("pane") < first)
        bounds = known.agg(F.min("pane"), F.max("pane")).first()
        low = first if bounds[0] is None else bounds[0]
        begin = low if bounds[1] is None else max(low, bounds[1] - reach + slide)
        held.merge(batch, batch_id)
        needed = held.read().where((F.col("part") >= F.date_format(F.timestamp_seconds(F.lit(begin)), grain)) & F.col("pane").between(begin, newest))
        named = _without_keys(needed).drop("part")
        # An empty pane at the beginning, so that windows without events are there from it on.
        edge = spark.range(1).select(F.lit(begin).cast("bigint").alias("pane"), F.lit(None).cast(named.schema["user_id"].dataType).alias("user_id"), *[F.lit(0).cast("bigint").alias(name) for name in COUNTERS])
        found = windows_of_panes(named.unionByName(edge), size_minutes, slide_minutes)
        found = without_gaps(found, size_minutes, slide_minutes).where(F.col("start") <= newest - reach)
        table.merge(by_day(named_windows(found, size_minutes)), batch_id)

    start_to_function(panes, handle, checkpoint, partitions).awaitTermination()
    return table.read()


def stream_turnover(stream: DataFrame, goods: DataFrame, size_minutes: int = 5, delay: str = WATERMARK, time: str = "datetime") -> DataFrame:
    """Turnover per window of a stream, joined with a static table of goods; for output mode ``append``. The watermark follows
    the purchases: a window is finished when a later one has moved it past its end."""
    buys = stream.where(behavior_col() == "buy").withWatermark(time, delay)
    return turnover_windows(buys, goods, size_minutes, time)


def without_repeats(stream: DataFrame, columns: list[str], delay: str = WATERMARK, time: str = "datetime") -> DataFrame:
    """Each row once, by some of its columns, if its copies are not further apart in event time than ``delay``; the state
    forgets a row after that. Rows behind the watermark are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(columns)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the engine dropped because they were behind its watermark, over the batches that the query still remembers. Exact for
    operators without partial aggregation, such as ``without_repeats``."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def keep_taken(
    stream: DataFrame, path: str, checkpoint: str, step: int, size: str = "5 minutes", delay: str = WATERMARK, time: str = "datetime",
    partitions: int | None = None,
) -> DataFrame:
    """The windows (step, window_start) in which the engine took in rows of the step that has arrived, and of earlier steps: a window whose end the watermark
    had passed gets none any more."""
    taken = stream.withWatermark(time, delay).groupBy(F.window(time, size).alias("window")).agg(F.count("*").alias("n"))
    taken = taken.select(F.lit(step).alias("step"), F.col("window.start").alias("window_start"))
    start_to_function(taken, lambda batch, _: batch.write.mode("append").parquet(path), checkpoint, partitions, mode="update").awaitTermination()
    return stream.sparkSession.read.schema(taken.schema).parquet(path)


def not_taken(arrived: DataFrame, taken: DataFrame, step: str, size: str = "5 minutes", time: str = "datetime") -> DataFrame:
    """The rows that came too late: the engine took in no row of their window in the step (a column of ``arrived``) that they arrived in."""
    dated = arrived.where(F.col(time).isNotNull()).withColumns({"step": F.col(step), "window_start": F.window(time, size)["start"]})
    return dated.join(taken.distinct(), ["step", "window_start"], "left_anti").where(F.col("step").isNotNull()).drop("step", "window_start")


def reconcile_windows(streamed: DataFrame, batch: DataFrame) -> DataFrame:
    """Streamed windows (left) against the batch recomputation (right), by window start."""
    return compare_grouped(streamed, batch, ["window_start"], ["pv", "uv", "cart", "buy"])


def correct_windows(table: KeyedTable, batch: DataFrame) -> DataFrame:
    """Replace the partitions of a result table that differ from a batch recomputation, ``batch``, and no others; the names of those.

    Windows are compared by key in all columns. Of a partition that differs all rows come from ``batch``; one that
    ``batch`` has no rows of is dropped."""
    values = [name for name in table.schema.names if name not in (*table.keys, table.partition)]
    keys = [*table.keys, table.partition]
    wrong = materialize(mismatches(compare_grouped(table.read(), batch, keys, values)).groupBy(table.partition).agg(F.count("*").alias("n")), "wrong")
    # By name of partition: one row for each day of windows.
    right = materialize(batch.join(F.broadcast(wrong.select(table.partition)), table.partition, "left_semi").select(*table.schema.names), "corrected")
    for row in wrong.join(right.select(table.partition).distinct(), table.partition, "left_anti").collect():
        drop_partition(table.spark, table.path, table.partition, row[table.partition])
    if not right.isEmpty():
        write_partitioned(right, table.path, table.partition, sort_by=table.keys)
    return wrong.select(table.partition, F.col("n").alias("windows"))
