"""The registered queries: name -> callable(spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.behavior import behavior_col, choose, parse_bigint
from clickloom.operators import cleaning, distinct, quality, windows
from clickloom.plans import incremental, metrics, recommend, rfm, warehouse
from clickloom.schema import BEHAVIOR_CODES, CLEAN_SCHEMA, EXPORT_COLUMNS, ODS_COLUMNS, SAMPLE_SCHEMA, STREAM_SCHEMA
from clickloom.session import materialize_and_free, pin_session, shared_path
from clickloom.sources import adapters, files, tables
from clickloom.streaming import jobs
from clickloom.streaming import sources as stream_sources
from clickloom.streaming.sources import event_files_stream

# Parameters of registered queries; the given events cover January 2024.
CLEAN_FROM, CLEAN_UNTIL = "2024-01-03", "2024-01-28"
SLICE_HOURS, SLICE_BEHAVIORS = (8, 20), ["pv", "buy"]
REPLACED_DAY = "2024-01-10"
ARRIVALS = 4
ORDER_DELAY = "400 days"
CUT = 1_705_320_000  # noon of 15 January
TRAILING = 7

QUERIES: dict = {}


def query(build):
    """Register a query. Results get plain types: whole numbers bigint, decimals double, dates text."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(pin_session(spark), folder.rstrip("/")))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def _plain(df: DataFrame) -> DataFrame:
    def cast(field):
        kind, column = field.dataType, F.col(field.name)
        if isinstance(kind, T.IntegralType):
            return column.cast("bigint")
        if isinstance(kind, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column.cast("string") if isinstance(kind, T.DateType) else column

    return df.select(*[cast(field).alias(field.name) for field in df.schema.fields])


def _dirty_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The dirty landing with types, blanks and text that is no number as missing."""
    ids = [name for name in ODS_COLUMNS if name != "behavior_type"]
    landed = adapters.dirty_landing(spark, folder)
    return landed.withColumns({name: parse_bigint(F.col(name)) for name in ids})


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.to_dwd(adapters.dirty_landing(spark, folder))


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.behavior(spark, folder).withColumn("dt", F.date_format("datetime", "yyyy-MM-dd"))


def _coded(log: DataFrame) -> DataFrame:
    """Behaviours as the integer codes that samples and messages use."""
    return log.withColumn("behavior_type", choose(behavior_col(), {kind: code for code, kind in BEHAVIOR_CODES.items()}))


# --- sources, landing, cleaning ---


@query
def ods_line_audit(spark, folder):
    """The landing as a text file, read line by line; a missing field leaves its line one field short."""
    path = shared_path(spark, "lines")
    adapters.dirty_landing(spark, folder).select(F.concat_ws(",", *ODS_COLUMNS).alias("value")).write.text(path)
    return quality.audit_lines(files.read_lines(spark, path))


@query
def ods_landing_counts(spark, folder):
    return quality.value_counts(cleaning.to_ods(adapters.dirty_landing(spark, folder)), "behavior_type")


@query
def clean_report(spark, folder):
    return quality.clean_report(_dirty_raw(spark, folder), CLEAN_FROM, CLEAN_UNTIL)


@query
def clean_log(spark, folder):
    return cleaning.clean_behavior(_dirty_raw(spark, folder), CLEAN_FROM, CLEAN_UNTIL)


@query
def clean_profile(spark, folder):
    return quality.clean_profile(cleaning.clean_behavior(_dirty_raw(spark, folder), CLEAN_FROM, CLEAN_UNTIL))


@query
def missing_by_column(spark, folder):
    return quality.missing_counts(_dirty_raw(spark, folder))


@query
def duplicate_rows(spark, folder):
    return quality.duplicate_count(adapters.dirty_landing(spark, folder))


@query
def describe_values(spark, folder):
    described = quality.describe_values(adapters.behavior(spark, folder), ["user_id", "item_id", "category_id", "timestamp"])
    return described.withColumns({"mean": F.round("mean", 3), "std": F.round("std", 3)})


@query
def raw_csv_roundtrip(spark, folder):
    """The dirty log written as headerless CSV, read back by declared schema and counted."""
    path = shared_path(spark, "raw-log")
    adapters.dirty_landing(spark, folder).write.csv(path)
    read = files.read_raw_log(spark, path)
    return read.groupBy("behavior_type").agg(
        F.count("*").alias("cnt"),
        F.count("user_id").alias("with_user"),
        F.count("item_id").alias("with_item"),
        F.sum("timestamp").alias("time_sum"),
    )


@query
def export_roundtrip(spark, folder):
    """The slice exported as CSV with a header and read back."""
    path = shared_path(spark, "export")
    chosen = cleaning.slice_behavior(adapters.behavior(spark, folder), SLICE_HOURS, SLICE_BEHAVIORS)
    files.export_detail(chosen, path)
    schema = T.StructType([CLEAN_SCHEMA[name] for name in EXPORT_COLUMNS])
    return files.read_csv(spark, path, schema, header=True)


@query
def sample_roundtrip(spark, folder):
    """The log with integer codes written as CSV with a header, read back by its declared schema, named and counted."""
    path = shared_path(spark, "sample")
    files.write_csv(_coded(adapters.behavior(spark, folder)).select(*SAMPLE_SCHEMA.fieldNames()), path)
    read = cleaning.with_named_codes(files.read_sample_log(spark, path))
    return read.groupBy("behavior_type").agg(
        F.count("*").alias("cnt"), F.count("item_id").alias("with_item"), F.sum("timestamp").alias("time_sum")
    )


@query
def clean_table(spark, folder):
    """The clean log written once, in order, and read back."""
    clean = cleaning.clean_behavior(_dirty_raw(spark, folder), CLEAN_FROM, CLEAN_UNTIL)
    return tables.write_clean(clean, shared_path(spark, "clean"))


@query
def replaced_table(spark, folder):
    """A catalog table of the log, replaced by one of other columns: actions of each item."""
    name, log = f"clickloom_{uuid.uuid4().hex}", adapters.behavior(spark, folder)
    tables.replace_table(log, name)
    return tables.replace_table(log.groupBy("item_id").agg(F.count("*").alias("cnt")), name)


@query
def partition_overwrite(spark, folder):
    """All days written, then one day replaced by its purchases: rows per day afterwards."""
    path = shared_path(spark, "dwd")
    detail = tables.write_partitioned(_detail(spark, folder), path, "dt")
    day = _detail(spark, folder).where((F.col("dt") == REPLACED_DAY) & (F.col("behavior_type") == "buy"))
    tables.write_partitioned(day, path, "dt")
    return spark.read.schema(detail.schema).parquet(path).groupBy("dt").agg(F.count("*").alias("cnt"))


@query
def load_verification(spark, folder):
    return tables.load_and_verify(adapters.behavior(spark, folder), shared_path(spark, "load"))


@query
def source_fallback(spark, folder):
    """A missing primary source, then the events: rows per type and the label of the source used."""
    df, label = tables.first_available(
        ("primary", lambda: tables.read_table(spark, f"{folder}/absent.parquet", ["user_id"])),
        ("events", lambda: tables.read_table(spark, f"{folder}/events.parquet", ["user_id", "event_type"])),
    )
    return df.groupBy("event_type").agg(F.count("*").alias("cnt")).withColumn("source", F.lit(label))


# --- warehouse ---


@query
def dwd_detail(spark, folder):
    return _detail(spark, folder)


@query
def dwd_reconcile(spark, folder):
    source = adapters.behavior(spark, folder)
    return warehouse.reconcile_hours(source, cleaning.to_dwd(cleaning.to_ods(source)))


@query
def dwd_layer_audit(spark, folder):
    return quality.layer_audit(adapters.dirty_landing(spark, folder))


@query
def frame_equality(spark, folder):
    """Landing against its distinct rows: what differs are the repeated rows, by their surplus."""
    landed = adapters.dirty_landing(spark, folder)
    return quality.frame_difference(landed, cleaning.dedup_rows(landed))


@query
def daily_metrics(spark, folder):
    return warehouse.daily_metrics(_detail(spark, folder))


@query
def ads_hourly_by_day(spark, folder):
    return warehouse.ads_hourly(_detail(spark, folder))


@query
def ads_hourly(spark, folder):
    return warehouse.ads_hourly(_detail(spark, folder), by_day=False)


@query
def ads_category(spark, folder):
    return warehouse.ads_category(_detail(spark, folder))


@query
def ads_funnel(spark, folder):
    return warehouse.ads_funnel(cleaning.to_dwd(cleaning.to_ods(adapters.behavior(spark, folder))))


@query
def warehouse_build(spark, folder):
    """All layers written in order; the daily summary as read back."""
    paths = warehouse.build_warehouse(adapters.dirty_landing(spark, folder), shared_path(spark, "warehouse"))
    return tables.read_table(spark, paths["dws"])


def _taken_in(spark, folder):
    """The landing in two parts, cut in the middle of a day, each taken in when it is there."""
    work = shared_path(spark, "incremental")
    landed = adapters.dirty_landing(spark, folder)
    for early in (True, False):
        landed.where((F.col("timestamp").cast("bigint") < CUT) == early).write.mode("append").parquet(f"{work}/landing")
        incremental.take_in(spark, f"{work}/landing", f"{work}/layers")
    return f"{work}/layers"


@query
def incremental_daily(spark, folder):
    """The daily summary after two batches, of which the second rebuilt only its days."""
    return tables.read_table(spark, f"{_taken_in(spark, folder)}/dws")


@query
def incremental_category(spark, folder):
    return incremental.category_report(spark, _taken_in(spark, folder))


@query
def incremental_funnel(spark, folder):
    return incremental.funnel_report(spark, _taken_in(spark, folder))


@query
def trailing_users(spark, folder):
    """Distinct users and buyers of the last seven days, for each day, from bitmaps by day."""
    parts = distinct.bitmap_rollup(_dated(spark, folder), "dt")
    return distinct.users_of_bitmaps(distinct.trailing_days(parts, TRAILING), "until", users=(), buyers=("buy",))


@query
def trailing_estimate(spark, folder):
    """The same by sketches: whether the estimate is within five standard errors of the exact number."""
    log = _dated(spark, folder)
    exact = distinct.users_of_bitmaps(distinct.trailing_days(distinct.bitmap_rollup(log, "dt"), TRAILING), "until", users=())
    guess = distinct.users_of_sketches(distinct.trailing_days(distinct.sketch_rollup(log, "dt"), TRAILING), "until")
    off = F.abs(F.col("guess") - F.col("users")) / F.col("users")
    return exact.join(guess.withColumnRenamed("users", "guess"), "until").select("until", "users", (off <= 5 * distinct.SKETCH_ERROR).alias("within"))


# --- metrics ---


@query
def overall_kpis(spark, folder):
    return metrics.overall_kpis(adapters.behavior(spark, folder))


@query
def demo_kpis(spark, folder):
    return metrics.demo_kpis(adapters.behavior(spark, folder))


@query
def real_kpis(spark, folder):
    return metrics.real_kpis(adapters.behavior(spark, folder))


@query
def core_metrics_slice(spark, folder):
    return metrics.core_metrics(cleaning.slice_behavior(adapters.behavior(spark, folder), SLICE_HOURS, SLICE_BEHAVIORS))


@query
def kpi_delta(spark, folder):
    return metrics.kpi_delta(adapters.behavior(spark, folder), SLICE_HOURS, ["pv", "cart"])


@query
def slice_coverage(spark, folder):
    return metrics.slice_coverage(adapters.behavior(spark, folder), SLICE_HOURS, SLICE_BEHAVIORS)


@query
def hourly_traffic(spark, folder):
    return metrics.hourly_traffic(adapters.behavior(spark, folder))


@query
def hourly_long(spark, folder):
    return metrics.hourly_long(adapters.behavior(spark, folder))


@query
def hour_behavior(spark, folder):
    return metrics.hour_behavior(adapters.behavior(spark, folder))


@query
def behavior_mix(spark, folder):
    return metrics.behavior_mix(adapters.behavior(spark, folder), fill_missing=True)


@query
def funnel_wide(spark, folder):
    return metrics.funnel_wide(adapters.behavior(spark, folder))


@query
def funnel_long(spark, folder):
    return metrics.funnel_long(adapters.behavior(spark, folder))


@query
def funnel_rates(spark, folder):
    return metrics.funnel_rates(adapters.behavior(spark, folder))


@query
def count_funnel(spark, folder):
    return metrics.count_funnel(adapters.behavior(spark, folder))


@query
def count_funnel_merged(spark, folder):
    return metrics.count_funnel(adapters.behavior(spark, folder), merged=True)


@query
def category_top(spark, folder):
    return metrics.category_top(adapters.behavior(spark, folder))


@query
def category_heat(spark, folder):
    return metrics.category_heat(adapters.behavior(spark, folder), top_n=20)


@query
def top_buyers(spark, folder):
    return metrics.top_buyers(adapters.behavior(spark, folder))


@query
def user_behavior_pivot(spark, folder):
    return metrics.user_behavior_table(adapters.behavior(spark, folder))


@query
def behavior_stack(spark, folder):
    return metrics.behavior_stack(adapters.behavior(spark, folder))


@query
def buy_detail(spark, folder):
    return metrics.buy_detail(adapters.behavior(spark, folder))


@query
def detail_preview(spark, folder):
    return metrics.detail_preview(cleaning.slice_behavior(adapters.behavior(spark, folder), SLICE_HOURS, SLICE_BEHAVIORS))


@query
def gmv_daily(spark, folder):
    return metrics.gmv_daily(adapters.order_log(spark, folder), adapters.PAID_STATUS)


@query
def rfm_users(spark, folder):
    return rfm.rfm_users(adapters.behavior(spark, folder))


@query
def rfm_segments(spark, folder):
    return rfm.rfm_segments(adapters.behavior(spark, folder))


@query
def rfm_report(spark, folder):
    return rfm.rfm_report(adapters.behavior(spark, folder))


# --- event-time windows ---


@query
def tumbling_5m(spark, folder):
    return windows.tumbling_windows(adapters.behavior(spark, folder))


@query
def sliding_15_5(spark, folder):
    return windows.sliding_windows(adapters.behavior(spark, folder))


@query
def sliding_30_1(spark, folder):
    return windows.sliding_windows(adapters.behavior(spark, folder), 30, 1)


@query
def user_windows(spark, folder):
    return windows.user_windows(adapters.behavior(spark, folder))


@query
def peak_windows(spark, folder):
    return windows.peak_windows(windows.tumbling_windows(adapters.behavior(spark, folder)))


@query
def time_span(spark, folder):
    return windows.time_span(adapters.behavior(spark, folder))


# --- streams ---


def _event_stream(spark, folder):
    # a glob stands for a single file as well as for a folder of files, a plain path only for the latter
    return event_files_stream(spark, f"{folder}/{{events.parquet}}")


def _streamed(spark, folder, size="5 minutes", slide=None):
    work = shared_path(spark, "stream")
    counted = jobs.stream_windows(_event_stream(spark, folder), size, slide)
    return jobs.run_to_table(counted, f"{work}/table", f"{work}/checkpoint")


@query
def stream_tumbling(spark, folder):
    return _streamed(spark, folder)


@query
def stream_sliding(spark, folder):
    return _streamed(spark, folder, "15 minutes", "5 minutes")


@query
def stream_user_windows(spark, folder):
    """Windows per user as a stream: one aggregation, keyed by window and user."""
    work = shared_path(spark, "stream")
    stream = _event_stream(spark, folder).withWatermark("datetime", jobs.WATERMARK)
    return jobs.run_to_table(windows.user_windows(stream), f"{work}/table", f"{work}/checkpoint")


@query
def stream_reconcile(spark, folder):
    """Streamed against recomputed windows; -1 stands for a window the stream has not closed."""
    compared = jobs.reconcile_windows(_streamed(spark, folder), windows.tumbling_windows(adapters.behavior(spark, folder)))
    return compared.na.fill(-1, [name for name in compared.columns if name.startswith("left_")])


def _by_arrival(spark, folder, name, key, run, arrivals=ARRIVALS):
    """A table lands in parts, in the order of its key; ``run`` takes in each part as it arrives, from its checkpoint."""
    work = shared_path(spark, "stream")
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    last = rows.select(F.max(key) + 1).scalar()
    for step in range(arrivals):
        rows.where(F.floor(F.col(key) * arrivals / last) == step).write.mode("append").parquet(f"{work}/arrivals")
        yield run(f"{work}/arrivals", work)


@query
def stream_upsert(spark, folder):
    """Finished windows of a stream of two parts in a result table keyed by window start."""

    def run(path, work):
        return jobs.keep_windows(jobs.stream_windows(event_files_stream(spark, path)), f"{work}/table", f"{work}/checkpoint")

    *_, table = _by_arrival(spark, folder, "events", "event_id", run, 2)
    return table.drop("dt")


@query
def stream_early(spark, folder):
    """Windows as far as known after each of two parts; the last state has every window, with the number of parts that changed it."""

    def run(path, work):
        return jobs.early_windows(event_files_stream(spark, path), f"{work}/table", f"{work}/checkpoint", grain=jobs.DAYS)

    *_, table = _by_arrival(spark, folder, "events", "event_id", run, 2)
    return table.drop("dt")


@query
def stream_sliding_30_1(spark, folder):
    """Finished windows of 30 minutes every minute, summed from panes that leave the stream's state."""

    def run(path, work):
        return jobs.sliding_stream(event_files_stream(spark, path), f"{work}/table", f"{work}/checkpoint", grain=jobs.DAYS)

    *_, table = _by_arrival(spark, folder, "events", "event_id", run, 2)
    return table.drop("dt")


@query
def stream_corrected(spark, folder):
    """The stream's result table after a batch recomputation has replaced the days that differ."""
    work = shared_path(spark, "stream")
    counted = jobs.by_day(jobs.stream_windows(_event_stream(spark, folder)))
    jobs.keep_windows(counted.drop("dt"), f"{work}/table", f"{work}/checkpoint")
    table = jobs.KeyedTable(spark, f"{work}/table", counted.schema, ["window_start"])
    jobs.correct_windows(table, jobs.by_day(windows.tumbling_windows(adapters.behavior(spark, folder)).drop("window")))
    return table.read().drop("dt")


@query
def turnover_5m(spark, folder):
    return windows.turnover_windows(adapters.behavior(spark, folder), adapters.goods(spark, folder))


@query
def stream_turnover(spark, folder):
    """Turnover by window of a stream joined with the table of parts."""
    work = shared_path(spark, "stream")
    counted = jobs.stream_turnover(_event_stream(spark, folder), adapters.goods(spark, folder))
    return jobs.run_to_table(counted, f"{work}/table", f"{work}/checkpoint")


@query
def stream_distinct(spark, folder):
    """The dirty landing as a stream of files: rows that came twice count once."""
    work = shared_path(spark, "stream")
    landed = adapters.dirty_landing(spark, folder)
    landed.write.parquet(f"{work}/landing")
    stream = spark.readStream.schema(landed.schema).parquet(f"{work}/landing")
    timed = stream.withColumn("datetime", F.timestamp_seconds(F.col("timestamp").cast("bigint")))
    kept = jobs.run_to_table(jobs.without_repeats(timed, ODS_COLUMNS), f"{work}/table", f"{work}/checkpoint")
    return kept.groupBy("behavior_type").agg(F.count("*").alias("cnt"), F.count("item_id").alias("with_item"))


def _messages(spark, folder):
    texts = {name: F.col(name).cast("string") for name in ("user_id", "item_id", "category_id")}
    coded = _coded(adapters.behavior(spark, folder)).withColumns(texts)
    return coded.withColumnRenamed("datetime", "ts").select(*STREAM_SCHEMA.fieldNames())


@query
def decoded_messages(spark, folder):
    """Events as JSON messages in binary, decoded and named."""
    packed = _messages(spark, folder).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    return stream_sources.normalize(stream_sources.decode_messages(packed))


@query
def stream_messages(spark, folder):
    """Messages as JSON files, one file a batch, streamed into a table and counted."""
    work = shared_path(spark, "stream")
    _messages(spark, folder).repartition(ARRIVALS).write.json(f"{work}/messages")
    stream = stream_sources.json_stream(spark, f"{work}/messages", max_files=1)
    arrived = jobs.run_to_table(stream, f"{work}/table", f"{work}/checkpoint")
    return arrived.groupBy("behavior_type").agg(
        F.count("*").alias("cnt"), F.min("datetime").alias("first_time"), F.max("datetime").alias("last_time")
    )


@query
def late_rows(spark, folder):
    """Events arrive in batches by quarter of their ids, every 37th one batch later than the rest; the rows that the engine drops
    because its watermark had passed the end of their window."""
    work = shared_path(spark, "late")
    events = adapters.open_events(spark, folder)
    last = events.select(F.max("event_id") + 1).scalar()
    turn = F.floor(F.col("event_id") * ARRIVALS / last).cast("int") + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)
    for step in range(ARRIVALS + 1):
        events.where(turn == step).write.mode("append").parquet(f"{work}/arrivals")
        stream = event_files_stream(spark, f"{work}/arrivals", legal_only=False)
        kept = jobs.keep_taken(stream, f"{work}/taken", f"{work}/checkpoint", step)
    arrived = adapters.behavior_from_events(events.withColumn("batch", turn), False, "event_id", "batch")
    return jobs.not_taken(arrived, kept, "batch").select("event_id", "user_id", "behavior_type", "datetime", "batch")


@query
def stream_late_orders(spark, folder):
    """Orders land in the order of their keys, their dates in any order: per part, rows taken in and rows that the engine
    dropped because their date was behind its watermark."""
    schema = spark.read.parquet(f"{folder}/orders.parquet").schema

    def run(path, work):
        stream = spark.readStream.schema(schema).parquet(path).select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
        kept = jobs.without_repeats(stream, ["o_orderkey"], ORDER_DELAY, "o_orderdate")
        started = jobs.start_to_table(kept, f"{work}/table", f"{work}/checkpoint")
        started.awaitTermination()
        return sum(progress["numInputRows"] for progress in started.recentProgress), jobs.dropped_rows(started)

    rows = [(part, *counts) for part, counts in enumerate(_by_arrival(spark, folder, "orders", "o_orderkey", run))]
    return spark.createDataFrame(rows, "part bigint, rows_in bigint, late bigint")


# --- recommendations ---


def _sales(spark, folder):
    return adapters.sales_behavior(spark, folder)


@query
def cf_matrix_stats(spark, folder):
    return recommend.matrix_stats(recommend.rating_model(_sales(spark, folder)))


@query
def cf_rating_cells(spark, folder):
    return recommend.rating_model(_sales(spark, folder)).cells


@query
def cf_item_similarity(spark, folder):
    return recommend.item_similarity(recommend.rating_model(adapters.behavior(spark, folder)))


@query
def cf_user_similarity(spark, folder):
    return recommend.user_similarity(recommend.rating_model(adapters.behavior(spark, folder)))


@query
def cf_scores(spark, folder):
    """All scores of unseen items, both algorithms, rounded to six places."""
    scores = recommend.score_matrix(recommend.rating_model(adapters.behavior(spark, folder)))
    return scores.withColumns({name: F.round(name, 6) for name in ("item_score", "user_score")})


@query
def cf_recommendations(spark, folder):
    found = recommend.recommend(recommend.rating_model(_sales(spark, folder)))
    return found.withColumn("score", F.round("score", 6))


@query
def cf_recommendation_table(spark, folder):
    return recommend.recommendation_table(recommend.rating_model(_sales(spark, folder)))


@query
def cf_leave_one_out(spark, folder):
    return recommend.leave_one_out(recommend.rating_model(_sales(spark, folder)))[1]


@query
def cf_hit_rate(spark, folder):
    return recommend.evaluate(recommend.rating_model(_sales(spark, folder)))


@query
def hot_items(spark, folder):
    return recommend.hot_items(_sales(spark, folder))


@query
def cf_fallback(spark, folder):
    """What every user is shown: the published table, or the hot list for users without a recommendation.

    The log has three readers and is joined and written once."""
    sales = materialize_and_free(_sales(spark, folder), "sales")
    table = recommend.recommendation_table(recommend.rating_model(sales))
    return recommend.served(sales, table, recommend.hot_items(sales))


@query
def cf_examples(spark, folder):
    sales = _sales(spark, folder)
    return recommend.example_lists(recommend.rating_model(sales), recommend.hot_items(sales))
