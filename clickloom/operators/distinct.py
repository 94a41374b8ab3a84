"""Distinct users that merge: bitmaps for exact counts, sketches for estimates, of any span from stored parts.

A rollup keeps, for each key (a day, an hour) and behaviour, who was seen. Counting a longer span merges these parts and reads no
log. Bitmaps hold a user in one bit of a bucket of 32,768 ids, so their size follows from the ids seen, and a bucket is a row of its own:
buckets merge on the map side and spread over tasks. Sketches have a fixed size and a known relative error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.behavior import behavior_col

#: log2 of the entries of a sketch, and the relative standard error that they give.
SKETCH_LOG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG / 2)


def bitmap_rollup(df: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, behavior_type, bucket, users) of a log with whole-number user ids; a missing user is none."""
    known = df.where(F.col("user_id").isNotNull()).withColumn("behavior_type", behavior_col())
    bucket, bit = F.bitmap_bucket_number("user_id"), F.bitmap_bit_position("user_id")
    return known.groupBy(*keys, "behavior_type", bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("users"))


def merge_bitmaps(rollup: DataFrame, *keys: str) -> DataFrame:
    """A bitmap rollup at coarser or other keys."""
    return rollup.groupBy(*keys, "behavior_type", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def _bits(*behaviors: str) -> Column:
    seen = F.col("behavior_type").isin(*behaviors) if behaviors else F.lit(True)
    return F.coalesce(F.bitmap_count(F.bitmap_or_agg(F.when(seen, F.col("users")))), F.lit(0))


def users_of_bitmaps(rollup: DataFrame, *keys: str, **kinds: tuple[str, ...]) -> DataFrame:
    """Distinct users per key: one column for each entry of ``kinds``, name = behaviours, an empty tuple standing for any."""
    counted = rollup.groupBy(*keys, "bucket").agg(*[_bits(*behaviors).alias(name) for name, behaviors in kinds.items()])
    return counted.groupBy(*keys).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in kinds])


def sketch_rollup(df: DataFrame, *keys: str, log_entries: int = SKETCH_LOG) -> DataFrame:
    """Rows (keys, behavior_type, users) with a sketch of fixed size; ids of any type, as text."""
    known = df.where(F.col("user_id").isNotNull()).withColumn("behavior_type", behavior_col())
    return known.groupBy(*keys, "behavior_type").agg(F.hll_sketch_agg(F.col("user_id").cast("string"), F.lit(log_entries)).alias("users"))


def users_of_sketches(rollup: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct users per key, off by about ``SKETCH_ERROR`` of the count (standard error)."""
    return rollup.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


def trailing_days(rollup: DataFrame, days: int, day: str = "dt") -> DataFrame:
    """Every part under the day it belongs to and the ``days`` - 1 after it, up to the last day there is, as ``until``: the parts, not the events, are copied."""
    last = rollup.select(F.to_date(F.max(day))).scalar()
    start = F.to_date(F.col(day))
    ends = F.sequence(start, F.least(F.date_add(start, days - 1), last))
    spread = rollup.withColumn("until", F.explode(ends))
    return spread.withColumn("until", F.date_format("until", "yyyy-MM-dd"))
