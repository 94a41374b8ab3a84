"""Filters, typing and de-duplication of the behaviour log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.behavior import (
    behavior_col,
    behavior_from_code,
    behavior_name,
    is_legal,
    parse_bigint,
)
from clickloom.functions.time import epoch_to_datetime, epoch_to_day, epoch_to_text, hour_of
from clickloom.schema import CLEAN_FROM, CLEAN_UNTIL, DWD_COLUMNS, ODS_COLUMNS


def drop_missing(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def keep_legal(df: DataFrame) -> DataFrame:
    return df.where(is_legal(behavior_col()))


def with_datetime(df: DataFrame) -> DataFrame:
    return df.withColumn("datetime", epoch_to_datetime(F.col("timestamp")))


def in_range(moment: Column, start: str, end: str) -> Column:
    """Half-open time range: start inside, end outside."""
    return (moment >= F.lit(start).cast("timestamp")) & (moment < F.lit(end).cast("timestamp"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication as a hash aggregate; copies of a row combine before the shuffle."""
    return df.dropDuplicates()


def clean_behavior(raw: DataFrame, start: str = CLEAN_FROM, end: str = CLEAN_UNTIL) -> DataFrame:
    """Typed raw log -> clean log: complete, legal, in range, without copies."""
    typed = with_datetime(keep_legal(drop_missing(raw)))
    return dedup_rows(typed.where(in_range(F.col("datetime"), start, end)))


def to_ods(df: DataFrame) -> DataFrame:
    """Landing layer: every field as text, nothing else changed."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in ODS_COLUMNS])


def has_key_fields(*names: str) -> Column:
    """Every named text column present and not empty."""
    kept = F.lit(True)
    for name in names:
        kept = kept & F.col(name).isNotNull() & (F.col(name) != "")
    return kept


def to_dwd(ods: DataFrame) -> DataFrame:
    """Detail layer: filtered and de-duplicated as text, then typed, named and dated."""
    kept = keep_legal(ods.where(has_key_fields("user_id", "item_id", "category_id", "timestamp")))
    typed = dedup_rows(kept.select(*ODS_COLUMNS)).select(
        *[parse_bigint(F.col(name)).alias(name) for name in ("user_id", "item_id", "category_id")],
        "behavior_type",
        parse_bigint(F.col("timestamp")).alias("ts"),
    )
    complete = typed.na.drop("any")
    return complete.select(
        "user_id",
        "item_id",
        "category_id",
        "behavior_type",
        behavior_name(behavior_col()).alias("behavior_name"),
        epoch_to_text(F.col("ts")).alias("datetime"),
        epoch_to_day(F.col("ts")).alias("dt"),
    ).select(*DWD_COLUMNS)


def with_named_codes(df: DataFrame) -> DataFrame:
    """Integer behaviour codes 1..4 -> the enum used everywhere else."""
    return df.withColumn("behavior_type", behavior_from_code(behavior_col()))


def prepare(df: DataFrame) -> DataFrame:
    """Add ``hour`` and ``behavior_name`` for reports."""
    typed = df.withColumn("datetime", F.col("datetime").cast("timestamp"))
    return typed.withColumns(
        {"hour": hour_of(F.col("datetime")), "behavior_name": behavior_name(behavior_col())}
    )


def slice_condition(hours: tuple[int, int] | None = None, behaviors: list[str] | None = None) -> Column:
    """Hour range with both ends inside, and behaviours; an empty choice means no filter."""
    kept = F.lit(True)
    if hours:
        kept = kept & hour_of(F.col("datetime")).between(*hours)
    if behaviors:
        kept = kept & behavior_col().isin(*behaviors)
    return kept


def slice_behavior(df: DataFrame, hours=None, behaviors=None) -> DataFrame:
    return df.where(slice_condition(hours, behaviors))

