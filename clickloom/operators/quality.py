"""Data-quality operators: audits, reports, comparison of tables and exact descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.behavior import behavior_col, is_legal, parse_bigint
from clickloom.functions.rates import ratio
from clickloom.operators.cleaning import has_key_fields, in_range, with_datetime
from clickloom.schema import CLEAN_FROM, CLEAN_UNTIL, ODS_COLUMNS
from clickloom.session import materialize


SKETCH_ACCURACY = 100_000  # rank error of an approximate quantile: rows / accuracy
SLICES = 1024  # equal parts of a bracket's range that are ordered one by one


class EmptyLoadError(RuntimeError):
    """A load that must bring rows brought none."""


def audit_lines(lines: DataFrame) -> DataFrame:
    """Raw text lines: rows and rows per behaviour among lines of exactly five fields."""
    fields = F.split(F.rtrim(F.col("value")), ",")
    parts = lines.select(fields.alias("fields")).where(F.size("fields") == 5)
    return _with_total(parts.groupBy(F.col("fields")[3].alias("behavior_type")).agg(F.count("*").alias("cnt")))


def _with_total(counted: DataFrame) -> DataFrame:
    """Counts and their sum, a scalar subquery: a dirty log may have any number of groups."""
    return counted.withColumn("total", counted.select(F.sum("cnt")).scalar())


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass: (column_name, missing)."""
    names = df.columns
    wide = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return wide.unpivot([], names, "column_name", "missing")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; NULLs compare equal."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_cnt"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def clean_report(raw: DataFrame, start: str = CLEAN_FROM, end: str = CLEAN_UNTIL) -> DataFrame:
    """Rows left and removed after each cleaning step, in one scan and one shuffle.

    Each row gets the number of steps it passes. Rows that fail collapse to one group per step, rows
    that pass are grouped as a whole, so the number of groups is the number of distinct rows."""
    names = ODS_COLUMNS
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    dated = with_datetime(raw.select(*names))
    passed = (
        F.when(~complete, 0)
        .when(~is_legal(behavior_col()), 1)
        .when(~in_range(F.col("datetime"), start, end), 2)
        .otherwise(3)
    )
    staged = dated.select(passed.alias("passed"), *names)
    survivor = F.col("passed") == 3
    grouped = (
        staged.select("passed", *[F.when(survivor, F.col(name)).alias(name) for name in names])
        .groupBy("passed", *names)
        .agg(F.count("*").alias("copies"))
    )

    def rows_from(step):
        kept = F.when(F.col("passed") >= step, F.col("copies")).otherwise(0)
        return F.coalesce(F.sum(kept), F.lit(0))

    counted = grouped.agg(
        rows_from(0).alias("raw_rows"),
        rows_from(1).alias("after_missing"),
        rows_from(2).alias("after_enum"),
        rows_from(3).alias("after_range"),
        F.count_if(survivor).alias("after_dedup"),
    )
    steps = ["raw_rows", "after_missing", "after_enum", "after_range", "after_dedup"]
    removed = ["removed_missing", "removed_enum", "removed_range", "removed_dedup"]
    return counted.select(
        *steps,
        *[(F.col(a) - F.col(b)).alias(name) for a, b, name in zip(steps, steps[1:], removed)],
        ratio(F.col("after_dedup"), F.col("raw_rows")).alias("retention"),
    )


def clean_profile(clean: DataFrame) -> DataFrame:
    """Span and distinct users, items and categories of a clean log.

    Each distinct count is a scalar subquery of its own column, so rows are never multiplied."""

    def distinct(name):
        return clean.where(F.col(name).isNotNull()).select(name).distinct().select(F.count("*")).scalar()

    spanned = clean.agg(
        F.count("*").alias("row_cnt"),
        F.min("datetime").alias("first_time"),
        F.max("datetime").alias("last_time"),
        ((F.unix_seconds(F.max("datetime")) - F.unix_seconds(F.min("datetime"))) / 60).alias("span_minutes"),
    )
    return spanned.select(
        "*",
        distinct("user_id").alias("users"),
        distinct("item_id").alias("items"),
        distinct("category_id").alias("categories"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), F.asc(column))


def load_verification(loaded: DataFrame) -> DataFrame:
    """Row count and rows per behaviour of a table read back after a load."""
    return _with_total(value_counts(loaded, "behavior_type"))


def require_rows(loaded: DataFrame) -> DataFrame:
    """Fail a load that left the table empty; stops at the first row found."""
    if loaded.isEmpty():
        raise EmptyLoadError("the loaded table is empty")
    return loaded


def layer_audit(ods: DataFrame) -> DataFrame:
    """Row counts of the landing and of the detail layer made from it, and the rows removed between them.

    One scan and one shuffle: rows that stay are grouped as a whole, the others collapse to one group."""
    ids = [name for name in ODS_COLUMNS if name != "behavior_type"]
    kept = F.coalesce(has_key_fields(*ids) & is_legal(behavior_col()), F.lit(False))
    flagged = ods.select(kept.alias("kept"), *ODS_COLUMNS)
    grouped = (
        flagged.select("kept", *[F.when(F.col("kept"), F.col(name)).alias(name) for name in ODS_COLUMNS])
        .groupBy("kept", *ODS_COLUMNS)
        .agg(F.count("*").alias("copies"))
    )
    typed = F.col("kept")
    for name in ids:
        typed = typed & parse_bigint(F.col(name)).isNotNull()
    counts = grouped.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("ods_rows"), F.count_if(typed).alias("dwd_rows")
    )
    return counts.withColumn("removed_rows", F.col("ods_rows") - F.col("dwd_rows"))


def compare_grouped(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Two grouped results side by side: left_*, right_* and ``matches`` (NULL-safe, both present)."""
    a = left.select(*keys, *[F.col(v).alias(f"left_{v}") for v in values], F.lit(True).alias("in_left"))
    b = right.select(*keys, *[F.col(v).alias(f"right_{v}") for v in values], F.lit(True).alias("in_right"))
    joined = a.join(b, keys, "full_outer")
    same = F.col("in_left").isNotNull() & F.col("in_right").isNotNull()
    for value in values:
        same = same & F.col(f"left_{value}").eqNullSafe(F.col(f"right_{value}"))
    return joined.withColumn("matches", same).drop("in_left", "in_right")


def mismatches(compared: DataFrame) -> DataFrame:
    return compared.where(~F.col("matches"))


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two tables; empty means equal.

    One shuffle of pre-counted rows."""
    names = left.columns
    signed = left.withColumn("surplus", F.lit(1)).unionByName(right.select(*names).withColumn("surplus", F.lit(-1)))
    return signed.groupBy(*names).agg(F.sum("surplus").alias("surplus")).where(F.col("surplus") != 0)


def describe_values(df: DataFrame, columns: list[str], quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, exact quartiles (linear interpolation) and max per numeric column.

    Three scans and no sort of the data; whole numbers are described as such beside fractions. The first counts the
    values. The second brackets every quantile between two approximate ones, further apart than the sketch's guaranteed
    rank error and a few ranks more, so the wanted ranks are always inside. The third counts the rows between
    the brackets, one group each, and the values inside them; all of it is combined before the shuffle and
    written as a small table. A bracket is cut into slices of its range, ordered one by one."""
    whole = [name for name in columns if isinstance(df.schema[name].dataType, T.IntegralType)]
    rest = [name for name in columns if name not in whole]
    parts = [_describe(df, names, kind, sorted(quantiles)) for names, kind in ((whole, "bigint"), (rest, "double")) if names]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _describe(df: DataFrame, columns: list[str], kind: str, quantiles: list[float]) -> DataFrame:
    typed = df.select(*[F.col(name).cast(kind).alias(name) for name in columns])
    sizes = typed.agg(*[F.count(name).alias(name) for name in columns]).first()
    value = F.col("value")

    def summed(name):
        margin = 4 / SKETCH_ACCURACY + 8 / max(sizes[name], 1)
        marks = [min(1.0, max(0.0, q + side)) for side in (-margin, margin) for q in quantiles]
        return F.struct(
            F.count(name).alias("count"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("std"),
            F.min(name).alias("min"),
            F.max(name).alias("max"),
            F.percentile_approx(name, F.array(*map(F.lit, marks)), F.lit(SKETCH_ACCURACY)).alias("marks"),
        ).alias(name)

    wide = typed.agg(*[summed(name) for name in columns])
    summary = wide.unpivot([], columns, "column_name", "found").select("column_name", "found.*").where("count > 0")
    long = typed.unpivot([], columns, "column_name", "value").where(value.isNotNull())
    stats, k = ["count", "mean", "std", "min", "max"], len(quantiles)
    edges = [F.slice("marks", 1, k).alias("lows"), F.slice("marks", k + 1, k).alias("highs")]
    # the broadcast side has one row per described column
    bracketed = long.join(F.broadcast(summary.select("column_name", *stats, *edges)), "column_name")

    inside, passed = F.lit(False), F.lit(0)
    for place in range(k):
        inside = inside | value.between(F.col("lows")[place], F.col("highs")[place])
        passed = passed + (value > F.col("highs")[place]).cast("int")
    bracketed = bracketed.withColumns({"passed": passed, "near": F.when(inside, value)})
    low, high = (F.get(F.col(side), F.col("passed")).cast("double") for side in ("lows", "highs"))
    depth = F.floor(F.try_divide(F.col("near").cast("double") - low, high - low) * SLICES)
    # rows in front of a bracket are one NULL entry in a slice of its own, which comes first
    part = F.when(F.col("near").isNull(), -1).otherwise(F.coalesce(depth, F.lit(0)))
    counted = materialize(
        bracketed.groupBy("column_name", "passed", part.alias("part"), "near").agg(
            F.count("*").alias("n"), *[F.first(name).alias(name) for name in stats]
        ),
        "near-quantiles",
    )
    parts = counted.groupBy("column_name", "passed", "part").agg(F.sum("n").alias("size"))
    ahead = Window.partitionBy("column_name").orderBy("passed", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("column_name", "passed", "part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    order = Window.partitionBy("column_name", "passed", "part").orderBy("near")
    # at most SLICES + 2 rows for each quantile of a column
    placed = counted.join(F.broadcast(offsets), ["column_name", "passed", "part"]).withColumn(
        "upto", F.col("offset") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )

    def value_at(place):
        here = (place >= F.col("upto") - F.col("n")) & (place < F.col("upto"))
        return F.max(F.when(here, F.col("near").cast("double")))

    points = []
    for q in quantiles:
        position = (F.col("count") - 1) * q
        below, above = value_at(F.floor(position)), value_at(F.ceil(position))
        share = F.max(position - F.floor(position))
        points.append((below + (above - below) * share).alias(f"p{round(q * 100)}"))
    least, most = (F.first(name).cast("double").alias(name) for name in ("min", "max"))
    known = [F.first(name).alias(name) for name in ("count", "mean", "std")]
    return placed.groupBy("column_name").agg(*known, least, *points, most)
