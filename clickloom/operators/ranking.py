"""Top-k with a total order. Ties are always settled by ascending id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int | None, by: list[str], tie: str) -> DataFrame:
    """The k largest rows; a per-task top-k and a merge, not a full sort."""
    ordered = df.orderBy(*[F.desc(name) for name in by], F.asc(tie))
    return ordered if k is None else ordered.limit(k)


def preview(df: DataFrame, rows: int, by: list[str] | None = None) -> DataFrame:
    """The first rows in a stated order (default: by all columns), for display."""
    return df.orderBy(*(by or df.columns)).limit(rows)


def number_rows(df: DataFrame, by: list[str], tie: str, name: str = "rank") -> DataFrame:
    """Number a result that a top-k already made small."""
    order = Window.orderBy(*[F.desc(column) for column in by], F.asc(tie))
    return df.withColumn(name, F.row_number().over(order))


def top_per_group(df: DataFrame, groups: list[str], k: int, by: list, tie: str) -> DataFrame:
    """The k best rows of each group, numbered; Spark limits groups before the shuffle."""
    order = Window.partitionBy(*groups).orderBy(*by, F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def heaviest_cell(cells: DataFrame, min_cells: int = 3) -> DataFrame:
    """Per user with enough cells, the item of the largest weight, lowest id on ties.

    A plain aggregate: no sort, and map-side combined."""
    best = F.min(F.struct((-F.col("weight")).alias("w"), F.col("item_id"))).alias("best")
    per_user = cells.groupBy("user_id").agg(F.count("*").alias("n"), best)
    return per_user.where(F.col("n") >= min_cells).select("user_id", F.col("best.item_id").alias("item_id"))
