"""Collaborative-filtering recall, its offline evaluation and the popularity fallback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.behavior import behavior_col, behavior_weight
from clickloom.functions.rates import ratio
from clickloom.operators.products import Size, candidate_scores, neighbours
from clickloom.operators.ranking import heaviest_cell, number_rows, top_k, top_per_group
from clickloom.schema import (
    HOT_ITEMS,
    MIN_ITEM_USERS,
    MIN_USER_ACTIONS,
    NEIGHBOURS,
    TABLE_TOP_K,
    TOP_K,
)
from clickloom.session import materialize_and_free as materialize

ALGORITHMS = {"UserCF": "user_score", "ItemCF": "item_score"}


@dataclass(frozen=True)
class RatingModel:
    """The rating matrix as cells (user_id, item_id, weight), with its sizes by item and by user."""

    cells: DataFrame
    items: Size
    users: Size

    @staticmethod
    def of(cells: DataFrame) -> "RatingModel":
        n, names = F.col("n"), ("item_id", "user_id")
        sized = [cells.groupBy(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n") for name in names]
        summed = sized[0].union(sized[1]).groupBy("kind").agg(F.count("*"), F.sum(n), F.max(n), F.sum(n * n))
        found = {row[0]: Size(*row[1:]) for row in summed.collect()}
        return RatingModel(cells, *[found.get(name, Size()) for name in names])


def rating_model(
    df: DataFrame, min_item_users: int = MIN_ITEM_USERS, min_user_actions: int = MIN_USER_ACTIONS
) -> RatingModel:
    """Items with enough users, users with enough actions on these items, and the heaviest behaviour
    per (user, item); no limit on how many.

    The log is read once: everything follows from one row per (user, item), which is combined before
    the shuffle, so hot items and users are collapsed, and written once."""
    combined = df.where(F.col("user_id").isNotNull()).groupBy("user_id", "item_id").agg(
        F.max(behavior_weight(behavior_col())).alias("weight"), F.count("*").alias("actions")
    )
    combined = materialize(combined, "pairs")
    items = combined.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_item_users)
    kept = combined.join(items.select("item_id"), "item_id", "left_semi")
    # One shuffle by user, instead of one for the sums and one to join them; the cells stay in order of their users.
    active = kept.withColumn("n", F.sum("actions").over(Window.partitionBy("user_id"))).where(F.col("n") >= min_user_actions)
    cells = active.where(F.col("weight").isNotNull())
    return RatingModel.of(materialize(cells.select("user_id", "item_id", "weight"), "cells"))


def matrix_stats(model: RatingModel) -> DataFrame:
    """n_users, n_items, cells and density of the rating matrix: the numbers that the model holds."""
    sizes = {"n_users": model.users.entities, "n_items": model.items.entities, "cells": model.items.cells}
    known = model.cells.sparkSession.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in sizes.items()])
    return known.withColumn("density", ratio(F.col("cells"), F.col("n_users") * F.col("n_items")))


def _squares(cells: DataFrame, entity: str) -> DataFrame:
    return cells.groupBy(entity).agg(F.sum(F.col("weight") * F.col("weight")).alias("square"))


def _nearest(model: RatingModel, entity: str, shared: str, k: int) -> DataFrame:
    cells = model.cells.join(_squares(model.cells, entity), entity).select(
        F.col(entity).alias("entity"), F.col(shared).alias("shared"), "weight", "square"
    )
    own, other = (model.items, model.users) if entity == "item_id" else (model.users, model.items)
    best = top_per_group(neighbours(cells, own.entities, other, k), ["entity"], k, [F.round("sim", 6).desc()], "neighbour")
    return best.select(F.col("entity").alias(entity), "rank", "neighbour", "sim")


def item_similarity(model: RatingModel, k: int = NEIGHBOURS) -> DataFrame:
    """The k items of the largest cosine for every item: item_id, rank, neighbour, sim."""
    return _nearest(model, "item_id", "user_id", k)


def user_similarity(model: RatingModel, k: int = NEIGHBOURS) -> DataFrame:
    """The k users of the largest cosine for every user: user_id, rank, neighbour, sim."""
    return _nearest(model, "user_id", "item_id", k)


def _scores(model: RatingModel, users: DataFrame | None, k: int | None) -> DataFrame:
    # A cell meets, on average, so many users, and each of them so many of their cells.
    total = max(model.users.cells, 1)
    each = model.items.pairs / total * model.users.pairs / total
    if users is None:
        return candidate_scores(model.cells, model.users.cells * each, model.users.entities, model.users, model.items, k)
    users = users.select("user_id").distinct()
    rated = model.cells.groupBy("user_id").agg(F.count("*").alias("n")).join(users, "user_id", "left_semi")
    n_users, n_cells = rated.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return candidate_scores(model.cells, n_cells * each, n_users, model.users, model.items, k, users, own_cells=n_cells)


def score_matrix(model: RatingModel) -> DataFrame:
    """All scores above zero of unseen items: (user_id, item_id, item_score, user_score)."""
    return _scores(model, None, None)


def recommend(model: RatingModel, k: int = TOP_K, users: DataFrame | None = None) -> DataFrame:
    """Both algorithms' k best unseen items per user: user_id, algorithm, rank, item_id, score.

    Ranked by the score rounded to six places, so that the order of a sum cannot decide; then by id."""
    tagged = F.array(
        *[F.struct(F.lit(name).alias("algorithm"), F.col(column).alias("score")) for name, column in ALGORITHMS.items()]
    )
    long = _scores(model, users, k).select("user_id", "item_id", F.inline(tagged)).where(F.col("score") > 0)
    best = top_per_group(long, ["user_id", "algorithm"], k, [F.round("score", 6).desc()], "item_id")
    return best.select("user_id", "algorithm", "rank", "item_id", "score")


def recommendation_table(model: RatingModel, k: int = TABLE_TOP_K) -> DataFrame:
    """The published table: both algorithms, k items for every user, score with four decimals."""
    return recommend(model, k).withColumn("score", F.round("score", 4))


def leave_one_out(model: RatingModel, min_cells: int = 3) -> tuple[RatingModel, DataFrame]:
    """Hide the heaviest cell of every user with enough cells: (training model, hidden cells).

    At most one hidden cell per user of the model. Both have many readers and are written once."""
    hidden = materialize(heaviest_cell(model.cells, min_cells), "hidden")
    # Joined by user alone, so that the cells of a user stay together.
    known = model.cells.join(hidden.withColumnRenamed("item_id", "hidden"), "user_id", "left")
    kept = known.where(~F.coalesce(F.col("item_id") == F.col("hidden"), F.lit(False))).select(model.cells.columns)
    return RatingModel.of(materialize(kept, "training")), hidden


def evaluate(model: RatingModel, k: int = TOP_K, min_cells: int = 3) -> DataFrame:
    """Hit rate at k per algorithm against a random choice: algorithm, k, evaluated_users, hits,
    hit_rate, random_hit_rate, lift."""
    training, hidden = leave_one_out(model, min_cells)
    found = recommend(training, k, hidden.select("user_id")).join(hidden, ["user_id", "item_id"], "left_semi")
    hits = found.groupBy("algorithm").agg(F.count("*").alias("hits"))
    # every evaluated user keeps at least min_cells - 1 cells, so none is missing here
    pools = training.cells.groupBy("user_id").agg((F.lit(model.items.entities) - F.count("*")).alias("pool"))
    pools = pools.join(hidden.select("user_id"), "user_id", "left_semi")
    base = pools.agg(
        F.count("*").alias("evaluated_users"), F.try_divide(F.lit(float(k)), F.avg("pool")).alias("random_hit_rate")
    )
    names = base.select(F.explode(F.array(*[F.lit(name) for name in ALGORITHMS])).alias("algorithm"), "*")
    rate = ratio(F.col("hits"), F.col("evaluated_users"))
    return (
        names.join(hits, "algorithm", "left")
        .withColumn("hits", F.coalesce("hits", F.lit(0)))
        .select(
            "algorithm",
            F.lit(k).alias("k"),
            "evaluated_users",
            "hits",
            rate.alias("hit_rate"),
            "random_hit_rate",
            F.try_divide(rate, F.col("random_hit_rate")).alias("lift"),
        )
    )


def hot_items(df: DataFrame, k: int = HOT_ITEMS) -> DataFrame:
    """Items by carts and purchases: item_id, interactions, rank."""
    counted = df.where(behavior_col().isin("buy", "cart")).groupBy("item_id").agg(F.count("*").alias("interactions"))
    return number_rows(top_k(counted, k, ["interactions"], "item_id"), ["interactions"], "item_id")


def _hot_list(hot: DataFrame) -> Column:
    """The hot list as one array value, a scalar subquery over its few rows."""
    entry = F.struct("rank", "item_id", "interactions")
    return hot.agg(F.sort_array(F.collect_list(entry))).scalar()


def fallback(users: DataFrame, recommended: DataFrame, hot: DataFrame) -> DataFrame:
    """The hot list for every user without a recommendation."""
    uncovered = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    uncovered = uncovered.join(recommended.select("user_id").distinct(), "user_id", "left_anti")
    return uncovered.select("user_id", F.inline(_hot_list(hot))).select(
        "user_id", F.lit("Hot").alias("algorithm"), F.col("rank"), "item_id", "interactions"
    )


def served(users: DataFrame, recommended: DataFrame, hot: DataFrame) -> DataFrame:
    """What every user is shown: the own recommendations where there are any, else the hot list. The recommendations have two readers and are written once."""
    recommended = materialize(recommended, "recommended")
    own = recommended.select("user_id", F.col("algorithm").alias("source"), F.col("rank").cast("int").alias("rank"), "item_id")
    rest = fallback(users, recommended, hot)
    return own.unionByName(rest.select("user_id", F.col("algorithm").alias("source"), F.col("rank").cast("int").alias("rank"), "item_id"))


def example_lists(model: RatingModel, hot: DataFrame, users: int = 3, k: int = TOP_K) -> DataFrame:
    """Lists of the first users by id, and of the user with the fewest cells, who gets the hot list:
    example, user_id, cells, algorithm, rank, item_id."""
    sizes = model.cells.groupBy("user_id").agg(F.count("*").alias("cells"))
    first = sizes.orderBy("user_id").limit(users)
    cold = sizes.orderBy("cells", "user_id").limit(1)
    lists = recommend(model, k, first.select("user_id")).join(F.broadcast(first), "user_id")
    warm = lists.select(F.lit("first").alias("example"), "user_id", "cells", "algorithm", "rank", "item_id")
    listed = cold.select("user_id", "cells", F.inline(_hot_list(hot))).where(F.col("rank") <= k)
    chilled = listed.select(F.lit("cold").alias("example"), "user_id", "cells", F.lit("Hot").alias("algorithm"), "rank", "item_id")
    return warm.unionByName(chilled)
