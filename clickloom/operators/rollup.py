"""Per-user pre-aggregation, the base of every count that also needs distinct users.

Rows are first combined to one row per (keys, user), on the map side and then by a shuffle on all
of these columns, so neither a hot key (one hour, one day) nor a hot user lands whole in a task.
Distinct users are then a plain count, and conditional distinct users a conditional count, without
the row expansion that several ``count(distinct ..)`` in one query would cause.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.behavior import counters
from clickloom.schema import BEHAVIORS

COUNTERS = ("actions", *BEHAVIORS)


def user_rollup(df: DataFrame, *keys: str) -> DataFrame:
    """One row per (keys, user) with ``actions`` and one counter per behaviour."""
    return df.groupBy(*keys, "user_id").agg(*counters())


def regroup(rollup: DataFrame, *keys: str) -> DataFrame:
    """A rollup at a coarser set of keys."""
    return rollup.groupBy(*keys, "user_id").agg(*[F.sum(name).alias(name) for name in COUNTERS])


def total(name: str) -> Column:
    """Sum of a counter, zero on empty input."""
    return F.coalesce(F.sum(name), F.lit(0))


def people() -> Column:
    """Distinct users; a missing user id is not a user."""
    return F.count("user_id")


def people_with(*behaviors: str) -> Column:
    """Distinct users with at least one of the behaviours."""
    seen = sum((F.col(name) for name in behaviors[1:]), F.col(behaviors[0]))
    return F.count_if(F.col("user_id").isNotNull() & (seen > 0))
