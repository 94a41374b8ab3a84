"""Behaviour codes: names, weights, integer codes and conditional counters."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schema import (
    BEHAVIOR_CODES,
    BEHAVIOR_NAMES,
    BEHAVIOR_WEIGHTS,
    BEHAVIORS,
    UNKNOWN_BEHAVIOR,
)

def behavior_col() -> Column:
    return F.col("behavior_type")


def choose(key: Column, table: dict, default=None) -> Column:
    """Look ``key`` up in a small constant table."""
    chain = F
    for entry, value in table.items():
        chain = chain.when(key == entry, F.lit(value))
    return chain.otherwise(default)


def behavior_name(kind: Column) -> Column:
    return choose(kind, BEHAVIOR_NAMES, UNKNOWN_BEHAVIOR)


def behavior_order(kind: Column) -> Column:
    return choose(kind, {name: place for place, name in enumerate(BEHAVIORS)})


def behavior_from_code(code: Column) -> Column:
    return choose(code, BEHAVIOR_CODES)


def behavior_weight(kind: Column) -> Column:
    return choose(kind, BEHAVIOR_WEIGHTS)


def is_legal(kind: Column) -> Column:
    return kind.isin(*BEHAVIORS)


def parse_bigint(text: Column) -> Column:
    """Text to bigint; text that is no number becomes NULL."""
    return text.try_cast("bigint")


def counters(where: Column | None = None, prefix: str = "") -> list[Column]:
    """One counter per behaviour plus ``actions`` for all rows, optionally of a slice."""
    inside = F.lit(True) if where is None else where
    total = F.count("*") if where is None else F.count_if(where)
    return [total.alias(f"{prefix}actions")] + [
        F.count_if((behavior_col() == kind) & inside).alias(f"{prefix}{kind}") for kind in BEHAVIORS
    ]
