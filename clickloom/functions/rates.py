"""Guarded ratios, rounding and printable numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schema import PEOPLE_UNIT


def ratio(part: Column, whole: Column, places: int | None = None) -> Column:
    """``part / whole`` as a double, NULL where the denominator is zero."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if places is None else F.round(value, places)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def rate_decimal(part: Column, whole: Column) -> Column:
    """Warehouse rate: ``decimal(10,4)``, half up, NULL where the denominator is zero."""
    return ratio(part, whole).cast("decimal(10,4)")


def percent(part: Column, whole: Column, places: int) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), places)


def people_label(count: Column, share: Column | None = None) -> Column:
    """``1,234 人`` or ``1,234 人（5.6%）``."""
    people = F.concat(F.format_number(count, 0), F.lit(f" {PEOPLE_UNIT}"))
    if share is None:
        return people
    return F.concat(people, F.lit("（"), F.format_number(share * 100, 1), F.lit("%）"))


def points_label(points: Column) -> Column:
    """Signed difference in percentage points, ``+0.12pct``; NULL for an undefined one."""
    return F.when(points.isNotNull(), F.format_string("%+.2fpct", points))
