"""Event-time expressions. The session time zone is pinned to UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_datetime(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_to_text(seconds: Column) -> Column:
    return F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss")


def epoch_to_day(seconds: Column) -> Column:
    return F.from_unixtime(seconds, "yyyy-MM-dd")


def hour_of(moment: Column) -> Column:
    """Hour of a timestamp, or of its ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.hour(moment.cast("timestamp"))


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def whole_hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours, cut off rather than rounded, never below zero."""
    return F.greatest(F.timestamp_diff("HOUR", start, end), F.lit(0))


def plus_minutes(moment: Column, minutes: int) -> Column:
    return moment + F.make_dt_interval(mins=F.lit(minutes))


def window_label(start: Column, end: Column) -> Column:
    return F.concat_ws("~", F.date_format(start, "HH:mm"), F.date_format(end, "HH:mm"))
