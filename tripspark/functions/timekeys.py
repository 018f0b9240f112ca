"""Minute keys (yyyyMMddHHmm as a long) and the attributes that follow from them.

The keys are built and taken apart with integer arithmetic. No text is formatted or
parsed per row, and local timestamps never pass through the session time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import lit


# Dividing a key by the unit of a grain drops everything finer.
GRAIN_UNITS = {"minute": 1, "hour": 100, "day": 10_000}


def int_div(a: Column, b: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", a, lit(b))


def minute_key(ts: str) -> Column:
    """Minute key of a timestamp, date or timestamp text, given as SQL (usually a column)."""
    return F.expr(
        f"year({ts}) * 100000000L + month({ts}) * 1000000 + day({ts}) * 10000 "
        f"+ hour({ts}) * 100 + minute({ts})"
    )


def date_key(d: date) -> int:
    """The minute key of midnight of a Python date."""
    return (d.year * 10_000 + d.month * 100 + d.day) * 10_000


def unix_minute_key(ts: str) -> Column:
    """The earlier key form: epoch seconds rounded half up to a whole minute, as an int."""
    return F.expr(
        f"CAST((unix_date(CAST({ts} AS DATE)) * 1440L + hour({ts}) * 60 + minute({ts}) "
        f"+ IF(second({ts}) >= 30, 1, 0)) * 60 AS INT)"
    )


def key_year(key: Column) -> Column:
    return int_div(key, 100_000_000).cast("int")


def key_month(key: Column) -> Column:
    return (int_div(key, 1_000_000) % 100).cast("int")


def key_day(key: Column) -> Column:
    return (int_div(key, 10_000) % 100).cast("int")


def key_hour(key: Column) -> Column:
    return (int_div(key, 100) % 100).cast("int")


def key_minute(key: Column) -> Column:
    return (key % 100).cast("int")


def key_date(key: Column) -> Column:
    return F.make_date(key_year(key), key_month(key), key_day(key))


def key_epoch_minutes(key: Column) -> Column:
    return (
        F.unix_date(key_date(key)).cast("long") * 1440 + key_hour(key) * 60 + key_minute(key)
    )


def key_timestamp(key: Column) -> Column:
    """The key as a local timestamp."""
    return F.timestamp_add(
        "MINUTE", key_hour(key) * 60 + key_minute(key), key_date(key).cast("timestamp_ntz")
    )


def encoded_duration(pickup_key: Column, dropoff_key: Column) -> Column:
    """Key difference divided by 100, truncated.

    This is what the published queries call minutes. It counts whole hours inside a
    day and jumps at midnight; ``true_minutes`` is the real difference.
    """
    return int_div(dropoff_key - pickup_key, 100)


def true_minutes(pickup_key: Column, dropoff_key: Column) -> Column:
    return key_epoch_minutes(dropoff_key) - key_epoch_minutes(pickup_key)


def week_of_year(d: Column) -> Column:
    """Weeks of seven days counted from 1 January (not ISO weeks)."""
    return (int_div(F.dayofyear(d) - 1, 7) + 1).cast("int")


def day_of_week(d: Column) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return F.dayofweek(d) - 1
