"""Aggregates shared by the gold queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import timekeys as tk
from tripspark.functions.buckets import tip_percentage
from tripspark.operators import exact
from tripspark.operators.exact import Measure


def trips():
    return F.count(lit(1)).alias("trip_count")


def trip_count() -> Measure:
    return exact.count_rows("trip_count")


def avg_fare() -> Measure:
    return exact.exact_avg("FareAmount", "avg_fare")


def avg_distance() -> Measure:
    return exact.exact_avg("TripDistance", "avg_distance")


def revenue(name: str = "total_revenue") -> Measure:
    return exact.exact_sum("TotalAmount", name)


def avg_revenue() -> Measure:
    return exact.exact_avg("TotalAmount", "avg_revenue_per_trip")


def avg_tip_percentage() -> Measure:
    percent = tip_percentage(col("TipAmount"), col("FareAmount"))
    return exact.avg_percent(percent, "avg_tip_percentage")


def avg_duration(name: str = "avg_duration_minutes") -> Measure:
    return exact.whole_avg(duration(), name)


def avg_true_duration(name: str = "avg_duration_minutes") -> Measure:
    return exact.whole_avg(true_duration(), name)


def duration():
    """The published duration: key difference over 100 (see ``encoded_duration``)."""
    return tk.encoded_duration(col("PickupDateTimeID"), col("DropOffDateTimeID"))


def true_duration():
    return tk.true_minutes(col("PickupDateTimeID"), col("DropOffDateTimeID"))
