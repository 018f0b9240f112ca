"""Dashboard charts. Each reads the fact and at most one dimension, not the wide dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.functions import timekeys as tk
from tripspark.operators.exact import aggregate
from tripspark.operators.histogram import histogram
from tripspark.operators.star import Star, with_payment, with_pickup, with_trip_key
from tripspark.plans import measures as m


def _trips():
    return F.count("TripID").alias("trip_count")


def chart_total_trips(star: Star) -> DataFrame:
    return star.good().agg(F.count("TripID").alias("total_trips"))


def chart_total_revenue(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.revenue())


def chart_daily(star: Star) -> DataFrame:
    """Trips per day; trips outside the calendar form the NULL group."""
    return _per_grain(star, "day")


def chart_hourly(star: Star) -> DataFrame:
    """Trips per hour of ``trip_date``. That column is a date, so this equals the daily chart."""
    return _per_grain(star, "day")


def chart_hourly_true(star: Star) -> DataFrame:
    """Trips per hour of the pickup minute."""
    return _per_grain(star, "hour")


def _per_grain(star: Star, grain: str) -> DataFrame:
    """Grouped on the key cut to the grain; timestamps are built for grouped rows only."""
    cut = tk.int_div(col("trip_key"), tk.GRAIN_UNITS[grain])
    grouped = with_trip_key(star.good(), star).groupBy(cut.alias("cut")).agg(_trips())
    at = tk.key_timestamp(col("cut") * tk.GRAIN_UNITS[grain])
    return grouped.select(at.alias("trip_time"), "trip_count").orderBy("trip_time")


def chart_borough(star: Star) -> DataFrame:
    """Trips per borough, places without one included."""
    return with_pickup(star.good(), star).groupBy("pickup_borough").agg(_trips())


def chart_payment_revenue(star: Star) -> DataFrame:
    return aggregate(with_payment(star.good(), star), ["payment_type"], m.revenue())


def hist_distance(star: Star) -> DataFrame:
    return histogram(star.good(), "TripDistance", 20)


def hist_fare(star: Star) -> DataFrame:
    return histogram(star.good(), "FareAmount", 20)


def per_time_grain(df: DataFrame, ts: str, grain: str) -> DataFrame:
    """Row counts of a local timestamp cut to ``day`` or ``hour``.

    ``date_trunc`` would take the timestamp through the session time zone.
    """
    unit = tk.GRAIN_UNITS[grain]
    grouped = df.groupBy(tk.int_div(tk.minute_key(ts), unit).alias("cut")).agg(
        F.count("*").alias("n")
    )
    at = tk.key_timestamp(col("cut") * unit)
    return grouped.select(at.alias("period"), "n").orderBy("period")
