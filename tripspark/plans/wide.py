"""Wide datasets: the good trips with the attributes of every dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import col

from tripspark.functions import buckets, labels
from tripspark.operators.star import (
    Star,
    with_day_of_week,
    with_dropoff,
    with_payment,
    with_pickup,
    with_rate,
    with_time,
)
from tripspark.plans import measures as m
from tripspark.schemas import FACT_TRIP

CORE = [
    "tripid", "pickupdatetimeid", "dropoffdatetimeid", "passengercount",
    "tripdistance", "fareamount", "tipamount", "totalamount",
]
PLACES = ["pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough"]
KINDS = ["payment_type", "rate_description"]
HOURS = ["trip_date", "trip_year", "trip_month", "trip_hour"]
FACT = [f.name.lower() for f in FACT_TRIP.fields]

# Rows that agree on all of these agree on every column shown, so a limit after this
# order always keeps the same rows.
STABLE_ORDER = [
    "PickupDateTimeID", "DropOffDateTimeID", "PULocationID", "DOLocationID", "RateCodeID",
    "PaymentTypeID", "PassengerCount", "TripDistance", "FareAmount", "TipAmount", "TotalAmount",
]


def _joined(trips: DataFrame, star: Star) -> DataFrame:
    df = with_dropoff(with_pickup(trips, star), star)
    return with_time(with_rate(with_payment(df, star), star), star)


def _first_joined(star: Star, n: int | None) -> DataFrame:
    """All good trips with their dimensions, or the first ``n`` where a caller wants a preview.

    A limit comes before the joins: each dimension key is unique, so joining first would
    give the same rows after joining the whole fact.
    """
    trips = star.good()
    return _joined(trips if n is None else trips.orderBy(*STABLE_ORDER).limit(n), star)


def _fields(names: list[str]) -> list[Column]:
    return [col(name).alias(name) for name in names]


def _buckets() -> list[Column]:
    return [
        buckets.distance_category(col("TripDistance")).alias("distance_category"),
        buckets.fare_category(col("FareAmount")).alias("fare_category"),
    ]


def _derived() -> list[Column]:
    return [
        m.duration().alias("trip_duration_minutes"),
        buckets.tip_percentage(col("TipAmount"), col("FareAmount")).alias("tip_percentage"),
    ]


def trips_wide(star: Star) -> DataFrame:
    """The main dataset: the whole fact row, all dimensions, all derived columns."""
    month = col("trip_month")
    return with_day_of_week(_joined(star.good(), star)).select(
        *_fields(FACT),
        *_fields(
            ["pickup_zone", "pickup_borough", "pickup_service_zone",
             "dropoff_zone", "dropoff_borough", "dropoff_service_zone"]
        ),
        *_fields(KINDS),
        *_fields(["trip_date", "trip_year", "trip_month", "trip_day", "trip_hour"]),
        "day_of_week",
        "day_name",
        labels.month_name(month).alias("month_name"),
        labels.quarter(month).alias("quarter"),
        "is_weekend",
        *_buckets(),
        buckets.tip_category(col("TipAmount")).alias("tip_category"),
        *_derived(),
    )


def with_true_minutes(wide: DataFrame) -> DataFrame:
    """Add the real duration next to the published one."""
    return wide.withColumn("trip_true_minutes", m.true_duration())


def trips_wide_min(star: Star) -> DataFrame:
    """The dataset the charts are defined on."""
    return _joined(star.good(), star).select(
        *_fields(CORE), "pickup_borough", "dropoff_borough", *KINDS, *HOURS, *_buckets()
    )


def trips_wide_short(star: Star) -> DataFrame:
    """Three-letter names and the coarse tip buckets."""
    month = col("trip_month")
    return with_day_of_week(_joined(star.good(), star), short=True).select(
        *_fields(CORE),
        *_fields(PLACES + ["pickup_service_zone", "dropoff_service_zone"]),
        *KINDS,
        *HOURS,
        "trip_day",
        "day_of_week",
        "day_name",
        labels.month_name(month, short=True).alias("month_name"),
        labels.quarter(month).alias("quarter"),
        "is_weekend",
        *_buckets(),
        buckets.tip_category_coarse(col("TipAmount")).alias("tip_category"),
        *_derived(),
    )


def trips_wide_dates(star: Star, n: int | None = None) -> DataFrame:
    return with_day_of_week(_first_joined(star, n)).select(
        *_fields(CORE), *PLACES, *KINDS, *HOURS, *_buckets(),
        "day_of_week", "day_name", *_derived(),
    )


def trips_wide_buckets(star: Star, n: int | None = None) -> DataFrame:
    return _first_joined(star, n).select(*_fields(CORE), *PLACES, *KINDS, *HOURS, *_buckets())


def trips_wide_plain(star: Star, n: int | None = None) -> DataFrame:
    return _first_joined(star, n).select(*_fields(CORE), *PLACES, *KINDS, *HOURS)


def trips_star(star: Star) -> DataFrame:
    """Every fact column and the plain dimension attributes."""
    return _joined(star.good(), star).select(
        *[f.name for f in FACT_TRIP.fields], *PLACES, *KINDS, *HOURS, "trip_day"
    )
