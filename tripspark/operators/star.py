"""The star schema and the joins from the fact to its dimensions.

No join carries a broadcast hint. The dimensions are small, so Spark's own size checks
(``autoBroadcastJoinThreshold``, and AQE on measured sizes) broadcast them; a dimension
that outgrows the threshold falls back to a shuffle join with AQE's skew handling.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.functions import labels
from tripspark.functions import timekeys as tk
from tripspark.functions.quality import GOOD
from tripspark.operators.exact import Measure, aggregate


@dataclass(frozen=True)
class Calendar:
    """First and last minute key of the minute dimension, as numbers or scalar subqueries."""

    first: int | Column
    last: int | Column

    @classmethod
    def between(cls, start: date, end: date) -> Calendar:
        """Midnight of ``start`` to midnight of ``end``, as ``dimensions.dimtime`` lists it."""
        return cls(tk.date_key(start), tk.date_key(end))

    @classmethod
    def of(cls, dimtime: DataFrame) -> Calendar:
        """The range a minute dimension holds, found when a query runs."""
        span = dimtime.agg(F.min("timeid").alias("first"), F.max("timeid").alias("last"))
        return cls(span.select("first").scalar(), span.select("last").scalar())

    @classmethod
    def of_days(cls, bounds: DataFrame) -> Calendar:
        """The range of one row (``first``, ``last``) of dates, both midnights included."""
        midnight = [
            bounds.select((tk.minute_key(name)).alias("key")).scalar() for name in ("first", "last")
        ]
        return cls(*midnight)

    def covers(self, key):
        return key.between(self.first, self.last)


Dimension = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Star:
    """A fact and its dimensions. A dimension may be a function that makes it, so that a
    query only builds the ones it joins."""

    spark: SparkSession
    fact: DataFrame
    locations: Dimension
    payments: Dimension
    rates: Dimension
    times: Dimension
    calendar: Calendar

    @property
    def dimlocation(self) -> DataFrame:
        return _made(self.locations)

    @property
    def dimpayment(self) -> DataFrame:
        return _made(self.payments)

    @property
    def dimratecode(self) -> DataFrame:
        return _made(self.rates)

    @property
    def dimtime(self) -> DataFrame:
        return _made(self.times)

    def good(self) -> DataFrame:
        return self.fact.filter(col("quality_issue") == GOOD)

    def with_fact(self, fact: DataFrame) -> Star:
        return replace(self, fact=fact)


def _made(dimension: Dimension) -> DataFrame:
    return dimension() if callable(dimension) else dimension


def _lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, **names: str) -> DataFrame:
    """Left join that adds dimension columns under new names."""
    side = dim.select(
        col(dim_key).alias("_dim_key"), *[col(src).alias(out) for out, src in names.items()]
    )
    return df.join(side, col(key) == col("_dim_key"), "left").drop("_dim_key")


def with_pickup(df: DataFrame, star: Star) -> DataFrame:
    return _lookup(
        df, star.dimlocation, "PULocationID", "LocationID",
        pickup_zone="Zone", pickup_borough="Borough", pickup_service_zone="service_zone",
    )


def with_dropoff(df: DataFrame, star: Star) -> DataFrame:
    return _lookup(
        df, star.dimlocation, "DOLocationID", "LocationID",
        dropoff_zone="Zone", dropoff_borough="Borough", dropoff_service_zone="service_zone",
    )


def with_payment(df: DataFrame, star: Star) -> DataFrame:
    return _lookup(
        df, star.dimpayment, "PaymentTypeID", "paymenttypeid", payment_type="paymenttype"
    )


def with_rate(df: DataFrame, star: Star) -> DataFrame:
    dim = star.dimratecode.withColumn("ratecodeid", col("ratecodeid").cast("int"))
    return _lookup(df, dim, "RateCodeID", "ratecodeid", rate_description="ratedescription")


def with_trip_key(df: DataFrame, star: Star) -> DataFrame:
    """The pickup minute key, NULL outside the calendar: the key a join would have found."""
    key = col("PickupDateTimeID")
    return df.withColumn("trip_key", F.when(star.calendar.covers(key), key))


def with_time(df: DataFrame, star: Star) -> DataFrame:
    """Time attributes of the pickup minute, NULL outside the calendar.

    Equal to a left join with the minute dimension, whose every column follows from
    its key. Deriving them saves joining the whole fact to millions of minutes.
    ``with_time_joined`` is the join itself, for calendars with columns of their own.
    """
    key = col("trip_key")
    return with_trip_key(df, star).withColumns(
        {
            "trip_date": tk.key_date(key),
            "trip_year": tk.key_year(key),
            "trip_month": tk.key_month(key),
            "trip_day": tk.key_day(key),
            "trip_hour": tk.key_hour(key),
        }
    )


def group_by_date(df: DataFrame, star: Star, *measures: Measure) -> DataFrame:
    """Aggregate per ``trip_date``. Rows are grouped on a number cut from the key; the
    date itself is only built for the few grouped rows."""
    day = tk.int_div(col("trip_key"), 10_000)
    grouped = aggregate(with_trip_key(df, star), [day.alias("trip_day_number")], *measures)
    date = tk.key_date(col("trip_day_number") * 10_000).alias("trip_date")
    return grouped.select(date, *[c for c in grouped.columns if c != "trip_day_number"])


def with_time_joined(df: DataFrame, dimtime: DataFrame) -> DataFrame:
    """The same attributes by a left join on the pickup minute key."""
    dim = dimtime.select(
        "timeid",
        col("Date").alias("trip_date"),
        col("year").cast("int").alias("trip_year"),
        col("month").cast("int").alias("trip_month"),
        col("dayofmonth").alias("trip_day"),
        col("hour").cast("int").alias("trip_hour"),
    )
    return df.join(dim, col("PickupDateTimeID") == col("timeid"), "left").drop("timeid")


def with_day_of_week(df: DataFrame, short: bool = False) -> DataFrame:
    """Number, name and weekend flag of the day in ``trip_date``."""
    dow = tk.day_of_week(col("trip_date"))
    return df.withColumns(
        {
            "day_of_week": dow,
            "day_name": labels.day_name(dow, short),
            "is_weekend": labels.is_weekend(dow),
        }
    )


def bronze_zone_join(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    """Raw trips with the zone row of their pickup place; trips without one drop out."""
    return bronze.join(zones, bronze["PULocationID"] == zones["LocationID"], "inner")
