"""One stored rollup from which the dashboard charts answer any cross-filter.

Trips are added up once per year, month, borough, payment type and distance class, a few thousand
rows whatever the number of trips; of these rows GROUPING SETS make the coarser levels. Sums
are kept as exact parts, so a chart gives the same digits as from the trips. A chart reads the
smallest level that has the columns it groups by and those that are filtered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import buckets, labels
from tripspark.operators import shares
from tripspark.operators.exact import (
    STEPS,
    added_parts,
    avg_of_parts,
    percent_steps,
    range_key,
    sum_of_parts,
    sum_parts,
    with_digits,
)
from tripspark.operators.filters import DashboardFilters
from tripspark.operators.star import Star, with_payment, with_pickup, with_time
from tripspark.plans import measures as m

DIMENSIONS = ["trip_year", "trip_month", "pickup_borough", "payment_type", "distance_category"]
LEVELS = [
    DIMENSIONS,
    ["trip_year", "trip_month"],
    ["trip_year", "trip_month", "pickup_borough"],
    ["trip_year", "trip_month", "payment_type"],
    ["trip_year", "trip_month", "distance_category"],
    [],
]
# Values that are added up exactly, and whole ones.
EXACT = ["fare", "revenue", "percent"]
WHOLE = ["trips", "minutes", "minutes_n", "true_minutes", "true_minutes_n"]


def _level(dimensions: list[str]) -> int:
    """The number of a level: a bit for every dimension that is summed over."""
    return int("".join("0" if d in dimensions else "1" for d in DIMENSIONS), 2)


def rollup(star: Star) -> DataFrame:
    """All levels: the dimensions (NULL where summed over), ``level`` and the parts."""
    percent = buckets.tip_percentage(col("TipAmount"), col("FareAmount"))
    values = {"fare": "FareAmount", "revenue": "TotalAmount", "percent": percent_steps(percent)}
    trips = with_payment(with_pickup(with_time(star.good(), star), star), star)
    category = buckets.distance_category(col("TripDistance")).alias("distance_category")
    ranges = [f"{name}_range" for name in EXACT]
    finest = (
        with_digits(trips, values)
        .groupBy(*DIMENSIONS[:-1], category, *[range_key(name) for name in EXACT])
        .agg(
            F.count(lit(1)).alias("trips"),
            F.sum(m.duration().cast("long")).alias("minutes"),
            F.count(m.duration()).alias("minutes_n"),
            F.sum(m.true_duration().cast("long")).alias("true_minutes"),
            F.count(m.true_duration()).alias("true_minutes_n"),
            *[part for name in EXACT for part in sum_parts(name)],
        )
    )
    keys = [*DIMENSIONS, *ranges]
    # The bits of the ranges, which every level keeps, are zero.
    number = F.shiftright(F.grouping_id(), len(ranges)).cast("int")
    return finest.groupingSets(
        [[col(c) for c in (*level, *ranges)] for level in LEVELS], *[col(c) for c in keys]
    ).agg(
        number.alias("level"),
        *[F.sum(c).alias(c) for c in WHOLE],
        *[part for name in EXACT for part in added_parts(name)],
    )


def write(star: Star, path: str) -> None:
    """Store the rollup, a folder per level."""
    levels = rollup(star).hint("rebalance", "level")
    levels.write.mode("overwrite").partitionBy("level").parquet(path)


def read(spark: SparkSession, path: str) -> Rollup:
    return Rollup(spark.read.parquet(path))


def _trip_count(name: str = "trip_count") -> Column:
    return F.coalesce(F.sum("trips"), lit(0)).alias(name)


def _revenue(name: str = "total_revenue") -> Column:
    return sum_of_parts("revenue").alias(name)


def _avg_fare() -> Column:
    return avg_of_parts("fare").alias("avg_fare")


def _avg_revenue() -> Column:
    return avg_of_parts("revenue").alias("avg_revenue_per_trip")


def _avg_tip() -> Column:
    steps = sum_of_parts("percent") / STEPS
    return F.try_divide(steps, F.sum("percent_n")).alias("avg_tip_percentage")


def _avg_whole(part: str, name: str) -> Column:
    return F.try_divide(F.sum(part), F.sum(f"{part}_n")).alias(name)


@dataclass(frozen=True)
class Rollup:
    """A stored rollup and a selection. Every chart is a query over a few rows, with the columns
    and order of the chart of the same name over trips."""

    rows: DataFrame
    selection: DashboardFilters = DashboardFilters()

    def filtered(self, selection: DashboardFilters) -> Rollup:
        if selection.first_date or selection.last_date:
            raise ValueError("the rollup has months, not days")
        return Rollup(self.rows, selection)

    def _chosen(self) -> dict[str, list]:
        f = self.selection
        chosen = [f.years, f.months, f.boroughs, f.payment_types, f.distance_categories]
        return {d: values for d, values in zip(DIMENSIONS, chosen, strict=True) if values}

    def level(self, shown: list[str]) -> list[str]:
        """The smallest level with the dimensions that are shown and those that are filtered."""
        needed = {*shown, *self._chosen()}
        return min((level for level in LEVELS if needed <= set(level)), key=len)

    def grouped(
        self, keys: list[str | Column], *measures: Column, of: list[str] | None = None
    ) -> DataFrame:
        """The measures, aggregates over parts, by keys made of the dimensions ``of``, by default
        the keys themselves."""
        at = self.rows.filter(col("level") == _level(self.level(keys if of is None else of)))
        for dimension, values in self._chosen().items():
            at = at.filter(col(dimension).isin(values))
        parts = at.groupBy(*keys, *[f"{name}_range" for name in EXACT]).agg(
            *[F.sum(c).alias(c) for c in WHOLE],
            *[part for name in EXACT for part in added_parts(name)],
        )
        return parts.groupBy(*parts.columns[: len(keys)]).agg(*measures)

    def kpis(self) -> DataFrame:
        return self.grouped(
            [], _trip_count("total_trips"), _revenue(), _avg_fare(), _avg_tip()
        )

    def monthly_trends(self) -> DataFrame:
        return self.grouped(
            ["trip_year", "trip_month"], _trip_count(), _revenue("monthly_revenue"), _avg_fare()
        ).orderBy("trip_year", "trip_month")

    def year_over_year(self) -> DataFrame:
        return self.grouped(
            ["trip_month", "trip_year"], _trip_count(), _revenue("revenue")
        ).orderBy("trip_month", "trip_year")

    def year_distribution(self) -> DataFrame:
        year = col("trip_year").alias("year")
        years = self.grouped([year], _trip_count(), of=["trip_year"])
        return shares.with_share(years, "trip_count", "percentage").orderBy("year")

    def seasonal_analysis(self) -> DataFrame:
        season = labels.season(col("trip_month")).alias("season")
        return self.grouped(
            [season], _trip_count(), _avg_fare(), _revenue(), of=["trip_month"]
        ).orderBy(buckets.rank_of("season", labels.SEASON_ORDER))

    def trips_by_borough(self) -> DataFrame:
        boroughs = self.grouped(["pickup_borough"], _trip_count(), _revenue(), _avg_fare())
        return boroughs.filter(col("pickup_borough").isNotNull()).orderBy(
            col("trip_count").desc(), "pickup_borough"
        )

    def top_boroughs(self) -> DataFrame:
        borough = col("pickup_borough").alias("borough")
        grouped = self.grouped(
            [borough], _trip_count(), _revenue(), _avg_revenue(), of=["pickup_borough"]
        ).filter(col("borough").isNotNull())
        return shares.with_share(grouped, "total_revenue", "revenue_percentage").orderBy(
            col("total_revenue").desc()
        )

    def payment_analysis(self) -> DataFrame:
        kind = col("payment_type").alias("paymenttype")
        return (
            self.grouped(
                [kind], _trip_count(), _revenue(), _avg_revenue(), _avg_tip(), of=["payment_type"]
            )
            .filter(col("paymenttype").isNotNull())
            .orderBy(col("total_revenue").desc())
        )

    def distance_analysis(self) -> DataFrame:
        return self.grouped(
            ["distance_category"],
            _trip_count(),
            _avg_fare(),
            _avg_whole("minutes", "avg_duration_minutes"),
            _avg_whole("true_minutes", "avg_true_minutes"),
        ).orderBy(buckets.rank_of("distance_category", buckets.DISTANCE_ORDER))
