"""Gold queries over the star: indicators, trends, rankings, shares and reports.

Each function takes a ``Star`` and joins only the dimensions its result shows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import buckets, labels
from tripspark.functions import timekeys as tk
from tripspark.functions.quality import CORRUPTED, GOOD
from tripspark.operators import shares
from tripspark.operators.exact import (
    STEPS,
    added_parts,
    aggregate,
    avg_of_parts,
    count_rows,
    percent_steps,
    range_key,
    sum_of_parts,
    sum_parts,
    whole_avg,
    with_digits,
)
from tripspark.operators.star import (
    Star,
    group_by_date,
    with_day_of_week,
    with_payment,
    with_pickup,
    with_rate,
    with_time,
    with_time_joined,
    with_trip_key,
)
from tripspark.plans import measures as m
from tripspark.plans.silver import MINUTE_KEYS
from tripspark.sinks import tables as sink

# --- key indicators -------------------------------------------------------------------


def kpi_summary(star: Star) -> DataFrame:
    """All indicators in one pass."""
    return aggregate(
        star.good(),
        [],
        count_rows("total_trips"),
        m.revenue(),
        m.avg_fare(),
        m.avg_tip_percentage(),
        m.avg_distance(),
        m.avg_true_duration(),
    )


def kpi_total_trips(star: Star) -> DataFrame:
    return aggregate(star.good(), [], count_rows("total_trips"))


def kpi_total_revenue(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.revenue())


def kpi_avg_fare(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.avg_fare())


def kpi_avg_tip_pct(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.avg_tip_percentage())


def kpi_avg_distance(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.avg_distance())


def kpi_avg_duration(star: Star) -> DataFrame:
    return aggregate(star.good(), [], m.avg_true_duration())


# --- trends over time -----------------------------------------------------------------


def _timed(star: Star) -> DataFrame:
    return with_time(star.good(), star)


def daily_trends(star: Star) -> DataFrame:
    daily = group_by_date(
        star.good(), star, m.trip_count(), m.avg_fare(), m.revenue("daily_revenue")
    )
    return daily.orderBy("trip_date")


def daily_trends_joined(star: Star) -> DataFrame:
    """Daily trends through the join with the minute dimension itself.

    Trips are added up per minute first, so the join moves a few rows per minute at most,
    however many trips a busy minute has.
    """
    split = with_digits(star.good(), {"fare": "FareAmount", "revenue": "TotalAmount"})
    per_minute = split.groupBy(
        "PickupDateTimeID", range_key("fare"), range_key("revenue")
    ).agg(F.count(lit(1)).alias("n"), *sum_parts("fare"), *sum_parts("revenue"))
    return (
        with_time_joined(per_minute, star.dimtime)
        .groupBy("trip_date", "fare_range", "revenue_range")
        .agg(F.sum("n").alias("n"), *added_parts("fare"), *added_parts("revenue"))
        .groupBy("trip_date")
        .agg(
            F.sum("n").alias("trip_count"),
            avg_of_parts("fare").alias("avg_fare"),
            sum_of_parts("revenue").alias("daily_revenue"),
        )
        .orderBy("trip_date")
    )


def daily_trends_bucketed(spark: SparkSession, fact_table: str, minute_table: str) -> DataFrame:
    """Daily trends through the join of the tables of ``silver.write_by_minute``.

    Both are bucketed by the join's keys, so trips are neither moved nor sorted for it.
    """
    trips = with_digits(
        spark.table(fact_table).join(spark.table(minute_table), MINUTE_KEYS, "left"),
        {"fare": "FareAmount", "revenue": "TotalAmount"},
    )
    return (
        trips.groupBy("trip_date", range_key("fare"), range_key("revenue"))
        .agg(F.count(lit(1)).alias("n"), *sum_parts("fare"), *sum_parts("revenue"))
        .groupBy("trip_date")
        .agg(
            F.sum("n").alias("trip_count"),
            avg_of_parts("fare").alias("avg_fare"),
            sum_of_parts("revenue").alias("daily_revenue"),
        )
        .orderBy("trip_date")
    )


def hourly_distribution(star: Star) -> DataFrame:
    hourly = aggregate(_timed(star), ["trip_hour"], m.trip_count(), m.avg_fare())
    return hourly.orderBy("trip_hour")


def monthly_trends(star: Star) -> DataFrame:
    return (
        _timed(star)
        .transform(
            aggregate,
            ["trip_year", "trip_month"],
            m.trip_count(), m.revenue("monthly_revenue"), m.avg_fare(),
        )
        .orderBy("trip_year", "trip_month")
    )


def weekly_trends(star: Star) -> DataFrame:
    return (
        _timed(star)
        .withColumn("trip_week", tk.week_of_year(col("trip_date")))
        .transform(
            aggregate,
            ["trip_year", "trip_week"],
            m.trip_count(), m.revenue("weekly_revenue"), m.avg_fare(),
        )
        .orderBy("trip_year", "trip_week")
    )


def year_over_year(star: Star) -> DataFrame:
    return (
        _timed(star)
        .transform(aggregate, ["trip_month", "trip_year"], m.trip_count(), m.revenue("revenue"))
        .orderBy("trip_month", "trip_year")
    )


def revenue_trends(star: Star) -> DataFrame:
    return (
        _timed(star)
        .transform(
            aggregate,
            [col("trip_year").alias("year"), col("trip_month").alias("month")],
            m.trip_count(), m.revenue("revenue"), m.avg_fare(), m.avg_distance(),
        )
        .orderBy("year", "month")
    )


def data_overview(star: Star) -> DataFrame:
    return (
        _timed(star)
        .transform(
            aggregate,
            [col("trip_year").alias("year"), col("trip_month").alias("month")],
            m.trip_count(), m.avg_fare(),
        )
        .orderBy("year", "month")
    )


def year_distribution(star: Star) -> DataFrame:
    by_year = _timed(star).groupBy(col("trip_year").alias("year")).agg(m.trips())
    return shares.with_share(by_year, "trip_count", "percentage").orderBy("year")


def seasonal_analysis(star: Star) -> DataFrame:
    return (
        _timed(star)
        .transform(
            aggregate,
            [labels.season(col("trip_month")).alias("season")],
            m.trip_count(), m.avg_fare(), m.revenue(),
        )
        .orderBy(buckets.rank_of("season", labels.SEASON_ORDER))
    )


def hour_day_heatmap(star: Star) -> DataFrame:
    return (
        with_day_of_week(_timed(star))
        .groupBy("trip_hour", "day_name")
        .agg(m.trips())
        .orderBy(buckets.rank_of("day_name", labels.WEEK_ORDER), "trip_hour")
    )


def peak_hours(star: Star) -> DataFrame:
    return (
        with_day_of_week(_timed(star))
        .transform(aggregate, ["day_name", "trip_hour"], m.trip_count(), m.avg_fare())
        .orderBy(buckets.rank_of("day_name", labels.WEEK_ORDER), "trip_hour")
    )


# --- places ---------------------------------------------------------------------------


def _by_borough(star: Star) -> DataFrame:
    return with_pickup(star.good(), star).filter(col("pickup_borough").isNotNull())


def trips_by_borough(star: Star) -> DataFrame:
    return gold_borough(star).orderBy(col("trip_count").desc(), "pickup_borough")


def pickup_vs_dropoff(star: Star) -> DataFrame:
    """Trips per borough at either end, from one scan.

    Pairs of places are counted first; only those few rows are turned into two ends.
    """
    pairs = star.good().groupBy("PULocationID", "DOLocationID").agg(F.count(lit(1)).alias("n"))
    ends = pairs.select(
        F.stack(
            lit(2), lit("Pickup"), col("PULocationID"), lit("Dropoff"), col("DOLocationID")
        ).alias("trip_type", "place"),
        "n",
    )
    boroughs = star.dimlocation.select("LocationID", col("Borough").alias("borough"))
    return (
        ends.join(boroughs, col("place") == col("LocationID"), "left")
        .filter(col("borough").isNotNull())
        .groupBy("trip_type", "borough")
        .agg(F.sum("n").alias("trip_count"))
    )


def top_zones(star: Star, n: int = 20) -> DataFrame:
    """Busiest pickup zones; equal counts are ordered by name."""
    return (
        with_pickup(star.good(), star)
        .filter(col("pickup_zone").isNotNull())
        .transform(aggregate, ["pickup_zone"], m.trip_count(), m.avg_fare())
        .orderBy(col("trip_count").desc(), "pickup_zone")
        .limit(n)
    )


def borough_zones(star: Star, borough: str) -> DataFrame:
    """Drill-down from a borough to its zones."""
    return (
        with_pickup(star.good(), star)
        .filter(col("pickup_borough") == borough)
        .transform(aggregate, ["pickup_zone"], m.trip_count(), m.revenue(), m.avg_fare())
        .orderBy(col("trip_count").desc(), "pickup_zone")
    )


def dropoff_density(star: Star) -> DataFrame:
    """Trips per drop-off zone, counted by place before the names are joined."""
    places = star.good().groupBy("DOLocationID").agg(m.trips())
    zones = star.dimlocation.select(
        "LocationID", col("Zone").alias("dropoff_zone"), col("Borough").alias("dropoff_borough")
    )
    return (
        places.join(zones, col("DOLocationID") == col("LocationID"))
        .select("dropoff_zone", "dropoff_borough", "trip_count")
        .orderBy(col("trip_count").desc(), "dropoff_zone")
    )


def revenue_hour_borough(star: Star) -> DataFrame:
    return (
        with_time(_by_borough(star), star)
        .transform(
            aggregate,
            ["pickup_borough", "trip_hour"],
            m.trip_count(), m.revenue(), m.avg_revenue(),
        )
        .orderBy("pickup_borough", "trip_hour")
    )


def top_boroughs(star: Star) -> DataFrame:
    grouped = (
        _by_borough(star)
        .transform(
            aggregate,
            [col("pickup_borough").alias("borough")],
            m.trip_count(), m.revenue(), m.avg_revenue(),
        )
    )
    return shares.with_share(grouped, "total_revenue", "revenue_percentage").orderBy(
        col("total_revenue").desc()
    )


def airport_trips(star: Star) -> DataFrame:
    """Trips from an airport zone or at an airport rate: fares, distances, passengers."""
    joined = with_rate(with_pickup(star.good(), star), star)
    return (
        joined.filter(
            (col("pickup_service_zone") == "Airports")
            | col("rate_description").isin("JFK", "Newark")
        )
        .transform(
            aggregate,
            ["pickup_zone", "rate_description"],
            m.trip_count(), m.avg_fare(), m.avg_distance(),
            whole_avg("PassengerCount", "avg_passengers"),
        )
        .orderBy("pickup_zone", "rate_description")
    )


# --- money ----------------------------------------------------------------------------


def revenue_by_payment(star: Star) -> DataFrame:
    return (
        with_payment(star.good(), star)
        .filter(col("payment_type").isNotNull())
        .transform(aggregate, ["payment_type"], m.trip_count(), m.revenue(), m.avg_fare())
        .orderBy(col("total_revenue").desc())
    )


def payment_analysis(star: Star) -> DataFrame:
    return (
        with_payment(star.good(), star)
        .filter(col("payment_type").isNotNull())
        .transform(
            aggregate,
            [col("payment_type").alias("paymenttype")],
            m.trip_count(), m.revenue(), m.avg_revenue(), m.avg_tip_percentage(),
        )
        .orderBy(col("total_revenue").desc())
    )


def fare_distribution(star: Star) -> DataFrame:
    return (
        star.good()
        .groupBy(buckets.fare_category(col("FareAmount")).alias("fare_category"))
        .agg(m.trips())
        .orderBy(buckets.rank_of("fare_category", buckets.FARE_ORDER))
    )


def tip_analysis(star: Star) -> DataFrame:
    return (
        star.good()
        .filter(col("TipAmount") > 0)
        .transform(
            aggregate,
            [buckets.tip_category(col("TipAmount")).alias("tip_category")],
            m.trip_count(), m.avg_tip_percentage(),
        )
        .orderBy(buckets.rank_of("tip_category", buckets.TIP_ORDER))
    )


# --- operations -----------------------------------------------------------------------


def distance_analysis(star: Star) -> DataFrame:
    """``avg_duration_minutes`` is the published duration, ``avg_true_minutes`` the real one."""
    return (
        star.good()
        .transform(
            aggregate,
            [buckets.distance_category(col("TripDistance")).alias("distance_category")],
            m.trip_count(), m.avg_fare(), m.avg_duration(), m.avg_true_duration("avg_true_minutes"),
        )
        .orderBy(buckets.rank_of("distance_category", buckets.DISTANCE_ORDER))
    )


def passenger_distribution(star: Star) -> DataFrame:
    return (
        star.good()
        .transform(
            aggregate,
            [col("PassengerCount").alias("passengercount")],
            m.trip_count(), m.avg_fare(),
        )
        .orderBy("passengercount")
    )


def rate_code_analysis(star: Star) -> DataFrame:
    return (
        with_rate(star.good(), star)
        .filter(col("rate_description").isNotNull())
        .transform(aggregate, ["rate_description"], m.trip_count(), m.revenue(), m.avg_fare())
        .orderBy(col("total_revenue").desc())
    )


def duration_vs_fare(star: Star) -> DataFrame:
    """One row per trip with plausible duration and fare."""
    trips = star.good().filter(
        (m.duration() > 0) & (m.duration() < 120)
        & (col("FareAmount") > 0) & (col("FareAmount") < 100)
    )
    return with_pickup(trips, star).select(
        m.duration().alias("trip_duration_minutes"),
        m.true_duration().alias("trip_true_minutes"),
        col("FareAmount").alias("fareamount"),
        "pickup_borough",
        buckets.distance_category(col("TripDistance")).alias("distance_category"),
        col("TripDistance").alias("tripdistance"),
    )


# --- gold tables ----------------------------------------------------------------------


def gold_daily(star: Star) -> DataFrame:
    return group_by_date(
        star.good(), star,
        m.trip_count(), m.revenue("daily_revenue"), m.avg_fare(), m.avg_tip_percentage(),
    )


def gold_borough(star: Star) -> DataFrame:
    return aggregate(
        _by_borough(star), ["pickup_borough"], m.trip_count(), m.revenue(), m.avg_fare()
    )


# The values that are added up exactly in ``trip_parts``.
PART_VALUES = ("fare", "revenue", "percent")


def gold_parts(star: Star) -> DataFrame:
    """What each load day adds to the aggregate tables, per pickup date and borough.

    A day without any good trip still has rows, so that a reload replaces what it had before.
    """
    good = col("quality_issue") == GOOD
    percent = buckets.tip_percentage(col("TipAmount"), col("FareAmount"))
    values = dict(
        zip(
            PART_VALUES,
            [
                F.when(good, v)
                for v in (col("FareAmount"), col("TotalAmount"), percent_steps(percent))
            ],
            strict=True,
        )
    )
    trips = with_pickup(with_trip_key(with_digits(star.fact, values), star), star)
    day = tk.int_div(col("trip_key"), 10_000)
    ranges = [range_key(name) for name in PART_VALUES]
    return (
        trips.groupBy("source_date", day.alias("day_number"), "pickup_borough", *ranges)
        .agg(
            F.count_if(good).alias("trip_count"),
            *[part for name in PART_VALUES for part in sum_parts(name)],
        )
        .withColumn("trip_date", tk.key_date(col("day_number") * 10_000))
        .drop("day_number")
    )


def _from_parts(parts: DataFrame, key: str, revenue: str, *more: Column) -> DataFrame:
    return (
        parts.groupBy(key, *[f"{name}_range" for name in PART_VALUES])
        .agg(
            F.sum("trip_count").alias("trip_count"),
            *[part for name in PART_VALUES for part in added_parts(name)],
        )
        .groupBy(key)
        .agg(
            F.sum("trip_count").alias("trip_count"),
            sum_of_parts("revenue").alias(revenue),
            avg_of_parts("fare").alias("avg_fare"),
            *more,
        )
        .filter("trip_count > 0")
    )


def refresh_gold(
    star: Star,
    namespace: str,
    provider: str = "parquet",
    first: date | None = None,
    last: date | None = None,
) -> None:
    """Bring the two aggregate tables the dashboards read up to date.

    With bounds only the trips loaded from the bronze days ``first`` to ``last`` are read. Their
    parts replace those days in ``trip_parts``, a few rows per day, from which both tables are made.
    """
    sink.create_namespace(star.spark, namespace)
    fact = star.fact
    if first is not None:
        fact = fact.filter(col("source_date") >= lit(first))
    if last is not None:
        fact = fact.filter(col("source_date") <= lit(last))
    parts = f"{namespace}.trip_parts"
    sink.overwrite_partitions(gold_parts(star.with_fact(fact)), parts, "source_date", provider)
    _from_trip_parts(star, namespace, provider)


def _from_trip_parts(star: Star, namespace: str, provider: str) -> None:
    """Make both aggregate tables of ``trip_parts``."""
    parts = star.spark.table(f"{namespace}.trip_parts")
    tip = F.try_divide(sum_of_parts("percent") / STEPS, F.sum("percent_n"))
    daily = _from_parts(parts, "trip_date", "daily_revenue", tip.alias("avg_tip_percentage"))
    boroughs = parts.filter("pickup_borough IS NOT NULL")
    sink.refresh_table(daily, f"{namespace}.daily_aggregations", provider)
    sink.refresh_table(
        _from_parts(boroughs, "pickup_borough", "total_revenue"),
        f"{namespace}.borough_aggregations",
        provider,
    )


def changed_days(ledger: DataFrame, built: DataFrame) -> DataFrame:
    """(source_date, gone, rows, digest): the days whose ledger entry is not the one they were
    built from.

    A day that is being written has no digest and always counts as changed.
    """
    now = ledger.select("source_date", "rows", "digest")
    then = built.select(
        "source_date", col("rows").alias("built_rows"), col("digest").alias("built_digest")
    )
    same = col("rows").eqNullSafe(col("built_rows")) & col("digest").eqNullSafe(
        col("built_digest")
    )
    there = F.coalesce(col("rows"), lit(1)) > 0
    days = now.withColumn("listed", lit(True)).join(then, "source_date", "full_outer")
    gone = col("listed").isNull() | ~there
    known = gone & col("built_rows").isNull()  # it was never built
    return days.filter(~known & (col("listed").isNull() | col("digest").isNull() | ~same)).select(
        "source_date", gone.alias("gone"), "rows", "digest"
    )


def refresh_changed(
    star: Star, ledger: str, namespace: str, provider: str = "parquet"
) -> dict[date, bool]:
    """Bring the aggregate tables up to date with the days that changed, by their ledger.

    Only trips of those days are read; the parts of days that are gone are removed. Returns the
    days, true for those that are gone. What was built is noted in ``parts_ledger`` at the end, so
    that a refresh which dies half way is done again.
    """
    spark = star.spark
    sink.create_namespace(spark, namespace)
    parts, built = f"{namespace}.trip_parts", f"{namespace}.parts_ledger"
    now = spark.table(ledger)
    sink.create_table(spark, built, now.schema, partition_by=["source_date"], provider=provider)
    # One row per changed day.
    changed = changed_days(now, spark.table(built)).collect()
    if not changed:
        return {}
    present = [r.source_date for r in changed if not r.gone]
    removed = [r.source_date for r in changed if r.gone]
    # What is noted is what the ledger said before the trips were read.
    entries = [
        (r.source_date, r.rows, r.digest)
        for r in changed
        if not r.gone and r.digest is not None
    ]
    trips = star.fact.filter(col("source_date").isin(present))
    sink.overwrite_partitions(gold_parts(star.with_fact(trips)), parts, "source_date", provider)
    sink.drop_days(spark, parts, "source_date", removed)
    _from_trip_parts(star, namespace, provider)
    sink.drop_days(spark, built, "source_date", removed)
    if entries:
        noted = spark.createDataFrame(entries, "source_date date, rows long, digest long")
        sink.overwrite_partitions(
            noted.coalesce(1), built, "source_date", provider, rebalance=False
        )
    return {r.source_date: r.gone for r in changed}


# --- reports --------------------------------------------------------------------------


def quality_report(star: Star) -> DataFrame:
    """Four metric rows from one aggregate."""
    flag = col("quality_issue")
    counts = star.fact.agg(
        F.count(lit(1)).alias("total"),
        F.count_if(flag == GOOD).alias("good"),
        F.count_if(flag == CORRUPTED).alias("bad"),
    )
    return counts.select(
        F.stack(
            lit(4),
            lit("Total Records"), col("total").cast("double"),
            lit("Good Quality Records"), col("good").cast("double"),
            lit("Corrupted Records"), col("bad").cast("double"),
            lit("Data Completeness %"), shares.percentage(col("good"), col("total")),
        ).alias("metric", "value")
    )


def _table_row(name: str, df: DataFrame, year: str | None = None) -> DataFrame:
    no_year = lit(None).cast("int")
    return df.agg(
        F.count(lit(1)).alias("row_count"),
        (F.min(year).cast("int") if year else no_year).alias("min_year"),
        (F.max(year).cast("int") if year else no_year).alias("max_year"),
    ).withColumn("table_name", lit(name))


def table_inventory(star: Star) -> DataFrame:
    """Row counts of the five tables, with the range of years where there is one."""
    rows = (
        _table_row("fact_trip", star.good(), "year")
        .unionByName(_table_row("dimlocation", star.dimlocation))
        .unionByName(_table_row("dimpayment", star.dimpayment))
        .unionByName(_table_row("dimratecode", star.dimratecode))
        .unionByName(_table_row("dimtime", star.dimtime, "year"))
    )
    return rows.select("table_name", "row_count", "min_year", "max_year").orderBy("table_name")


def table_counts(star: Star) -> DataFrame:
    """Row counts of the fact and the zones."""
    rows = _table_row("fact_trip", star.good()).unionByName(
        _table_row("dimlocation", star.dimlocation)
    )
    return rows.select("table_name", "row_count").orderBy("table_name")
