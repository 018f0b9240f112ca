"""Every named query as a callable of (session, folder with the order tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import timekeys as tk
from tripspark.operators import files
from tripspark.operators.filters import (
    DashboardFilters,
    apply_filters,
    keyed_sample,
    last_30_days,
)
from tripspark.operators.star import Calendar, Star, bronze_zone_join
from tripspark.plans import charts, gold, rollup, samples, silver, wide
from tripspark.session import shared_dir
from tripspark.sources import dimensions, order_lines, tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SPLIT_YEAR = 1998
TEAM = 1001
FILTERS = DashboardFilters(
    years=[1997, 1998, 1999],
    months=[1, 2, 3, 7, 8],
    boroughs=["ASIA", "EUROPE"],
    payment_types=["Cash", "Dispute", "Unknown"],
    distance_categories=["1-3 miles", "3-5 miles", "10+ miles"],
)
RECENT = last_30_days(date(2001, 6, 30))
BOROUGH = "ASIA"


def star_of(spark: SparkSession, sf_dir: str, years_cut: int = 0) -> Star:
    """The star over trips derived from the order tables; nothing is written.

    The calendar runs from the first order day to the midnight after the last one, less
    ``years_cut`` years at either end; trips outside it have no time attributes.
    """
    orders = order_lines.read(spark, sf_dir, "orders")
    bounds = order_lines.day_span(orders, "o_orderdate", years_cut)
    return Star(
        spark=spark,
        fact=silver.transform_trips(order_lines.bronze_trips(spark, sf_dir)),
        locations=lambda: order_lines.locations(spark, sf_dir),
        payments=lambda: dimensions.dimpayment(spark),
        rates=lambda: dimensions.dimratecode(spark),
        times=lambda: dimensions.dimtime_between(bounds),
        calendar=Calendar.of_days(bounds),
    )


def partial(plan: Callable[[Star], DataFrame]) -> Query:
    """The same query where the calendar lacks the first and the last year of the trips."""
    return lambda spark, sf_dir: plan(star_of(spark, sf_dir, years_cut=1))


def rows(plan: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(star_of(spark, sf_dir))


def without_id(plan: Callable[[Star], DataFrame]) -> Query:
    """Row-level data without the hashed id, which no other engine reproduces."""
    return lambda spark, sf_dir: plan(star_of(spark, sf_dir)).drop("TripID")


# --- silver tables --------------------------------------------------------------------


def fact_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_of(spark, sf_dir).fact.drop("TripID")


def fact_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.plain_projection(order_lines.bronze_trips(spark, sf_dir)).drop("TripID")


def dimtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute calendar from the first event's day to the day after the last event."""
    events = order_lines.read(spark, sf_dir, "events")
    return dimensions.dimtime_between(order_lines.day_span(events, "ts"))


def dimtime_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of the minute calendar, the same on every run."""
    return keyed_sample(dimtime(spark, sf_dir), "timeid", 100, seed=7, fraction=0.25)


def dimlocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines.locations(spark, sf_dir)


def dimpayment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment types with the number of raw trips of each."""
    counts = samples.count_by(order_lines.bronze_trips(spark, sf_dir), "payment_type")
    return _with_counts(dimensions.dimpayment(spark), counts, "paymenttypeid", "payment_type")


def dimratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate codes with the number of raw trips of each."""
    counts = samples.count_by(order_lines.bronze_trips(spark, sf_dir), "RatecodeID").select(
        col("RatecodeID").try_cast("int").alias("code"), "count"
    )
    return _with_counts(dimensions.dimratecode(spark), counts, "ratecodeid", "code")


def _with_counts(dim: DataFrame, counts: DataFrame, key: str, code: str) -> DataFrame:
    return dim.join(counts, col(key) == col(code), "left").select(
        *dim.columns, F.coalesce(col("count"), lit(0)).alias("trip_count")
    )


def load_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of loading every order day and the week after, which has no trips."""
    orders = order_lines.read(spark, sf_dir, "orders")
    counts = silver.rows_per_day(order_lines.bronze_trips(spark, sf_dir))
    bounds = order_lines.day_span(orders, "o_orderdate", days_after=7)
    return silver.load_outcome(counts, bounds)


# --- raw data -------------------------------------------------------------------------


def zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_zone_join(
        order_lines.bronze_trips(spark, sf_dir), order_lines.locations(spark, sf_dir)
    )


def count_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.count_by(order_lines.bronze_trips(spark, sf_dir), "payment_type")


def count_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.count_by(order_lines.bronze_trips(spark, sf_dir), "RatecodeID")


def union_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days before and from a given year, appended and counted: the whole table."""
    trips = order_lines.bronze_trips(spark, sf_dir)
    return samples.union_count(*samples.split_by(trips, col("year") < SPLIT_YEAR))


# --- events, chats, orders ------------------------------------------------------------


def event_minute_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines.read(spark, sf_dir, "events").select(
        "event_id",
        tk.minute_key("ts").alias("minute_key"),
        tk.unix_minute_key("ts").alias("unix_minute_key"),
    )


def events_per(grain: str) -> Query:
    return lambda spark, sf_dir: charts.per_time_grain(
        order_lines.read(spark, sf_dir, "events"), "ts", grain
    )


def range_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The +10 and +20 columns over the range of event ids."""
    return samples.plus_columns(order_lines.read(spark, sf_dir, "events"), "event_id")


def conversation_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.conversation_chats(*order_lines.conversation_tables(spark, sf_dir), TEAM)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/tripspark/{name}-{uuid.uuid4().hex}"


def conversation_chats_federated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of the given table with chats that a second source holds as ORC."""
    conversations, chats = order_lines.conversation_tables(spark, sf_dir)
    other = _folder(spark, "chats")
    chats.write.orc(other)
    return samples.federated_chats(conversations, spark.read.schema(chats.schema).orc(other))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through CSV text and a table, cast back to their types."""
    documents = order_lines.read(spark, sf_dir, "documents")
    texts = samples.csv_roundtrip(documents, _folder(spark, "csv"))
    return texts.select(
        *[col(f.name).cast(f.dataType).alias(f.name) for f in documents.schema.fields]
    )


def daily_trends_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily trends through bucketed copies of the trips and the minutes."""
    folder, tag = _folder(spark, "by-minute"), uuid.uuid4().hex
    names = f"trips_by_minute_{tag}", f"minutes_{tag}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    silver.write_by_minute(star_of(spark, sf_dir), *names, buckets, folder=folder)
    return gold.daily_trends_bucketed(spark, *names)


# Tables with a key of whole numbers, for the inventory.
KEYS = {
    "customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "part": "p_partkey",
    "supplier": "s_suppkey", "events": "event_id", "documents": "doc_id", "pages": "page_id",
    "conversations": "conv_id", "labels": "doc_id", "nation": "n_nationkey",
}


def table_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and range of the key of the given tables, from their footers."""
    root = sf_dir.rstrip("/")
    return tables.inventory(
        spark, {name: (f"{root}/{name}.parquet", key) for name, key in KEYS.items()}
    )


# --- reconciliation -------------------------------------------------------------------


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the objects of a source: name, length in bytes and content."""
    return order_lines.read(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", col("doc_id").cast("string")).alias("rel_path"),
        F.octet_length("text").cast("long").alias("length"),
        "doc_id",
        "text",
        "n_chars",
    )


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents, and those that have a label, with their number of characters as length:
    it differs from the bytes where a text is not ASCII."""
    objects = _objects(spark, sf_dir)
    there = order_lines.read(spark, sf_dir, "labels").select("doc_id").distinct()
    target = objects.join(there, "doc_id", "left_semi")
    return (
        objects.select("rel_path", "length"),
        target.select("rel_path", col("n_chars").alias("length")),
    )


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.target_keys(_listings(spark, sf_dir)[0], "bronze")


def file_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.new_files(*_listings(spark, sf_dir))


def file_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.validate(*_listings(spark, sf_dir))


def file_new_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.new_files_by_ranges(*_listings(spark, sf_dir))


def file_validation_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.validate_by_ranges(*_listings(spark, sf_dir))


def file_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.verdict(file_validation(spark, sf_dir))


def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_stats(*_listings(spark, sf_dir))


def file_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.hashes(_objects(spark, sf_dir), "text")


# --- filtered dashboards --------------------------------------------------------------


def filtered(plan: Callable[[Star], DataFrame], selection: DashboardFilters) -> Query:
    return rows(lambda star: plan(apply_filters(star, selection)))


def from_rollup(chart: Callable[[rollup.Rollup], DataFrame], selection: DashboardFilters) -> Query:
    """A chart answered from the stored rollup of all trips."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, "rollup")
        rollup.write(star_of(spark, sf_dir), path)
        return chart(rollup.read(spark, path).filtered(selection))

    return query


QUERIES: dict[str, Query] = {
    # indicators
    "kpi_total_trips": rows(gold.kpi_total_trips),
    "kpi_total_revenue": rows(gold.kpi_total_revenue),
    "kpi_avg_fare": rows(gold.kpi_avg_fare),
    "kpi_avg_tip_pct": rows(gold.kpi_avg_tip_pct),
    "kpi_avg_distance": rows(gold.kpi_avg_distance),
    "kpi_avg_duration": rows(gold.kpi_avg_duration),
    "kpi_summary": rows(gold.kpi_summary),
    # time
    "daily_trends": rows(gold.daily_trends),
    "daily_trends_joined": rows(gold.daily_trends_joined),
    "daily_trends_bucketed": daily_trends_bucketed,
    "hourly_distribution": rows(gold.hourly_distribution),
    "monthly_trends": rows(gold.monthly_trends),
    "weekly_trends": rows(gold.weekly_trends),
    "year_over_year": rows(gold.year_over_year),
    "revenue_trends": rows(gold.revenue_trends),
    "data_overview": rows(gold.data_overview),
    "year_distribution": rows(gold.year_distribution),
    "seasonal_analysis": rows(gold.seasonal_analysis),
    "hour_day_heatmap": rows(gold.hour_day_heatmap),
    "peak_hours": rows(gold.peak_hours),
    # places
    "trips_by_borough": rows(gold.trips_by_borough),
    "pickup_vs_dropoff": rows(gold.pickup_vs_dropoff),
    "top_zones": rows(gold.top_zones),
    "dropoff_density": rows(gold.dropoff_density),
    "revenue_hour_borough": rows(gold.revenue_hour_borough),
    "top_boroughs": rows(gold.top_boroughs),
    "airport_trips": rows(gold.airport_trips),
    # money
    "revenue_by_payment": rows(gold.revenue_by_payment),
    "payment_analysis": rows(gold.payment_analysis),
    "fare_distribution": rows(gold.fare_distribution),
    "tip_analysis": rows(gold.tip_analysis),
    # operations
    "distance_analysis": rows(gold.distance_analysis),
    "passenger_distribution": rows(gold.passenger_distribution),
    "rate_code_analysis": rows(gold.rate_code_analysis),
    "duration_vs_fare": rows(gold.duration_vs_fare),
    # gold tables and reports
    "gold_daily": rows(gold.gold_daily),
    "gold_borough": rows(gold.gold_borough),
    "quality_report": rows(gold.quality_report),
    "table_inventory": rows(gold.table_inventory),
    "table_counts": rows(gold.table_counts),
    "table_footers": table_footers,
    # wide datasets
    "trips_wide": without_id(lambda star: wide.with_true_minutes(wide.trips_wide(star))),
    "trips_wide_min": without_id(wide.trips_wide_min),
    "trips_wide_short": without_id(wide.trips_wide_short),
    "trips_wide_dates": without_id(wide.trips_wide_dates),
    "trips_wide_buckets": without_id(wide.trips_wide_buckets),
    "trips_wide_plain": without_id(wide.trips_wide_plain),
    "trips_star": without_id(wide.trips_star),
    # charts
    "chart_total_trips": rows(charts.chart_total_trips),
    "chart_total_revenue": rows(charts.chart_total_revenue),
    "chart_daily": rows(charts.chart_daily),
    "chart_hourly": rows(charts.chart_hourly),
    "chart_hourly_true": rows(charts.chart_hourly_true),
    "chart_borough": rows(charts.chart_borough),
    "chart_payment_revenue": rows(charts.chart_payment_revenue),
    "hist_distance": rows(charts.hist_distance),
    "hist_fare": rows(charts.hist_fare),
    # filters
    "filtered_dashboard": filtered(gold.monthly_trends, FILTERS),
    "filtered_payments": filtered(gold.payment_analysis, FILTERS),
    "filtered_recent": filtered(gold.daily_trends, RECENT),
    "drilldown_zones": rows(lambda star: gold.borough_zones(star, BOROUGH)),
    "cross_filter_months": from_rollup(rollup.Rollup.monthly_trends, FILTERS),
    "cross_filter_payments": from_rollup(rollup.Rollup.payment_analysis, FILTERS),
    "cross_filter_distances": from_rollup(
        rollup.Rollup.distance_analysis, DashboardFilters(boroughs=[BOROUGH])
    ),
    "rollup_boroughs": from_rollup(rollup.Rollup.top_boroughs, DashboardFilters()),
    # trips outside the calendar
    "daily_trends_partial": partial(gold.daily_trends),
    "daily_trends_joined_partial": partial(gold.daily_trends_joined),
    "seasonal_analysis_partial": partial(gold.seasonal_analysis),
    "hour_day_heatmap_partial": partial(gold.hour_day_heatmap),
    "trips_wide_partial": partial(lambda star: wide.trips_wide(star).drop("tripid")),
    "filtered_partial": partial(
        lambda star: gold.monthly_trends(apply_filters(star, FILTERS))
    ),
    # silver
    "fact_trip": fact_trip,
    "fact_plain": fact_plain,
    "dimtime": dimtime,
    "dimtime_sample": dimtime_sample,
    "dimlocation": dimlocation,
    "dimpayment": dimpayment,
    "dimratecode": dimratecode,
    "load_outcome": load_outcome,
    # raw data
    "bronze_zone_join": zone_join,
    "bronze_count_by_payment": count_by_payment,
    "bronze_count_by_rate": count_by_rate,
    "bronze_union_days": union_days,
    # samples
    "event_minute_keys": event_minute_keys,
    "events_by_day": events_per("day"),
    "events_by_hour": events_per("hour"),
    "range_projection": range_projection,
    "conversation_chats": conversation_chats,
    "conversation_chats_federated": conversation_chats_federated,
    "tpch_wide": samples.order_star,
    "csv_roundtrip": csv_roundtrip,
    # files
    "file_manifest": file_manifest,
    "file_new": file_new,
    "file_validation": file_validation,
    "file_new_by_ranges": file_new_by_ranges,
    "file_validation_by_ranges": file_validation_by_ranges,
    "file_verdict": file_verdict,
    "file_stats": file_stats,
    "file_md5": file_md5,
}
