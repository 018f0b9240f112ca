"""Dashboard filters, applied to the fact before a chart aggregates it."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import timekeys as tk
from tripspark.functions.buckets import distance_category
from tripspark.operators.clustering import runs
from tripspark.operators.star import Star


@dataclass(frozen=True)
class DashboardFilters:
    """Selected values; an empty selection lets everything pass."""

    years: list[int] = field(default_factory=list)
    months: list[int] = field(default_factory=list)
    boroughs: list[str] = field(default_factory=list)
    payment_types: list[str] = field(default_factory=list)
    distance_categories: list[str] = field(default_factory=list)
    first_date: date | None = None
    last_date: date | None = None


def last_30_days(as_of: date) -> DashboardFilters:
    return DashboardFilters(first_date=as_of - timedelta(days=30), last_date=as_of)


def _months_covered(f: DashboardFilters) -> list[tuple[int, int]]:
    """The selected years and months as ranges of the minute key, without gaps."""
    months = [y * 12 + m - 1 for y in f.years for m in f.months or range(1, 13)]

    def first(month: int) -> int:
        return tk.date_key(date(month // 12, month % 12 + 1, 1))

    return [(first(a), first(b + 1)) for a, b in runs(months)]


def _any_range(value: Column, ranges: list[tuple[int, int]]) -> Column:
    return reduce(or_, [(value >= a) & (value <= b) for a, b in ranges])


def apply_filters(star: Star, f: DashboardFilters, skip: bool = False) -> Star:
    """The same star with a smaller fact.

    Dates become a range of the minute key, which parquet statistics can skip on.
    Boroughs and payment types are semi joins with the matching dimension rows, so no
    dimension column is carried into charts that do not show it.

    With ``skip``, for facts that were written clustered, years, months and boroughs are also given
    to the scan as ranges of the key and of the place, so it passes over row groups by either. The
    places of the boroughs, a bounded part of a dimension, are looked up when this is called.
    """
    fact = star.fact
    key = col("PickupDateTimeID")
    if f.first_date is not None:
        fact = fact.filter(key >= tk.date_key(f.first_date))
    if f.last_date is not None:
        fact = fact.filter(key < tk.date_key(f.last_date + timedelta(days=1)))
    if f.first_date or f.last_date or f.years or f.months:
        fact = fact.filter(star.calendar.covers(key))
    if skip and f.years:
        fact = fact.filter(_any_range(key, _months_covered(f)))
    if f.years:
        fact = fact.filter(tk.key_year(key).isin(f.years))
    if f.months:
        fact = fact.filter(tk.key_month(key).isin(f.months))
    if f.distance_categories:
        fact = fact.filter(distance_category(col("TripDistance")).isin(f.distance_categories))
    if f.boroughs:
        zones = star.dimlocation.filter(col("Borough").isin(f.boroughs)).select("LocationID")
        if skip:
            ids = [r[0] for r in zones.filter("LocationID IS NOT NULL").collect()]
            fact = fact.filter(_any_range(col("PULocationID"), runs(ids) or [(1, 0)]))
        fact = fact.join(zones, col("PULocationID") == col("LocationID"), "left_semi")
    if f.payment_types:
        kinds = star.dimpayment.filter(col("paymenttype").isin(f.payment_types)).select(
            col("paymenttypeid").alias("kind_id")
        )
        fact = fact.join(kinds, col("PaymentTypeID") == col("kind_id"), "left_semi")
    return star.with_fact(fact)


def by_team(conversations: DataFrame, team_id: int) -> DataFrame:
    return conversations.filter(col("team_id") == team_id)


def chart_rows(chart: DataFrame, cap: int | None = None) -> DataFrame:
    """A chart whole, or its first rows where a caller asks for so many."""
    return chart if cap is None else chart.limit(cap)


def sample_rows(df: DataFrame, fraction: float, n: int, seed: int) -> DataFrame:
    """A seeded Bernoulli sample in random order, at most ``n`` rows."""
    return df.sample(fraction=fraction, seed=seed).orderBy(F.rand(seed)).limit(n)


def keyed_sample(df: DataFrame, key: str, n: int, seed: int, fraction: float = 1.0) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of their key, of those below ``fraction``.

    It depends on the keys alone: the same rows in any partitioning, order and engine. Samples of
    parts of a table merge into that of the whole, so each task keeps ``n`` rows. Rows
    with equal keys stand or fall together except at the end; a NULL key is in no sample.
    """
    tag = F.md5(F.concat(lit(f"{seed}:"), col(key).cast("string")).cast("binary"))
    slot = F.conv(F.substring(tag, 1, 8), 16, 10).cast("long")
    return df.filter(slot < fraction * 2**32).orderBy(tag).limit(n)
