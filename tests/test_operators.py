"""Star joins, filters, shares and histograms against brute force on small fixtures."""

import hashlib
import math
import random
from datetime import date
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.operators import filters, shares
from tripspark.operators.exact import (
    added_parts,
    aggregate,
    avg_percent,
    count_rows,
    exact_avg,
    exact_sum,
    exact_total,
    range_key,
    sum_of_parts,
    sum_parts,
    with_digits,
)
from tripspark.operators.histogram import histogram, not_in_bins
from tripspark.operators.star import Calendar, Star, with_time, with_time_joined
from tripspark.plans import charts, gold, rollup, wide
from tripspark.schemas import DIMLOCATION, FACT_TRIP
from tripspark.sources import dimensions

N = 3000


@pytest.fixture(scope="module")
def star(spark):
    """Trips of which a third share one pickup place and one minute; some codes and
    places have no dimension row, and some days lie outside the calendar."""
    rng = random.Random(7)
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        day = 5 if hot else rng.randint(1, 20)
        pick = 202402010000 + day * 10_000 + (830 if hot else rng.randint(0, 22) * 100)
        fare = rng.choice([0.0, -3.0, 5.0, 12.5, 25.0, 40.0, 75.25, None])
        rows.append((
            i, pick, pick + rng.randint(0, 59), 1 if hot else rng.choice([1, 2, 3, 9]),
            rng.choice([1, 2, 3, 9]), rng.choice([1, 2, 99, 50]), rng.choice([0, 1, 2, 8]),
            rng.randint(1, 6), rng.choice([0.5, 2.0, 4.0, 8.0, 20.0]), fare,
            rng.choice([0.0, 1.0, 3.0, 7.0, 15.0]), 0.0, 0.0, (fare or 0.0) + 2.0, 0.5, 0.5, 2.5,
            "good" if rng.random() < 0.9 else "corrupted", 2025, 2, day,
        ))
    fact = spark.createDataFrame(rows, FACT_TRIP).repartition(4)
    places = spark.createDataFrame(
        [(1, "Manhattan", "A", "Yellow Zone"), (2, "Queens", "JFK", "Airports"),
         (3, "Queens", "C", "Boro Zone")],
        DIMLOCATION,
    )
    first, last = date(2024, 2, 3), date(2024, 2, 20)
    return Star(
        spark, fact, places, dimensions.dimpayment(spark), dimensions.dimratecode(spark),
        dimensions.dimtime(spark, first, last), Calendar.between(first, last),
    )


@pytest.fixture(scope="module")
def stored_rollup(star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup"))
    rollup.write(star, path)
    return rollup.read(star.spark, path)


@pytest.fixture(scope="module")
def trips(star):
    return [r.asDict() for r in star.fact.collect()]


def test_time_attributes_equal_the_join(star):
    names = ["TripID", "trip_date", "trip_year", "trip_month", "trip_day", "trip_hour"]
    derived = with_time(star.good(), star).select(*names)
    joined = with_time_joined(star.good(), star.dimtime).select(*names)
    assert derived.exceptAll(joined).count() == joined.exceptAll(derived).count() == 0
    assert derived.filter(col("trip_date").isNull()).count() > 0


def test_unmatched_minutes_form_a_null_group(star, trips):
    outside = [
        t for t in trips
        if t["quality_issue"] == "good"
        and not 202402030000 <= t["PickupDateTimeID"] <= 202402200000
    ]
    first = gold.daily_trends(star).first()
    assert first["trip_date"] is None and first["trip_count"] == len(outside) > 0
    row = wide.trips_wide(star).filter(col("trip_date").isNull()).first()
    assert (row.quarter, row.is_weekend, row.day_name, row.month_name) == (4, False, None, None)
    seasons = {r["season"]: r["trip_count"] for r in gold.seasonal_analysis(star).collect()}
    assert seasons["Fall"] == len(outside)


def test_places_without_a_zone(star, trips):
    good = [t for t in trips if t["quality_issue"] == "good"]
    per_chart = {r[0]: r[1] for r in charts.chart_borough(star).collect()}
    assert per_chart[None] == sum(t["PULocationID"] == 9 for t in good) > 0
    assert sum(per_chart.values()) == len(good)
    ranked = {r["pickup_borough"]: r["trip_count"] for r in gold.trips_by_borough(star).collect()}
    assert ranked == {k: v for k, v in per_chart.items() if k is not None}


def test_pickup_and_dropoff_counts(star, trips):
    borough = {1: "Manhattan", 2: "Queens", 3: "Queens"}
    want = {}
    for t in trips:
        if t["quality_issue"] == "good":
            for kind, place in (("Pickup", t["PULocationID"]), ("Dropoff", t["DOLocationID"])):
                if place in borough:
                    key = (kind, borough[place])
                    want[key] = want.get(key, 0) + 1
    got = {(r.trip_type, r.borough): r.trip_count for r in gold.pickup_vs_dropoff(star).collect()}
    assert got == want


def test_quality_report_adds_up(star, trips):
    report = {r["metric"]: r["value"] for r in gold.quality_report(star).collect()}
    good = sum(t["quality_issue"] == "good" for t in trips)
    assert report == {
        "Total Records": N, "Good Quality Records": good, "Corrupted Records": N - good,
        "Data Completeness %": round(good * 100 / N, 2),
    }


def test_reports_on_an_empty_fact(spark, star):
    empty = star.with_fact(spark.createDataFrame([], FACT_TRIP))
    report = {r["metric"]: r["value"] for r in gold.quality_report(empty).collect()}
    assert report["Total Records"] == 0 and report["Data Completeness %"] is None
    assert gold.year_distribution(empty).count() == 0
    assert gold.kpi_total_trips(empty).first()[0] == 0
    bins = charts.hist_fare(empty).collect()
    assert len(bins) == 20 and {r["trip_count"] for r in bins} == {0}


def test_bucket_counts_sum_to_the_trips(star, trips):
    good = [t for t in trips if t["quality_issue"] == "good"]
    for chart in (gold.fare_distribution, gold.distance_analysis, gold.passenger_distribution):
        assert sum(r["trip_count"] for r in chart(star).collect()) == len(good)
    tipped = sum(t["TipAmount"] > 0 for t in good)
    rows = gold.tip_analysis(star).collect()
    assert sum(r["trip_count"] for r in rows) == tipped
    assert [r["tip_category"] for r in rows] == ["0-2", "2-5", "5-10", "10+"]


def test_display_orders(star):
    days = [r["day_name"] for r in gold.peak_hours(star).collect()]
    order = {d: i for i, d in enumerate(
        ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday", None]
    )}
    assert days == sorted(days, key=order.get)
    fares = [r["fare_category"] for r in gold.fare_distribution(star).collect()]
    assert fares == ["0-10", "10-20", "20-30", "30-50", "50+"]


def test_shares_sum_to_one_hundred(star):
    for df, name in (
        (gold.year_distribution(star), "percentage"),
        (gold.top_boroughs(star), "revenue_percentage"),
    ):
        assert sum(r[name] for r in df.collect()) == pytest.approx(100, abs=0.05)


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v long")
    assert [r["p"] for r in shares.with_share(df, "v", "p").collect()] == [None, None]


def test_top_zones_breaks_ties_by_name(spark, star):
    rows = star.fact.limit(0)
    place = star.fact.filter(col("quality_issue") == "good")
    two = place.withColumn("PULocationID", F.lit(3)).limit(5).unionByName(
        place.withColumn("PULocationID", F.lit(1)).limit(5)
    ).unionByName(rows)
    top = gold.top_zones(star.with_fact(two), n=1).collect()
    assert [(r["pickup_zone"], r["trip_count"]) for r in top] == [("A", 5)]


def test_limited_datasets_equal_the_wide_one(star):
    limited = wide.trips_wide_dates(star, n=50)
    names = [c for c in limited.columns if c != "tripid"]
    whole = wide.trips_wide(star).orderBy(*wide.STABLE_ORDER).limit(50)
    left = sorted(map(repr, limited.select(*names).collect()))
    right = sorted(map(repr, whole.select(*names).collect()))
    assert left == right


# --- filters --------------------------------------------------------------------------


def test_filters_against_brute_force(star, trips):
    chosen = filters.DashboardFilters(
        years=[2024], months=[2], boroughs=["Queens"], payment_types=["Cash", "Credit card"],
        distance_categories=["1-3 miles", "10+ miles"],
        first_date=date(2024, 2, 4), last_date=date(2024, 2, 15),
    )
    want = sorted(
        t["TripID"] for t in trips
        if t["PULocationID"] in (2, 3) and t["PaymentTypeID"] in (1, 2)
        and t["TripDistance"] in (2.0, 20.0)
        and 202402040000 <= t["PickupDateTimeID"] < 202402160000
    )
    got = sorted(r[0] for r in filters.apply_filters(star, chosen).fact.select("TripID").collect())
    assert got == want and want


def test_empty_filters_pass_everything(star):
    same = filters.apply_filters(star, filters.DashboardFilters())
    assert same.fact.count() == N


def test_last_30_days_and_row_caps(star):
    recent = filters.last_30_days(date(2024, 3, 1))
    assert (recent.first_date, recent.last_date) == (date(2024, 1, 31), date(2024, 3, 1))
    assert filters.chart_rows(star.fact).count() == N
    assert filters.chart_rows(star.fact, 10).count() == 10
    sample = filters.sample_rows(star.fact, 0.5, 20, seed=3)
    assert sample.count() == 20


def test_drill_down_sums_to_the_borough(star):
    zones = gold.borough_zones(star, "Queens").collect()
    total = {r["pickup_borough"]: r["trip_count"] for r in gold.trips_by_borough(star).collect()}
    assert sum(r["trip_count"] for r in zones) == total["Queens"]


# --- histograms and rounding ----------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_matches_numpy(spark, seed):
    rng = random.Random(seed)
    values = [rng.uniform(-50, 200) for _ in range(400)] + [7.0] * 200 + [None] * 20
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = histogram(df, "v", 20).collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins=20)
    assert [r["trip_count"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1]["bin_end"] == pytest.approx(edges[-1])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    rows = histogram(df, "v", 4).collect()
    assert [r["trip_count"] for r in rows] == [5, 0, 0, 0]
    assert {r["bin_start"] for r in rows} == {3.0}


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_histogram_leaves_out_what_is_no_number(spark, odd):
    values = [(float(i),) for i in range(100)]
    plain = histogram(spark.createDataFrame(values, "v double"), "v", 10).collect()
    mixed = spark.createDataFrame([*values, (odd,), (None,)], "v double")
    assert histogram(mixed, "v", 10).collect() == plain
    left_out = not_in_bins(mixed, "v").first().asDict()
    assert left_out["nulls"] == 1 and left_out["nans"] + left_out["infinite"] == 1


def exactly(printed):
    """The sum of decimals as the nearest double. Values are given as Spark prints them."""
    total = sum(map(Fraction, printed), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def many_sums():
    rng = random.Random(1)
    groups = [
        [4e-7] * 1000,
        [1e16, 1e-6],
        [1e300, 1.0, -1e300],
        [5e-324] * 3,
        [1.7e308, 1.7e308],
        [1.7e308, 1.7e308, -1.7e308],
        [0.1] * 10,
        [-0.1] * 10,
        [0.0, 0.0],
        [123456789.012345, 1e9, -1e9, 999999999.999999, 1234567890.1234567, 1e-6, 5e-7],
    ]
    for spread in (5, 60, 300) * 20:
        n = rng.randrange(1, 40)
        groups.append([rng.uniform(-1, 1) * 2.0 ** rng.uniform(-spread, spread) for _ in range(n)])
    for _ in range(20):  # all bits, all magnitudes, subnormal ones included
        groups.append(
            [
                math.ldexp(rng.randrange(-(2**53), 2**53), rng.randrange(-1074, 960))
                for _ in range(30)
            ]
        )
    return groups


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_equal_those_of_fractions(spark, parts):
    groups = many_sums()
    rows = [(k, v) for k, values in enumerate(groups) for v in [*values, None]]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    found = aggregate(
        df, ["k"], exact_sum("v", "s"), exact_avg("v", "a"), exact_sum(-col("v"), "negative")
    ).collect()
    assert len(found) == len(groups)
    printed = {}
    for row in df.where("v IS NOT NULL").select("k", col("v").cast("string").alias("t")).collect():
        printed.setdefault(row.k, []).append(row.t)
    want = {k: exactly(texts) for k, texts in printed.items()}
    assert all(float(t) in groups[k] for k, texts in printed.items() for t in texts)
    for row in found:
        assert row.s == want[row.k] and row.negative == -want[row.k]
        assert row.a == want[row.k] / len(groups[row.k])
    listed = df.groupBy("k").agg(F.collect_list("v").alias("vs"))
    listed = listed.select("k", exact_total("vs").alias("s")).collect()
    assert all(r.s == want[r.k] for r in listed)


def test_a_million_small_values(spark):
    df = spark.range(1_000_000).select(F.lit(4e-7).alias("v"))
    assert aggregate(df, [], exact_sum("v", "s")).first().s == 0.4


def test_sums_added_up_in_steps(spark):
    rng = random.Random(2)
    values = [rng.randrange(-(10**15), 10**15) / 10 ** rng.randrange(3, 24) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    split = with_digits(df.withColumn("k", (F.rand(3) * 9).cast("int")), {"v": "v"})
    steps = split.groupBy("k", range_key("v")).agg(*sum_parts("v"))
    again = steps.groupBy("v_range").agg(*added_parts("v"))
    assert again.agg(sum_of_parts("v").alias("s")).first().s == exactly(map(repr, values))


def test_sums_of_odd_values(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(
            aggregate(df, [], exact_sum("v", "s"), exact_avg("v", "a"), count_rows("n")).first()
        )

    inf, nan = float("inf"), float("nan")
    assert np.isnan(total(1.0, nan)[0]) and np.isnan(total(inf, -inf, 1.0)[0])
    assert total(1.0, inf)[0] == inf and total(-inf, 1e308)[0] == -inf
    assert total(None, None) == (None, None, 2)
    assert total() == (None, None, 0)
    assert total(-0.0, None) == (0.0, 0.0, 2)


def test_shares_of_exact_totals(spark):
    rows = [("a", 1e300), ("b", 1.0), ("c", -1e300), ("d", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.share for r in shares.with_share(df, "v", "share").collect()}
    assert got["b"] == 25.0 and got["d"] == 75.0


def test_average_percentage(spark):
    def average(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return aggregate(df, [], avg_percent(col("v"), "a")).first()["a"]

    assert average(10.0, 20.0, None) == 15.0
    assert average(100 / 3, 100 / 3) == 33.333333
    assert average(None) is None
    assert np.isnan(average(1.0, float("nan")))
    assert average(1.0, float("inf")) == float("inf")


def test_keyed_sample_is_the_same_in_any_partitioning(spark):
    df = spark.range(5000).select(col("id").alias("k"), (col("id") % 7).alias("v"))
    want = sorted(
        (hashlib.md5(f"3:{k}".encode()).hexdigest(), k, k % 7) for k in range(5000)
    )
    for parts in (1, 9):
        got = filters.keyed_sample(df.repartition(parts), "k", 40, seed=3).collect()
        assert [tuple(r) for r in got] == [w[1:] for w in want[:40]]
    halves = [filters.keyed_sample(df.filter(c), "k", 40, seed=3) for c in ("k < 900", "k >= 900")]
    merged = filters.keyed_sample(halves[0].union(halves[1]), "k", 40, seed=3)
    assert [tuple(r) for r in merged.collect()] == [w[1:] for w in want[:40]]
    part = filters.keyed_sample(df, "k", 10**6, seed=3, fraction=0.1).count()
    assert part == sum(int(h[:8], 16) < 0.1 * 2**32 for h, _, _ in want) and 400 < part < 600
    other = filters.keyed_sample(df, "k", 40, seed=4).collect()
    assert {r.k for r in other} != {w[1] for w in want[:40]}
    assert filters.keyed_sample(df.withColumn("k", F.lit(None)), "k", 5, seed=1).isEmpty()


@pytest.mark.parametrize(
    "selection",
    [
        filters.DashboardFilters(),
        filters.DashboardFilters(boroughs=["Queens"], distance_categories=["1-3 miles", "10+ miles"]),
        filters.DashboardFilters(years=[2024], months=[2], payment_types=["Credit card", "Cash"]),
        filters.DashboardFilters(payment_types=["No such"]),
        filters.DashboardFilters(months=[2]),
    ],
)
def test_rollup_answers_any_selection(star, stored_rollup, selection):
    chosen = filters.apply_filters(star, selection)
    found = stored_rollup.filtered(selection)
    for name in (
        "monthly_trends", "year_over_year", "year_distribution", "seasonal_analysis",
        "trips_by_borough", "top_boroughs", "payment_analysis", "distance_analysis",
    ):
        want = getattr(gold, name)(chosen)
        got = getattr(found, name)()
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            map(tuple, want.collect()), key=repr
        )
    names = ["total_trips", "total_revenue", "avg_fare", "avg_tip_percentage"]
    assert found.kpis().first() == gold.kpi_summary(chosen).select(*names).first()


def test_rollup_reads_the_smallest_level(stored_rollup):
    one = filters.DashboardFilters(boroughs=["Queens"])
    assert stored_rollup.level([]) == []
    assert stored_rollup.filtered(one).level(["trip_month"]) == rollup.LEVELS[2]
    assert stored_rollup.filtered(one).level(["payment_type"]) == rollup.DIMENSIONS
    plan = stored_rollup.filtered(one).monthly_trends()._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("FileScan") == 1 and "TripDistance" not in text
    assert "PartitionFilters: [isnotnull(level" in text
    with pytest.raises(ValueError, match="months, not days"):
        stored_rollup.filtered(filters.DashboardFilters(last_date=date(2024, 2, 5)))
