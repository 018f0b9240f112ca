"""Loads that count what they write, refreshes that find their days, facts ordered for skipping."""

import os
import random
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tests.trips import trip, write_bronze
from tripspark.operators.clustering import runs, z_order
from tripspark.operators.filters import DashboardFilters, apply_filters
from tripspark.operators.star import Calendar, Star
from tripspark.plans import gold, silver
from tripspark.schemas import DIMLOCATION
from tripspark.sinks import tables as sink
from tripspark.sources import dimensions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def on(day, **changes):
    """A trip of that day in January 2024."""
    return trip(
        day=(2024, 1, day),
        tpep_pickup_datetime=datetime(2024, 1, day, 8),
        tpep_dropoff_datetime=datetime(2024, 1, day, 9),
        **changes,
    )


def jan(day):
    return date(2024, 1, day)


def load(spark, root, table, first, last):
    days = silver.LoadDays(jan(first), jan(last), 0)
    return silver.load_facts(spark, root, table, days)


@pytest.mark.parametrize("at_once", [62, 2])
def test_outcome_is_counted_in_the_write(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(silver, "DAYS_AT_ONCE", at_once)
    root, table = str(tmp_path / "bronze"), f"observed_{at_once}.fact_trip"
    sink.create_namespace(spark, table.split(".")[0])
    rows = [on(d, fare_amount=float(i)) for d in (1, 2, 3, 5) for i in range(d * 10)]
    write_bronze(spark, rows, root)
    outcome = load(spark, root, table, 1, 5)
    plan = outcome._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan
    got = {r.source_date.day: (r.rows, r.success) for r in outcome.collect()}
    assert got == {1: (10, True), 2: (20, True), 3: (30, True), 4: (0, False), 5: (50, True)}
    fact = spark.table(table)
    assert fact.count() == 110
    hashed = fact.select("source_date", F.xxhash64(*fact.columns).alias("h"))
    want = hashed.groupBy("source_date").agg(F.count("*"), F.bit_xor("h")).collect()
    ledger = spark.table(f"{table}_ledger").select("source_date", "rows", "digest").collect()
    assert sorted(map(tuple, ledger)) == sorted(map(tuple, want))


RETRIED = """
import sys
sys.path.insert(0, {root!r})
from datetime import date
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tripspark.plans import silver
from tripspark.sinks import tables as sink

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", {folder!r}).getOrCreate())

def once(batches):
    if TaskContext.get().attemptNumber() == 0:
        rows = [b for b in batches]
        raise RuntimeError("lost")
    yield from batches

days = [date(2024, 1, d) for d in (1, 2, 3)]
df = spark.range(0, 3000, 1, 4).select(
    "id", F.expr("date_add(date'2024-01-01', CAST(id % 3 AS INT))").alias("source_date"))
counts, observe = silver._counted(days)
# The rows fail behind the observation too, in the stage that writes.
sink.overwrite_partitions(df, "t", "source_date", observe=lambda r: observe(r).mapInArrow(once, r.schema))
found = counts.get
print("COUNTS", [found[f"rows_{{i}}"] for i in range(3)], spark.table("t").count())
"""


def test_counts_are_right_after_retried_tasks(tmp_path):
    script = tmp_path / "retried.py"
    script.write_text(RETRIED.format(root=ROOT, folder=str(tmp_path / "warehouse")))
    done = subprocess.run(
        [sys.executable, str(script)], capture_output=True, text=True, timeout=300, cwd=tmp_path
    )
    assert "COUNTS [1000, 1000, 1000] 3000" in done.stdout, done.stderr[-2000:]


def test_refresh_rebuilds_the_days_that_changed(spark, tmp_path):
    root, table, ledger = str(tmp_path / "bronze"), "led.fact_trip", "led.fact_trip_ledger"
    sink.create_namespace(spark, "led")
    zones = tmp_path / "zones.csv"
    zones.write_text('"LocationID","Borough","Zone","service_zone"\n"100","M","G","Y"\n')
    silver.build_dimensions(spark, str(zones), "led", jan(1), jan(9))
    write_bronze(spark, [on(d, fare_amount=float(d)) for d in (1, 2, 3, 4) for _ in range(3)], root)

    def refresh():
        star = silver.star_from_tables(spark, "led")
        return gold.refresh_changed(star, ledger, "led_gold")

    def same_as_whole():
        star = silver.star_from_tables(spark, "led")
        for name, whole in (
            ("daily_aggregations", gold.gold_daily(star)),
            ("borough_aggregations", gold.gold_borough(star)),
        ):
            built = spark.table(f"led_gold.{name}")
            got, want = built.collect(), whole.select(built.columns).collect()
            assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)

    load(spark, root, table, 1, 4)
    assert refresh() == {jan(d): False for d in (1, 2, 3, 4)}
    same_as_whole()
    assert refresh() == {}
    load(spark, root, table, 2, 2)  # the same rows again
    assert refresh() == {}
    write_bronze(spark, [on(2, fare_amount=9.5), on(5)], root)
    load(spark, root, table, 1, 5)
    assert refresh() == {jan(2): False, jan(5): False}
    same_as_whole()
    silver.delete_days(spark, table, [jan(3), jan(8)])
    assert refresh() == {jan(3): True}
    assert spark.table(table).filter(col("source_date") == jan(3)).isEmpty()
    same_as_whole()
    assert refresh() == {}
    # A load that died half way leaves the day without digest: it is built until one succeeds.
    silver._note(spark, table, [(jan(1), None, None)], "parquet")
    assert refresh() == {jan(1): False} == refresh()
    load(spark, root, table, 1, 1)
    assert refresh() == {}
    same_as_whole()


def test_z_order_and_runs(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(16), rng.randrange(16)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", z_order([col("a"), col("b")], 4).alias("z"))
    for a, b, z in df.collect():
        bits = "".join(x + y for x, y in zip(f"{a:04b}", f"{b:04b}", strict=True))
        assert z == int(bits, 2)
    assert runs([5, 1, 2, 3, 9, 3]) == [(1, 3), (5, 5), (9, 9)]
    assert runs([1, 3, 4, 90, 95], most=2) == [(1, 4), (90, 95)]
    assert runs([]) == []


def scanned_rows(df):
    """Rows that the scan of the fact let through, and the result."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    found = []

    def walk(node):
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if "Scan parquet" in node.nodeName() and "fact_trip" in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found), rows


def test_clustered_facts_are_skipped_by_place_and_month(spark):
    """A month and a borough, whose places are not next to each other, of two years."""
    n, places = 96_000, 256
    bronze = spark.range(n).selectExpr(
        "make_timestamp_ntz(2024 + CAST(id % 2 AS INT), CAST(id div 2 % 12 + 1 AS INT),"
        " 1, CAST(pmod(hash(id), 24) AS INT), 0, 0) AS pickup",
        f"CAST(pmod(xxhash64(id), {places}) AS BIGINT) AS PULocationID",
        "id",
    ).selectExpr(
        "1L AS VendorID", "pickup AS tpep_pickup_datetime",
        "pickup + INTERVAL 20 MINUTES AS tpep_dropoff_datetime", "1.0D AS passenger_count",
        "2.0D AS trip_distance", "1.0D AS RatecodeID", "'N' AS store_and_fwd_flag", "PULocationID",
        "7L AS DOLocationID", "1L AS payment_type", "10.5D AS fare_amount", "0.5D AS extra",
        "0.5D AS mta_tax", "1.0D AS tip_amount", "0.0D AS tolls_amount",
        "0.3D AS improvement_surcharge", "CAST(id % 1000 AS DOUBLE) / 100 AS total_amount",
        "2.5D AS congestion_surcharge", "0.0D AS Airport_fee", "year(pickup) AS year",
        "month(pickup) AS month", "day(pickup) AS day",
    )
    sink.create_namespace(spark, "clustered")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "4096")  # many row groups, as a large day has
    try:
        sink.overwrite_partitions(
            silver.transform_trips(bronze, 0),
            "clustered.fact_trip",
            "source_date",
            sort_by=silver.place_and_time(),
            cluster=True,
        )
    finally:
        hadoop.unset("parquet.block.size")
    zones = [(i, "AB"[i // 16 in (6, 12)], f"z{i}", "Boro") for i in range(places)]
    star = Star(
        spark,
        spark.table("clustered.fact_trip"),
        spark.createDataFrame(zones, DIMLOCATION),
        dimensions.dimpayment(spark),
        dimensions.dimratecode(spark),
        lambda: dimensions.dimtime(spark, date(2024, 1, 1), date(2026, 1, 1)),
        Calendar.between(date(2024, 1, 1), date(2026, 1, 1)),
    )
    chosen = DashboardFilters(years=[2024], months=[3], boroughs=["B"])
    read, found = scanned_rows(gold.revenue_by_payment(apply_filters(star, chosen, skip=True)))
    _, want = scanned_rows(gold.revenue_by_payment(apply_filters(star, chosen)))
    assert found == want and 400 < found[0].trip_count < 600
    assert 0 < read < n / 10
    by_place, _ = scanned_rows(
        gold.revenue_by_payment(apply_filters(star, DashboardFilters(boroughs=["B"]), skip=True))
    )
    assert by_place < n * 0.6  # an eighth of the places, in two runs
    nowhere = DashboardFilters(boroughs=["Z"])
    assert gold.revenue_by_payment(apply_filters(star, nowhere, skip=True)).collect() == []
