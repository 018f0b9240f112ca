"""Physical plans: what must hold when the tables are large."""

import re

import pytest

import __spark_entry__ as spark_entry
from tripspark.plans import catalogue, gold, wide

QUERIES = spark_entry.QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_joins_and_no_python_workers(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert bad not in text


def scan_columns(df, table: str) -> set[str]:
    for line in plan(df).splitlines():
        if "FileScan" in line and f"/{table}.parquet" in line:
            return set(re.findall(r"(\w+):", line.split("ReadSchema: struct<")[1]))
    raise AssertionError(f"{table} is not read")


def test_scans_read_only_what_is_used(spark, sf_dir):
    df = QUERIES["kpi_total_trips"](spark, sf_dir)
    assert scan_columns(df, "lineitem") == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}
    df = QUERIES["kpi_avg_fare"](spark, sf_dir)
    assert "l_tax" not in scan_columns(df, "lineitem")


def test_one_indicator_does_not_compute_the_others(spark, sf_dir):
    text = optimized(gold.kpi_avg_fare(catalogue.star_of(spark, sf_dir)))
    assert "l_tax" not in text.split("Relation")[0] and "l_discount" not in text.split("Join")[0]


def test_quality_filter_reaches_both_sides_of_the_join(spark, sf_dir):
    text = plan(QUERIES["trips_by_borough"](spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert any("IsNotNull(s_nationkey)" in p for p in pushed)
    assert any("IsNotNull(c_nationkey)" in p for p in pushed)
    assert any("IsNotNull(o_orderdate)" in p for p in pushed)


def test_time_queries_do_not_join_the_minutes(spark, sf_dir):
    for name in ("daily_trends", "hour_day_heatmap", "gold_daily"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Range (" not in text and "LeftOuter" not in text


def test_charts_join_only_the_dimensions_they_show(spark, sf_dir):
    text = plan(QUERIES["chart_borough"](spark, sf_dir))
    assert text.count("LeftOuter") == 1
    assert "LocalTableScan" not in text


def test_zone_filter_turns_the_outer_join_into_an_inner_one(spark, sf_dir):
    assert "LeftOuter" not in plan(QUERIES["top_zones"](spark, sf_dir))


def test_limit_runs_before_the_dimension_joins(spark, sf_dir):
    text = plan(wide.trips_wide_plain(catalogue.star_of(spark, sf_dir), n=1000))
    lines = text.splitlines()
    limit = next(i for i, line in enumerate(lines) if "TakeOrderedAndProject" in line)
    assert sum("LeftOuter" in line for line in lines[:limit]) == 4
    assert not any("LeftOuter" in line for line in lines[limit:])


def test_wide_datasets_have_no_limit(spark, sf_dir):
    for name in ("trips_wide_dates", "trips_wide_buckets", "trips_wide_plain"):
        assert "Limit" not in plan(QUERIES[name](spark, sf_dir))


def test_quality_report_reads_the_trips_once(spark, sf_dir):
    text = plan(QUERIES["quality_report"](spark, sf_dir))
    assert text.count("lineitem.parquet") == 1


def test_pickup_and_dropoff_come_from_one_scan(spark, sf_dir):
    text = plan(QUERIES["pickup_vs_dropoff"](spark, sf_dir))
    assert text.count("lineitem.parquet") == 1


def test_histogram_finds_the_range_once_and_shuffles_bins_only(spark, sf_dir):
    df = QUERIES["hist_fare"](spark, sf_dir)
    df.collect()
    executed = plan(df).split("== Initial Plan ==")[0]
    assert executed.count("functions=[min(") == 1
    assert "ReusedSubquery" in executed
    assert "hashpartitioning(value" not in executed
