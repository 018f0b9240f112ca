"""Expressions on hand-made rows: edges, NULLs and calendar traps."""

from datetime import date, datetime

import pytest
from pyspark.sql.functions import col, lit

from tripspark.functions import buckets, labels
from tripspark.functions import timekeys as tk
from tripspark.functions.quality import add_quality_checks


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def over(spark, ddl, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r["x"] for r in df.select("i", expr(col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_minute_key(spark, kind):
    stamps = [datetime(2024, 1, 1, 8, 0, 59), datetime(2024, 10, 11, 20, 14), None]
    assert over(spark, kind, stamps, lambda _: tk.minute_key("v")) == [202401010800, 202410112014, None]


def test_minute_key_of_text(spark):
    assert one(spark, tk.minute_key("'2024-01-01 08:30:00'")) == 202401010830


def test_minute_key_ignores_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in New York on that night.
        stamp = "timestamp_ntz'2024-03-10 02:30:00'"
        assert one(spark, tk.minute_key(stamp)) == 202403100230
        assert one(spark, tk.key_timestamp(lit(202403100230))) == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unix_minute_key_rounds_half_up(spark):
    stamps = [
        datetime(2023, 12, 7, 19, 29),
        datetime(2023, 12, 7, 19, 28, 30),
        datetime(2023, 12, 7, 19, 29, 29, 999999),
    ]
    got = over(spark, "timestamp_ntz", stamps, lambda _: tk.unix_minute_key("v"))
    assert got == [1701977340] * 3


def test_key_parts(spark):
    key = lit(202402291307)
    assert one(spark, tk.key_date(key)) == date(2024, 2, 29)
    assert one(spark, tk.key_year(key)) == 2024
    assert one(spark, tk.key_month(key)) == 2
    assert one(spark, tk.key_day(key)) == 29
    assert one(spark, tk.key_hour(key)) == 13
    assert one(spark, tk.key_minute(key)) == 7
    assert one(spark, tk.key_timestamp(key)) == datetime(2024, 2, 29, 13, 7)
    assert tk.date_key(date(2024, 2, 29)) == 202402290000


def test_durations_over_midnight_and_inside_an_hour(spark):
    pick, drop = lit(202401012355), lit(202401020005)
    assert one(spark, tk.encoded_duration(pick, drop)) == 76
    assert one(spark, tk.true_minutes(pick, drop)) == 10
    pick, drop = lit(202401010800), lit(202401010830)
    assert one(spark, tk.encoded_duration(pick, drop)) == 0
    assert one(spark, tk.true_minutes(pick, drop)) == 30
    pick, drop = lit(202402282359), lit(202403010001)
    assert one(spark, tk.true_minutes(pick, drop)) == 1442


def test_weeks_and_weekdays(spark):
    days = [date(2023, 12, 7), date(2022, 12, 28), date(2024, 1, 6), date(2024, 1, 7), None]
    assert over(spark, "date", days, tk.week_of_year) == [49, 52, 1, 1, None]
    assert over(spark, "date", days, tk.day_of_week) == [4, 3, 6, 0, None]
    weekend = over(spark, "date", days, lambda d: labels.is_weekend(tk.day_of_week(d)))
    assert weekend == [False, False, True, True, False]
    names = over(spark, "date", days, lambda d: labels.day_name(tk.day_of_week(d)))
    assert names == ["Thursday", "Wednesday", "Saturday", "Sunday", None]
    short = over(spark, "date", days, lambda d: labels.day_name(tk.day_of_week(d), short=True))
    assert short == ["Thu", "Wed", "Sat", "Sun", None]


def test_month_attributes(spark):
    months = list(range(1, 13)) + [None]
    assert over(spark, "int", months, labels.quarter) == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 4
    assert over(spark, "int", months, labels.season) == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter", "Fall"]
    )
    assert over(spark, "int", months, labels.month_name) == labels.MONTH_NAMES + [None]
    assert over(spark, "int", [5, 9], lambda c: labels.month_name(c, short=True)) == ["May", "Sep"]


def test_buckets(spark):
    assert over(
        spark, "double", [10.0, 10.01, 50.0, 50.01, None, -1.0], buckets.fare_category
    ) == ["0-10", "10-20", "30-50", "50+", "50+", "0-10"]
    tips = [0.0, 2.0, 2.01, 10.0, 10.01, None]
    assert over(spark, "double", tips, buckets.tip_category) == [
        "No Tip", "0-2", "2-5", "5-10", "10+", "10+",
    ]
    assert over(spark, "double", tips, buckets.tip_category_coarse) == [
        "No Tip", "0-5", "0-5", "5-10", "10+", "10+",
    ]
    assert over(spark, "double", [1.0, 3.0, 5.0, 10.0, 10.01], buckets.distance_category) == [
        "0-1 mile", "1-3 miles", "3-5 miles", "5-10 miles", "10+ miles",
    ]


def test_label_order_puts_strangers_last(spark):
    df = spark.createDataFrame([("50+",), ("x",), ("0-10",), (None,), ("10-20",)], "c string")
    ranked = df.orderBy(buckets.rank_of("c", buckets.FARE_ORDER), "c").collect()
    assert [r["c"] for r in ranked] == ["0-10", "10-20", "50+", None, "x"]


def test_tip_percentage_is_zero_without_a_fare(spark):
    rows = [(1.0, 0.0), (1.0, -5.0), (1.0, None), (2.0, 10.0)]
    df = spark.createDataFrame(rows, "tip double, fare double")
    got = [r[0] for r in df.select(buckets.tip_percentage(col("tip"), col("fare"))).collect()]
    assert got == [0.0, 0.0, 0.0, 20.0]


def test_quality_flag(spark):
    a, b = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9)
    rows = [
        (a, b, 1, 2), (a, a, 1, 2), (b, a, 1, 2), (None, b, 1, 2), (a, None, 1, 2),
        (a, b, None, 2), (a, b, 1, None), (None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "PULocationID long, DOLocationID long",
    )
    flags = [r["quality_issue"] for r in add_quality_checks(df).collect()]
    assert flags == ["good", "good"] + ["corrupted"] * 6
