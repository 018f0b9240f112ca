"""The fact projection, the daily load and the dimension build."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tests.trips import bronze, trip, write_bronze
from tripspark import jobs
from tripspark.operators.filters import DashboardFilters, apply_filters
from tripspark.plans import gold, silver
from tripspark.schemas import DIMTIME, FACT_TRIP, check_schema
from tripspark.sinks import tables as sink
from tripspark.sources import dimensions
from tripspark.sources.bronze import day_files, read_bronze

SAMPLE = [
    trip(
        day=(2024, 10, 11),
        tpep_pickup_datetime=datetime(2024, 10, 11, 20, 8, 40),
        tpep_dropoff_datetime=datetime(2024, 10, 11, 20, 14, 29),
        trip_distance=1.11, PULocationID=237, DOLocationID=162, fare_amount=7.9, extra=1.0,
        tip_amount=0.0, total_amount=12.9, Airport_fee=0.0,
    ),
    trip(
        day=(2024, 10, 11),
        tpep_pickup_datetime=datetime(2024, 10, 10, 21, 48, 5),
        tpep_dropoff_datetime=datetime(2024, 10, 11, 20, 53, 38),
        trip_distance=10.59, PULocationID=138, DOLocationID=125, payment_type=1,
        fare_amount=45.7, extra=6.0, tip_amount=6.44, tolls_amount=6.94, total_amount=70.83,
        Airport_fee=1.75,
    ),
]


def test_projection_of_sample_rows(spark):
    fact = silver.transform_trips(bronze(spark, SAMPLE))
    rows = [tuple(r)[1:] for r in fact.orderBy("TripDistance").collect()]
    day = date(2024, 10, 11)
    assert rows == [
        (202410112008, 202410112014, 237, 162, 1, 2, 1, 1.11, 7.9, 0.0, 0.0, 0.0, 12.9, 1.0, 0.5,
         2.5, "good", 2025, 10, 11, day),
        (202410102148, 202410112053, 138, 125, 1, 1, 1, 10.59, 45.7, 6.44, 6.94, 1.75, 70.83, 6.0,
         0.5, 2.5, "good", 2025, 10, 11, day),
    ]
    check_schema(fact, FACT_TRIP)


def test_plain_projection_keeps_raw_types(spark):
    plain = silver.plain_projection(bronze(spark, SAMPLE)).orderBy("TripDistance")
    row = plain.first()
    assert (row.RateCodeID, row.PassengerCount, row.PULocationID) == (1.0, 1.0, 237)
    assert dict(plain.dtypes)["RateCodeID"] == "double"
    assert "quality_issue" not in plain.columns


def test_values_out_of_range_become_null_not_errors(spark):
    fact = silver.transform_trips(bronze(spark, [trip(PULocationID=2**40, RatecodeID=1e12)]))
    row = fact.first()
    assert (row.PULocationID, row.RateCodeID) == (None, None)


def test_check_schema_names_what_is_wrong(spark):
    with pytest.raises(ValueError, match="TripID is missing.*year is bigint, expected int"):
        check_schema(spark.range(1).select(col("id").alias("year")), FACT_TRIP)


def planned(spark, days):
    return sorted(r[0] for r in silver.date_plan(silver._bounds(spark, days)).collect())


def test_date_plan_keeps_leap_day(spark):
    days = silver.LoadDays(date(2025, 2, 27), date(2025, 3, 1), 1)
    plan = planned(spark, days)
    assert plan == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert silver.source_bounds(spark, days) == (plan[0], plan[-1])


def test_date_plan_from_leap_day_and_empty_range(spark):
    leap = silver.LoadDays(date(2024, 2, 29), date(2024, 2, 29), 1)
    assert planned(spark, leap) == [date(2023, 2, 28)]
    backwards = silver.LoadDays(date(2024, 2, 2), date(2024, 2, 1), 0)
    assert planned(spark, backwards) == []


def test_daily_loads_reach_the_leap_day(spark):
    def one(*day, offset=1):
        return planned(spark, silver.LoadDays(date(*day), date(*day), offset))

    assert one(2025, 2, 28) == [date(2024, 2, 28), date(2024, 2, 29)]
    assert one(2025, 3, 1) == [date(2024, 3, 1)]
    assert one(2024, 2, 28) == one(2024, 2, 29) == [date(2023, 2, 28)]
    assert one(2024, 2, 29, offset=0) == [date(2024, 2, 29)]


def test_load_days_defaults():
    days = silver.load_days()
    assert days.start == days.end < date.today()
    assert silver.load_days(date(2024, 5, 1), offset_years=0) == silver.LoadDays(
        date(2024, 5, 1), date(2024, 5, 1), 0
    )


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    rows = [trip(day=(2024, 2, d), fare_amount=float(d)) for d in (27, 28, 28, 29)]
    rows += [trip(day=(2024, 3, 2), PULocationID=None), trip(day=(2023, 5, 5))]
    write_bronze(spark, rows, root)
    sink.create_namespace(spark, "silver_load")
    return root, "silver_load.fact_trip"


def test_load_is_idempotent_and_reports_days(spark, loaded):
    root, table = loaded
    days = silver.LoadDays(date(2025, 2, 27), date(2025, 3, 2), 1)
    first = silver.load_facts(spark, root, table, days)
    ids = sorted(r[0] for r in spark.table(table).select("TripID").collect())
    assert len(ids) == len(set(ids)) == 5
    assert [tuple(r) for r in first.orderBy("source_date").collect()] == [
        (date(2024, 2, 27), date(2025, 2, 27), 1, True),
        (date(2024, 2, 28), date(2025, 2, 28), 2, True),
        (date(2024, 2, 29), date(2025, 2, 28), 1, True),
        (date(2024, 3, 1), date(2025, 3, 1), 0, False),
        (date(2024, 3, 2), date(2025, 3, 2), 1, True),
    ]
    assert not silver.all_failed(first)

    silver.load_facts(spark, root, table, days)
    assert sorted(r[0] for r in spark.table(table).select("TripID").collect()) == ids

    one_day = silver.LoadDays(date(2025, 2, 28), date(2025, 2, 28), 1)
    silver.load_facts(spark, root, table, one_day)
    assert sorted(r[0] for r in spark.table(table).select("TripID").collect()) == ids
    check_schema(spark.table(table), FACT_TRIP)


def test_load_of_missing_days_fails_only_if_all_are_missing(spark, loaded):
    root, table = loaded
    days = silver.LoadDays(date(2030, 1, 1), date(2030, 1, 2), 1)
    before = spark.table(table).count()
    assert silver.all_failed(silver.load_facts(spark, root, table, days))
    assert spark.table(table).count() == before


def test_bronze_read_opens_planned_folders_only(spark, loaded):
    root, _ = loaded
    df = read_bronze(spark, root, date(2024, 2, 28), date(2024, 2, 29))
    assert df.count() == 3
    folders = {path.rsplit("/", 2)[-2] for path in df.inputFiles()}
    assert folders == {"day=28", "day=29"}
    assert sorted(day_files(spark, root, date(2024, 1, 1), date(2024, 12, 31))) == [
        date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 2)
    ]
    assert day_files(spark, root, date(1999, 1, 1), date(1999, 1, 2)) == {}
    assert read_bronze(spark, root, date(1999, 1, 1), date(1999, 1, 2)).count() == 0


PUBLISHED = {  # the shape of the published unit test: text timestamps and whole-number codes
    "tpep_pickup_datetime": "2024-01-01 08:00:00", "tpep_dropoff_datetime": "2024-01-01 08:30:00",
    "passenger_count": 1, "trip_distance": 2.5, "RatecodeID": 1, "store_and_fwd_flag": "N",
    "PULocationID": 100, "DOLocationID": 200, "payment_type": 2, "fare_amount": 10.0,
    "extra": 0.5, "mta_tax": 0.5, "tip_amount": 2.0, "tolls_amount": 0.0,
    "improvement_surcharge": 0.3, "total_amount": 13.3, "congestion_surcharge": 2.5,
    "Airport_fee": 1.25,
}


def test_bronze_types_may_differ_between_files(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(spark, [trip(day=(2024, 1, d)) for d in (1, 2)], root)
    for day in (1, 3):  # the first day holds files of both kinds
        spark.createDataFrame([PUBLISHED]).write.mode("append").parquet(
            f"{root}/year=2024/month=1/day={day}"
        )
    odd = {**PUBLISHED, "tpep_pickup_datetime": datetime(2024, 1, 4, 8), "passenger_count": "x"}
    spark.createDataFrame([odd]).write.parquet(f"{root}/year=2024/month=1/day=4")
    sink.create_namespace(spark, "silver_drift")
    days = silver.LoadDays(date(2025, 1, 1), date(2025, 1, 4))
    outcome = silver.load_facts(spark, root, "silver_drift.fact_trip", days)
    assert [r["rows"] for r in outcome.orderBy("source_date").collect()] == [2, 1, 1, 1]
    fact = spark.table("silver_drift.fact_trip")
    published = fact.filter("day = 3").first()
    assert (published.PickupDateTimeID, published.DropOffDateTimeID) == (202401010800, 202401010830)
    assert (published.RateCodeID, published.PassengerCount) == (1, 1)
    drifted = fact.filter("day = 4").first()
    assert (drifted.PickupDateTimeID, drifted.PassengerCount) == (202401040800, None)
    assert fact.select("TripID").distinct().count() == fact.count() == 5


def test_unreadable_day_does_not_cost_the_others(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(spark, [trip(day=(2024, 1, d)) for d in (1, 2, 3, 4)], root)
    folder = tmp_path / "bronze" / "year=2024" / "month=1" / "day=3"
    (folder / "broken.parquet").write_bytes(b"not parquet at all")
    sink.create_namespace(spark, "silver_broken")
    days = silver.LoadDays(date(2025, 1, 1), date(2025, 1, 5))
    outcome = silver.load_facts(spark, root, "silver_broken.fact_trip", days)
    assert [r["success"] for r in outcome.orderBy("source_date").collect()] == [
        True, True, False, True, False
    ]
    assert spark.table("silver_broken.fact_trip").count() == 3


def test_outcome_is_of_what_was_written(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(spark, [trip()], root)
    sink.create_namespace(spark, "silver_late")
    days = silver.LoadDays(date(2025, 1, 1), date(2025, 1, 1))
    outcome = silver.load_facts(spark, root, "silver_late.fact_trip", days)
    write_bronze(spark, [trip(), trip()], root)
    assert [r["rows"] for r in outcome.collect()] == [1]


def test_trip_ids_of_equal_rows_differ(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for _ in range(3):
        write_bronze(spark, [trip(), trip()], root)
    ids = silver.transform_trips(read_bronze(spark, root)).select("TripID")
    assert ids.distinct().count() == 6
    wide = read_bronze(spark, root).withColumn("file_number", F.lit(1 << silver.FILE_BITS))
    with pytest.raises(Exception, match="too many files"):
        silver.transform_trips(wide).select("TripID").collect()


def test_partition_mode_of_the_session_is_left_alone(spark, tmp_path):
    sink.create_namespace(spark, "silver_mode")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        df = spark.range(4).select("id", F.expr("date_add(date'2024-01-01', CAST(id AS INT))").alias("d"))
        sink.overwrite_partitions(df, "silver_mode.t", "d")
        sink.overwrite_partitions(df.filter("id = 2"), "silver_mode.t", "d", rebalance=False)
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)
    assert spark.table("silver_mode.t").count() == 4


def test_unreadable_file_raises(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=1" / "day=1"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="part-0.parquet"):
        read_bronze(spark, str(tmp_path)).count()


def test_other_files_in_the_folder_are_ignored(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(spark, [trip()], root)
    (tmp_path / "bronze" / "year=2024" / "month=1" / "day=1" / "notes.txt").write_text("x")
    assert read_bronze(spark, root).count() == 1


# --- dimensions -----------------------------------------------------------------------

ZONES = '''"LocationID","Borough","Zone","service_zone"
100,"Manhattan","Garment District","Yellow Zone"
132,"Queens","JFK Airport","Airports"
138,"Queens","LaGuardia Airport","Airports"
200,"Bronx","Riverdale/North Riverdale/Fieldston","Boro Zone"
264,"Unknown","N/A","N/A"
265,"N/A","Outside of NYC","N/A"
'''


def test_dimtime_grid(spark):
    grid = dimensions.dimtime(spark, date(2022, 1, 1), date(2025, 12, 31))
    row = grid.agg(
        F.count("*"), F.countDistinct("timeid"), F.min("timeid"), F.max("timeid"), F.sum("second")
    ).first()
    assert tuple(row) == (2_102_401, 2_102_401, 202201010000, 202512310000, 0)
    assert grid.schema.simpleString() == DIMTIME.simpleString()
    got = {
        r["timeid"]: tuple(r)[1:]
        for r in grid.filter(
            col("timeid").isin(202312071929, 202502260404, 202201202048, 202212280843)
        ).collect()
    }
    assert got[202312071929] == (date(2023, 12, 7), 7, 49, 12, 2023, 19, 29, 0)
    assert got[202502260404] == (date(2025, 2, 26), 26, 9, 2, 2025, 4, 4, 0)
    assert got[202201202048] == (date(2022, 1, 20), 20, 3, 1, 2022, 20, 48, 0)
    assert got[202212280843] == (date(2022, 12, 28), 28, 52, 12, 2022, 8, 43, 0)


def test_dimtime_matches_sequence(spark):
    grid = dimensions.dimtime(spark, date(2024, 2, 28), date(2024, 3, 1))
    want = spark.sql(
        "SELECT CAST(date_format(m, 'yyyyMMddHHmm') AS BIGINT) AS timeid, to_date(m) AS Date "
        "FROM (SELECT explode(sequence(timestamp_ntz'2024-02-28', timestamp_ntz'2024-03-01', "
        "interval 1 minute)) AS m)"
    )
    assert grid.select("timeid", "Date").exceptAll(want).count() == 0
    assert grid.count() == want.count() == 2881


def test_one_day_grid_has_both_ends(spark):
    assert dimensions.dimtime(spark, date(2022, 1, 1), date(2022, 1, 2)).count() == 1441


def test_build_dimensions_and_query_written_star(spark, tmp_path):
    zones = tmp_path / "zones.csv"
    zones.write_text(ZONES)
    calendar = (date(2024, 1, 1), date(2024, 1, 3))
    dims = silver.build_dimensions(spark, str(zones), "silver_dims", *calendar)
    assert {n: d.count() for n, d in dims.items()} == {
        "dimlocation": 6, "dimpayment": 6, "dimratecode": 8, "dimtime": 2881,
    }
    assert dims["dimlocation"].filter("Borough IS NULL").count() == 0
    # A rebuild replaces, it does not add.
    dims = silver.build_dimensions(spark, str(zones), "silver_dims", *calendar)
    assert dims["dimlocation"].count() == 6

    rows = [
        trip(), trip(PULocationID=132), trip(PULocationID=7), trip(PULocationID=None),
        trip(tpep_pickup_datetime=datetime(2024, 1, 9), tpep_dropoff_datetime=datetime(2024, 1, 9)),
    ]
    write_bronze(spark, rows, str(tmp_path / "bronze"))
    silver.load_facts(
        spark, str(tmp_path / "bronze"), "silver_dims.fact_trip",
        silver.LoadDays(date(2025, 1, 1), date(2025, 1, 1)),
    )
    star = silver.star_from_tables(spark, "silver_dims")
    borough = [tuple(r)[:2] for r in gold.trips_by_borough(star).collect()]
    assert borough == [("Manhattan", 2), ("Queens", 1)]
    daily = [tuple(r)[:2] for r in gold.daily_trends(star).collect()]
    assert daily == [(None, 1), (date(2024, 1, 1), 3)]

    gold.refresh_gold(star, "gold_test")
    assert spark.table("gold_test.daily_aggregations").count() == 2
    assert spark.table("gold_test.borough_aggregations").count() == 2


def test_jobs_end_to_end(spark, tmp_path):
    root, zones = str(tmp_path / "bronze"), tmp_path / "zones.csv"
    zones.write_text(ZONES)
    write_bronze(spark, [trip(), trip(day=(2024, 1, 2))], root)
    base = ["--namespace", "silver_jobs"]

    def run(*argv):
        return jobs.run(spark, jobs.parse([*base, *argv]))

    facts = ["facts", "--bronze", root, "--start-date"]
    assert run("dimensions", "--zones", str(zones), "--from-date", "2024-01-01",
               "--to-date", "2024-01-05") == 0
    assert run(*facts, "2025-01-01", "--end-date", "2025-01-03") == 0
    assert run(*facts, "2031-01-01") == 1
    assert run(*facts, "2024-01-02", "--data-year-offset", "0") == 0
    assert spark.table("silver_jobs.fact_trip").count() == 2
    assert run("gold", "--gold-namespace", "gold_jobs") == 0
    assert spark.table("gold_jobs.borough_aggregations").first()["trip_count"] == 2
    assert spark.table("silver_jobs.load_outcome").count() == 1


def test_jobs_follow_the_calendar_that_was_written(spark, tmp_path):
    """Trips of 2025 and 2026, up to the last minute of the last day."""
    root, zones = str(tmp_path / "bronze"), tmp_path / "zones.csv"
    zones.write_text(ZONES)
    starts = [datetime(2025, 12, 31, 23, 50), datetime(2026, 1, 1, 0, 5), datetime(2027, 12, 31, 23, 59)]
    rows = [
        trip(day=(t.year, t.month, t.day), tpep_pickup_datetime=t, tpep_dropoff_datetime=t)
        for t in starts
    ]
    write_bronze(spark, rows, root)
    base = ["--namespace", "silver_2026"]

    def run(*argv):
        return jobs.run(spark, jobs.parse([*base, *argv]))

    assert run("dimensions", "--zones", str(zones), "--from-date", "2025-01-01",
               "--to-date", "2027-12-31") == 0
    assert run("facts", "--bronze", root, "--start-date", "2025-12-31", "--end-date", "2027-12-31",
               "--data-year-offset", "0") == 0
    assert run("gold", "--gold-namespace", "gold_2026") == 0
    daily = spark.table("gold_2026.daily_aggregations").orderBy("trip_date").collect()
    assert [(r["trip_date"], r["trip_count"]) for r in daily] == [(t.date(), 1) for t in starts]
    star = silver.star_from_tables(spark, "silver_2026")

    def trips(**selection):
        chosen = apply_filters(star, DashboardFilters(**selection))
        return gold.kpi_total_trips(chosen).first()["total_trips"]

    assert trips(years=[2026]) == 1 and trips(years=[2025, 2027]) == 2
    assert trips(first_date=date(2025, 12, 31), last_date=date(2025, 12, 31)) == 1
    assert trips(last_date=date(2027, 12, 31)) == 3


def test_gold_refresh_reads_touched_days_only(spark, tmp_path):
    root, zones = str(tmp_path / "bronze"), tmp_path / "zones.csv"
    zones.write_text(ZONES)
    silver.build_dimensions(spark, str(zones), "silver_inc", date(2024, 1, 1), date(2024, 2, 1))
    days = [trip(day=(2024, 1, d), tpep_pickup_datetime=datetime(2024, 1, d, 8),
                 tpep_dropoff_datetime=datetime(2024, 1, d, 9)) for d in (1, 2, 3)]
    write_bronze(spark, [*days, trip(day=(2024, 1, 2), PULocationID=None)], root)

    def load(first, last):
        silver.load_facts(spark, root, "silver_inc.fact_trip",
                          silver.LoadDays(date(2024, 1, first), date(2024, 1, last), 0))

    def rows(name):
        return sorted(map(tuple, spark.table(f"gold_inc.{name}").collect()), key=repr)

    load(1, 3)
    star = silver.star_from_tables(spark, "silver_inc")
    gold.refresh_gold(star, "gold_inc")
    for name, whole in (("daily_aggregations", gold.gold_daily), ("borough_aggregations", gold.gold_borough)):
        assert rows(name) == sorted(map(tuple, whole(star).select(spark.table(f"gold_inc.{name}").columns).collect()), key=repr)

    write_bronze(spark, [trip(day=(2024, 1, 2), fare_amount=30.0)], root)
    load(2, 2)
    star = silver.star_from_tables(spark, "silver_inc")
    touched = star.with_fact(star.fact.filter("source_date = date'2024-01-02'"))
    plan = gold.gold_parts(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_date" in plan
    gold.refresh_gold(star, "gold_inc", first=date(2024, 1, 2), last=date(2024, 1, 2))
    assert rows("daily_aggregations") == sorted(map(tuple, gold.gold_daily(star).select(
        spark.table("gold_inc.daily_aggregations").columns).collect()), key=repr)
    assert sum(r[1] for r in rows("daily_aggregations")) == 4


def test_hot_day_is_split_when_written(spark):
    # The rebalance exchange lets AQE split one large day over several writers.
    df = spark.range(10).select(col("id"), F.lit(date(2024, 1, 1)).alias("source_date"))
    plan = df.hint("rebalance", "source_date")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
