"""Bronze to silver: the fact projection, the daily load and the dimension build."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit

from tripspark.functions import timekeys as tk
from tripspark.functions.quality import add_quality_checks
from tripspark.operators.clustering import z_order
from tripspark.operators.star import Calendar, Star
from tripspark.schemas import BRONZE_TRIP, FACT_TRIP, check_schema
from tripspark.sinks import tables as sink
from tripspark.sources import bronze, dimensions

log = logging.getLogger(__name__)


# Bits of a trip id: the day, the file among the day's files, the row in the file.
FILE_BITS, ROW_BITS = 15, 32


def trip_id(df: DataFrame):
    """A row id that stays the same when a day is loaded again.

    It is the day of the bronze folder, the number of the file in it and the row's position in the
    file, side by side, so no two rows share one. Days since 1970 fit until 2149; a day with more
    files or a file with more rows than there are bits for raises. Rows that come
    from no file get a hash of all bronze columns, which equal rows share.
    """
    if "file_number" not in df.columns:
        return F.xxhash64(*[col(f.name) for f in BRONZE_TRIP.fields if f.name in df.columns])
    day = F.unix_date(bronze.source_date()).cast("long")
    fits = (col("file_number") < 1 << FILE_BITS) & (col("source_row") < 1 << ROW_BITS)
    parts = F.shiftleft(day, FILE_BITS + ROW_BITS).bitwiseOR(
        F.shiftleft(col("file_number").cast("long"), ROW_BITS)
    ).bitwiseOR(col("source_row"))
    problem = F.raise_error(lit("a day has too many files, or a file too many rows, for trip ids"))
    return F.when(fits, parts).otherwise(problem)


def transform_trips(df: DataFrame, offset_years: int = 1) -> DataFrame:
    """Bronze trips as fact rows, plus ``source_date``, the partition they load into.

    year, month and day are the bronze date moved forward by the offset. 29 February
    moves to 28 February, which is why the bronze date is the partition column.
    """
    flagged = add_quality_checks(df).withColumn("source_date", bronze.source_date())
    target = f"add_months(source_date, {12 * offset_years})"
    fact = flagged.select(
        trip_id(df).alias("TripID"),
        tk.minute_key("tpep_pickup_datetime").alias("PickupDateTimeID"),
        tk.minute_key("tpep_dropoff_datetime").alias("DropOffDateTimeID"),
        *_exprs(
            "try_cast(PULocationID AS INT) AS PULocationID",
            "try_cast(DOLocationID AS INT) AS DOLocationID",
            "try_cast(RatecodeID AS INT) AS RateCodeID",
            "try_cast(payment_type AS INT) AS PaymentTypeID",
            "try_cast(passenger_count AS INT) AS PassengerCount",
            "CAST(trip_distance AS DOUBLE) AS TripDistance",
            "CAST(fare_amount AS DOUBLE) AS FareAmount",
            "CAST(tip_amount AS DOUBLE) AS TipAmount",
            "CAST(tolls_amount AS DOUBLE) AS TollsAmount",
            "CAST(Airport_fee AS DOUBLE) AS AirportAmount",
            "CAST(total_amount AS DOUBLE) AS TotalAmount",
            "CAST(extra AS DOUBLE) AS Extra",
            "CAST(mta_tax AS DOUBLE) AS MTATax",
            "CAST(congestion_surcharge AS DOUBLE) AS CongestionSurcharge",
            "quality_issue",
            f"year({target}) AS year",
            f"month({target}) AS month",
            f"day({target}) AS day",
            "source_date",
        ),
    )
    return check_schema(fact, FACT_TRIP)


def _exprs(*sql: str) -> list[Column]:
    return [F.expr(e) for e in sql]


def plain_projection(df: DataFrame) -> DataFrame:
    """The earlier fact shape: renamed columns, minute keys, no casts and no flag."""
    return df.select(
        trip_id(df).alias("TripID"),
        tk.minute_key("tpep_pickup_datetime").alias("PickupDateTimeID"),
        tk.minute_key("tpep_dropoff_datetime").alias("DropOffDateTimeID"),
        *_exprs(
            "PULocationID",
            "DOLocationID",
            "RatecodeID AS RateCodeID",
            "payment_type AS PaymentTypeID",
            "passenger_count AS PassengerCount",
            "trip_distance AS TripDistance",
            "fare_amount AS FareAmount",
            "tip_amount AS TipAmount",
            "tolls_amount AS TollsAmount",
            "Airport_fee AS AirportAmount",
            "total_amount AS TotalAmount",
            "extra AS Extra",
            "mta_tax AS MTATax",
            "congestion_surcharge AS CongestionSurcharge",
        ),
    )


@dataclass(frozen=True)
class LoadDays:
    """Target days to load; their data is read from ``offset_years`` earlier."""

    start: date
    end: date
    offset_years: int = 1


def load_days(
    start: date | None = None, end: date | None = None, offset_years: int = 1
) -> LoadDays:
    """Defaults: yesterday, for a single day. An offset of zero is allowed."""
    start = start or date.today() - timedelta(days=1)
    return LoadDays(start, end or start, offset_years)


def _bounds(spark: SparkSession, days: LoadDays) -> DataFrame:
    """One row (first, last): the source days of the two bounds.

    28 February also takes the 29th of the source year, which no target day maps to and
    which a load of one day at a time would never read.
    """
    months = -12 * days.offset_years
    last = F.greatest(
        F.add_months(lit(days.end), months),
        F.date_sub(F.add_months(lit(days.end + timedelta(days=1)), months), 1),
    )
    return spark.range(1).select(
        F.add_months(lit(days.start), months).alias("first"), last.alias("last")
    )


def date_plan(bounds: DataFrame) -> DataFrame:
    """One row per source day between the bounds; none if they are the wrong way round."""
    return bounds.filter(col("first") <= col("last")).select(
        F.explode(F.sequence("first", "last")).alias("source_date")
    )


def source_bounds(spark: SparkSession, days: LoadDays) -> tuple[date, date]:
    """First and last source day."""
    row = _bounds(spark, days).first()
    return row["first"], row["last"]


def load_outcome(counts: DataFrame, bounds: DataFrame, offset_years: int = 1) -> DataFrame:
    """Every planned day with its number of rows; a day without any has failed."""
    rows = F.coalesce(col("rows"), lit(0))
    return date_plan(bounds).join(counts, "source_date", "left").select(
        "source_date",
        F.add_months("source_date", 12 * offset_years).alias("target_date"),
        rows.alias("rows"),
        (rows > 0).alias("success"),
    )


def rows_per_day(trips: DataFrame) -> DataFrame:
    """(source_date, rows) of trips with the directory columns."""
    counts = trips.groupBy("year", "month", "day").agg(F.count(lit(1)).alias("rows"))
    return counts.select(bronze.source_date().alias("source_date"), "rows")


def all_failed(outcome: DataFrame) -> bool:
    """The job fails only if there were days to load and none of them succeeded."""
    row = outcome.agg(
        F.count(lit(1)).alias("days"), F.count_if(col("success")).alias("ok")
    ).first()
    return row["days"] > 0 and row["ok"] == 0


# Days of one write. Each has two numbers counted beside it.
DAYS_AT_ONCE = 62
LEDGER = "source_date date, rows long, digest long"


def _counted(days: list[date]) -> tuple[Observation, Callable[[DataFrame], DataFrame]]:
    """What counts the rows of every day and their digest as they are written.

    The digest is the exclusive or of the rows' hashes: equal for equal rows in any order.
    """
    counts = Observation()

    def observe(rows: DataFrame) -> DataFrame:
        digest = F.xxhash64(*rows.columns)
        metrics = []
        for i, day in enumerate(days):
            here = col("source_date") == lit(day)
            metrics += [
                F.count_if(here).alias(f"rows_{i}"),
                F.bit_xor(F.when(here, digest)).alias(f"digest_{i}"),
            ]
        return rows.observe(counts, *metrics)

    return counts, observe


def write_days(
    spark: SparkSession,
    root: str,
    table: str,
    files: dict[date, list[str]],
    offset_years: int = 1,
    provider: str = "parquet",
    cluster: bool = False,
) -> tuple[dict[date, tuple[int, int]], dict[date, str]]:
    """Write whole days; returns the rows and digest of those written, counted in the write
    itself, and what went wrong on those that could not be.

    Up to ``DAYS_AT_ONCE`` days are one scan and one write. Only if that fails are they halved, so
    that a file which cannot be read costs its own day and no other.
    """
    days = list(files)
    if not days:
        return {}, {}
    problem = None
    if len(days) <= DAYS_AT_ONCE:
        counts, observe = _counted(days)
        try:
            fact = transform_trips(bronze.read_days(spark, root, files), offset_years)
            sink.overwrite_partitions(
                fact,
                table,
                "source_date",
                provider,
                sort_by=place_and_time() if cluster else "PickupDateTimeID",
                cluster=cluster,
                observe=observe,
            )
            found = counts.get
            return {
                day: (found[f"rows_{i}"], found[f"digest_{i}"]) for i, day in enumerate(days)
            }, {}
        except (PySparkException, Py4JJavaError) as error:
            problem = str(error)[:500]
    if len(days) == 1:
        return {}, {days[0]: problem}
    written: dict[date, tuple[int, int]] = {}
    failed: dict[date, str] = {}
    for some in (days[: len(days) // 2], days[len(days) // 2 :]):
        part = {day: files[day] for day in some}
        done, wrong = write_days(spark, root, table, part, offset_years, provider, cluster)
        written |= done
        failed |= wrong
    return written, failed


def place_and_time() -> Column:
    """Z-order of the pickup place and the minute of the day.

    Rows near in both are near in the order, so the statistics of a run of rows are narrow
    in both. Places above 511 share a cell with lower ones, which costs skipping only.
    """
    key = col("PickupDateTimeID")
    minute = F.expr("PickupDateTimeID % 10000 div 100 * 60 + PickupDateTimeID % 100")
    slot = F.coalesce(F.when(key.isNotNull(), minute * 512 / 1440), lit(0))
    return z_order([F.pmod(F.coalesce("PULocationID", lit(0)), lit(512)), slot], 9)


def _note(spark: SparkSession, table: str, rows: list[tuple], provider: str) -> None:
    """Put days into the ledger of a table, in place of what it says of them."""
    if rows:
        ledger = spark.createDataFrame(rows, LEDGER).coalesce(1)
        sink.overwrite_partitions(
            ledger, f"{table}_ledger", "source_date", provider, rebalance=False
        )


def load_facts(
    spark: SparkSession,
    bronze_root: str,
    table: str,
    days: LoadDays,
    provider: str = "parquet",
    cluster: bool = False,
) -> DataFrame:
    """Load a range of days; returns the outcome per day.

    Days are replaced as whole partitions, so loading one twice does not duplicate it. The outcome
    counts the rows as they are written; the table is not read again. A day that could not be
    read counts as failed, whatever an earlier load left of it.

    The table ``<table>_ledger`` holds rows and digest of every day. While a day is being written
    its digest is NULL there, so that a load which dies half way is seen as a change.
    """
    first, last = source_bounds(spark, days)
    files = bronze.day_files(spark, bronze_root, first, last) if first <= last else {}
    _note(spark, table, [(day, None, None) for day in files], provider)
    written, failed = write_days(
        spark, bronze_root, table, files, days.offset_years, provider, cluster
    )
    for day, problem in failed.items():
        log.warning("%s was not loaded: %s", day, problem)
    # A day whose files hold no rows replaces nothing, so what is there of it is not known.
    _note(spark, table, [(d, n, digest) for d, (n, digest) in written.items() if n], provider)
    counts = spark.createDataFrame(
        [(day, n) for day, (n, _) in written.items()], "source_date date, rows long"
    )
    return load_outcome(counts, _bounds(spark, days), days.offset_years)


def delete_days(
    spark: SparkSession, table: str, days: list[date], provider: str = "parquet"
) -> None:
    """Remove loaded days, in the ledger too."""
    sink.drop_days(spark, table, "source_date", days)
    _note(spark, table, [(day, 0, 0) for day in days], provider)


def build_dimensions(
    spark: SparkSession,
    zones_path: str,
    namespace: str,
    first: date,
    last: date,
    provider: str = "parquet",
) -> dict[str, DataFrame]:
    """Rebuild the four dimension tables and return them. The minutes run from midnight of
    ``first`` to midnight of ``last``."""
    sink.create_namespace(spark, namespace)
    frames = {
        "dimlocation": dimensions.dimlocation(spark, zones_path),
        "dimpayment": dimensions.dimpayment(spark),
        "dimratecode": dimensions.dimratecode(spark),
        "dimtime": dimensions.dimtime(spark, first, last),
    }
    for name, df in frames.items():
        sink.refresh_table(df, f"{namespace}.{name}", provider)
    return {name: spark.table(f"{namespace}.{name}") for name in frames}


MINUTE_KEYS = ["minute", "slot"]


def write_by_minute(
    star: Star,
    fact_table: str,
    minute_table: str,
    buckets: int,
    slots: int = 8,
    hot: int | None = None,
    folder: str | None = None,
) -> None:
    """Store good trips and the minute dimension bucketed and sorted by minute.

    A busy minute would make one bucket large, so the trips of a minute with over ``hot`` of them, by
    default a quarter of a bucket's share, are dealt out to ``slots`` by their id. The dimension
    has a row for every slot of such a minute; there are four per bucket at most.
    """
    trips = star.good().select(
        col("PickupDateTimeID").alias("minute"), "TripID", "FareAmount", "TotalAmount"
    )
    if hot is None:
        hot = max(1000, trips.count() // (4 * buckets))
    busy = trips.groupBy("minute").agg(F.count(lit(1)).alias("n")).filter(col("n") > hot)
    busy = F.broadcast(busy.select("minute", lit(True).alias("is_busy")))
    slot = F.pmod(F.xxhash64("TripID"), lit(slots)).cast("int")
    dealt = trips.join(busy, "minute", "left").select(
        "minute",
        F.when(col("is_busy"), slot).otherwise(0).alias("slot"),
        "FareAmount",
        "TotalAmount",
    )
    last = F.when(col("is_busy"), slots - 1).otherwise(0)
    minutes = (
        star.dimtime.select(col("timeid").alias("minute"), col("Date").alias("trip_date"))
        .join(busy, "minute", "left")
        .select("minute", F.explode(F.sequence(lit(0), last)).alias("slot"), "trip_date")
    )
    for df, table in ((dealt, fact_table), (minutes, minute_table)):
        path = None if folder is None else f"{folder}/{table}"
        sink.write_bucketed(df, table, MINUTE_KEYS, buckets, path)


def star_from_tables(spark: SparkSession, namespace: str) -> Star:
    """The star over written silver tables. Its calendar is what ``dimtime`` holds."""
    fact, location, payment, rate, times = (
        spark.table(f"{namespace}.{name}")
        for name in ("fact_trip", "dimlocation", "dimpayment", "dimratecode", "dimtime")
    )
    return Star(
        spark, check_schema(fact, FACT_TRIP), location, payment, rate, times, Calendar.of(times)
    )
