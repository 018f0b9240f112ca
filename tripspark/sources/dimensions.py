"""The four dimensions: zones from CSV, two literal lists and the minute calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit
from pyspark.sql.types import StructType

from tripspark.functions import timekeys as tk
from tripspark.schemas import DIMLOCATION, DIMPAYMENT, DIMRATECODE

# Payment codes of the public trip records.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (0, "Voided trip"),
]

# Rate codes of the public trip records.
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (7, "Not recorded"),
    (99, "Unknown or other"),
]

MINUTES_PER_DAY = 1440


def dimlocation(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV. ``N/A`` and ``Unknown`` stay the strings they are."""
    return spark.read.schema(DIMLOCATION).csv(path, header=True)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A relation of (number, text) literals held in the plan.

    Its size is known to the optimizer, unlike that of rows shipped from Python, so joins
    to it are broadcast without measuring anything first.
    """
    columns = ", ".join(
        f"CAST(c{i} AS {f.dataType.simpleString()}) AS {f.name}"
        for i, f in enumerate(schema.fields)
    )
    values = ", ".join(f"({number}, '{text}')" for number, text in rows)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t(c0, c1)")


def dimpayment(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, PAYMENT_TYPES, DIMPAYMENT)


def dimratecode(spark: SparkSession) -> DataFrame:
    """Rate codes with an integer key, the type of the fact column that joins to it."""
    return literal_rows(spark, RATE_CODES, DIMRATECODE)


def dimtime(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per minute from midnight of ``start`` to midnight of ``end``, both included.

    The grid comes from ``spark.range``, so it is generated in parallel and the plan
    holds two numbers instead of a literal array with millions of entries.
    """
    minutes = (end - start).days * MINUTES_PER_DAY + 1
    grid = spark.range(minutes).select(
        F.date_add(lit(start), tk.int_div(col("id"), MINUTES_PER_DAY).cast("int")).alias("Date"),
        (col("id") % MINUTES_PER_DAY).alias("minute_of_day"),
    )
    return _minute_rows(grid)


def dimtime_between(bounds: DataFrame) -> DataFrame:
    """The same grid for one row (``first``, ``last``) of dates that a query works out itself.

    Days are spread over tasks before each becomes its minutes.
    """
    days = bounds.select("last", F.explode(F.sequence("first", "last")).alias("Date"))
    last_minute = F.when(col("Date") == col("last"), 0).otherwise(MINUTES_PER_DAY - 1)
    return _minute_rows(
        days.repartition("Date").select(
            "Date", F.explode(F.sequence(lit(0), last_minute)).alias("minute_of_day")
        )
    )


def _minute_rows(grid: DataFrame) -> DataFrame:
    day, minute = col("Date"), col("minute_of_day")
    hour = tk.int_div(minute, 60)
    return grid.select(
        (
            F.year(day).cast("long") * 100_000_000
            + F.month(day) * 1_000_000
            + F.dayofmonth(day) * 10_000
            + hour * 100
            + minute % 60
        ).alias("timeid"),
        day,
        F.dayofmonth(day).alias("dayofmonth"),
        tk.week_of_year(day).alias("weekofyear"),
        F.month(day).cast("smallint").alias("month"),
        F.year(day).cast("smallint").alias("year"),
        hour.cast("smallint").alias("hour"),
        (minute % 60).cast("smallint").alias("minute"),
        lit(0).cast("smallint").alias("second"),
    )
