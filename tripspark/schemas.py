"""Explicit schemas of every stored table, and a check to run on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# Column names and types of the public trip record files.
BRONZE_TRIP = _struct(
    VendorID=LongType(),
    tpep_pickup_datetime=TimestampNTZType(),
    tpep_dropoff_datetime=TimestampNTZType(),
    passenger_count=DoubleType(),
    trip_distance=DoubleType(),
    RatecodeID=DoubleType(),
    store_and_fwd_flag=StringType(),
    PULocationID=LongType(),
    DOLocationID=LongType(),
    payment_type=LongType(),
    fare_amount=DoubleType(),
    extra=DoubleType(),
    mta_tax=DoubleType(),
    tip_amount=DoubleType(),
    tolls_amount=DoubleType(),
    improvement_surcharge=DoubleType(),
    total_amount=DoubleType(),
    congestion_surcharge=DoubleType(),
    Airport_fee=DoubleType(),
)

# Hive-style directory columns of the bronze layer (unpadded month and day).
BRONZE_PARTITIONS = _struct(year=IntegerType(), month=IntegerType(), day=IntegerType())

FACT_TRIP = _struct(
    TripID=LongType(),
    PickupDateTimeID=LongType(),
    DropOffDateTimeID=LongType(),
    PULocationID=IntegerType(),
    DOLocationID=IntegerType(),
    RateCodeID=IntegerType(),
    PaymentTypeID=IntegerType(),
    PassengerCount=IntegerType(),
    TripDistance=DoubleType(),
    FareAmount=DoubleType(),
    TipAmount=DoubleType(),
    TollsAmount=DoubleType(),
    AirportAmount=DoubleType(),
    TotalAmount=DoubleType(),
    Extra=DoubleType(),
    MTATax=DoubleType(),
    CongestionSurcharge=DoubleType(),
    quality_issue=StringType(),
    year=IntegerType(),
    month=IntegerType(),
    day=IntegerType(),
)

DIMLOCATION = _struct(
    LocationID=IntegerType(),
    Borough=StringType(),
    Zone=StringType(),
    service_zone=StringType(),
)

DIMPAYMENT = _struct(paymenttypeid=LongType(), paymenttype=StringType())

DIMRATECODE = _struct(ratecodeid=IntegerType(), ratedescription=StringType())

DIMTIME = _struct(
    timeid=LongType(),
    Date=DateType(),
    dayofmonth=IntegerType(),
    weekofyear=IntegerType(),
    month=ShortType(),
    year=ShortType(),
    hour=ShortType(),
    minute=ShortType(),
    second=ShortType(),
)

CONVERSATIONS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("user_id", IntegerType(), nullable=False),
        StructField("team_id", IntegerType(), nullable=False),
        StructField("created_at", TimestampType()),
    ]
)

CHATS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("conversation_id", IntegerType(), nullable=False),
        StructField("user_request", StringType(), nullable=False),
        StructField("prompt", StringType(), nullable=False),
        StructField("response", StringType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)


def check_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise if a column is missing or has another type."""
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        found = actual.get(field.name.lower())
        if found is None:
            problems.append(f"{field.name} is missing")
        elif found != field.dataType:
            problems.append(
                f"{field.name} is {found.simpleString()}, expected {field.dataType.simpleString()}"
            )
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df
