"""Hand-made bronze trips."""

from datetime import datetime

from tripspark.schemas import BRONZE_TRIP
from tripspark.sources.bronze import BRONZE_DAY

# Two published sample rows and one in the shape of the published unit test.
DEFAULTS = {
    "VendorID": 2,
    "tpep_pickup_datetime": datetime(2024, 1, 1, 8, 0),
    "tpep_dropoff_datetime": datetime(2024, 1, 1, 8, 30),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 2,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 13.3,
    "congestion_surcharge": 2.5,
    "Airport_fee": 1.25,
}


def trip(day=(2024, 1, 1), **changes):
    row = {**DEFAULTS, **changes}
    return tuple(row[f.name] for f in BRONZE_TRIP.fields) + tuple(day)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_DAY)


def write_bronze(spark, rows, root):
    bronze(spark, rows).write.mode("append").partitionBy("year", "month", "day").parquet(root)
