"""The quality flag of a trip row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOOD = "good"
CORRUPTED = "corrupted"


def is_corrupted() -> Column:
    """A time or a location is missing, or the trip ends before it starts.

    Every term is never NULL, so a filter on the flag becomes a plain conjunction that
    Catalyst can push to the side of a join, or to the scan, that each term belongs to.
    """
    return F.expr(
        "tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL "
        "OR coalesce(tpep_pickup_datetime > tpep_dropoff_datetime, false) "
        "OR PULocationID IS NULL OR DOLocationID IS NULL"
    )


def add_quality_checks(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_issue", F.when(is_corrupted(), CORRUPTED).otherwise(GOOD))
