"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit


def _finite(value: Column) -> Column:
    """False for NULL as well as for what has no place on a line."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), lit(False))


def not_in_bins(df: DataFrame, column: str) -> DataFrame:
    """One row: how many values are NULL, NaN or infinite."""
    value = col(column).cast("double")
    return df.agg(
        F.count_if(value.isNull()).alias("nulls"),
        F.count_if(F.isnan(value)).alias("nans"),
        F.count_if(F.abs(value) == float("inf")).alias("infinite"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal steps between the smallest and the largest value.

    The maximum belongs to the last bin and empty bins are listed with zero. NULL, NaN and
    infinite values are in no bin; ``not_in_bins`` counts them. The range is a scalar subquery
    and the bins one aggregate: both read a single column and send a handful of rows per task
    to the shuffle, whatever the number of distinct values.
    """
    values = df.select(col(column).cast("double").alias("value")).filter(_finite(col("value")))
    span = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    step = F.floor(F.try_divide((col("value") - lo) * bins, hi - lo))
    # One bin holds everything when all values are equal.
    bin_ = F.least(F.coalesce(step, lit(0)), lit(bins - 1))
    filled = values.groupBy(bin_.alias("bin")).agg(F.count(lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(col("id").alias("bin"))
    return (
        edges.join(filled, "bin", "left")
        .select(
            "bin",
            (lo + (hi - lo) * col("bin") / bins).alias("bin_start"),
            (lo + (hi - lo) * (col("bin") + 1) / bins).alias("bin_end"),
            F.coalesce(col("n"), lit(0)).alias("trip_count"),
        )
        .orderBy("bin")
    )
