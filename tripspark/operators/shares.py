"""Share of a total, over already grouped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col
from pyspark.sql.types import DoubleType

from tripspark.operators.exact import exact_total


def percentage(part: Column, whole: Column) -> Column:
    """Percentage rounded to two places; NULL when the whole is zero."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def with_share(grouped: DataFrame, value: str, out: str) -> DataFrame:
    """Add each group's percentage of the sum of ``value`` over all groups.

    The window has no keys, so it runs in one task. Call it on aggregated rows only. A total of
    doubles is the exact one, whatever the order of the groups.
    """
    everything = Window.partitionBy()
    if not isinstance(grouped.schema[value].dataType, DoubleType):
        total = F.sum(col(value)).over(everything)
        return grouped.withColumn(out, percentage(col(value), total))
    listed = grouped.withColumn("_all", F.collect_list(col(value)).over(everything))
    return listed.withColumn(out, percentage(col(value), exact_total("_all"))).drop("_all")
