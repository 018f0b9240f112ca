"""Silver tables as views, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql.functions import col

from tripspark.operators.star import Star


def register_views(star: Star) -> None:
    """Create temporary views fact_trip, dimlocation, dimpayment, dimratecode and dimtime.

    Dimensions also carry the second names some published queries use for a column.
    """
    star.fact.createOrReplaceTempView("fact_trip")
    star.dimlocation.withColumn("servicezone", col("service_zone")).createOrReplaceTempView(
        "dimlocation"
    )
    star.dimpayment.createOrReplaceTempView("dimpayment")
    star.dimratecode.withColumn("ratecode", col("ratedescription")).createOrReplaceTempView(
        "dimratecode"
    )
    star.dimtime.createOrReplaceTempView("dimtime")
