"""Trips derived from order tables.

The supplied tables hold no trips, so each order line stands for one: the order date
and line give the times, supplier and customer nations the places, the prices the
amounts. All parameters below are fixed values of that mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit


# Minute of the day a trip starts.
START = "(l_orderkey * 7 + l_linenumber * 131) % 1440"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def day_span(df: DataFrame, ts: str, years: int = 0, days_after: int = 1) -> DataFrame:
    """One row (``first``, ``last``): the first day of a timestamp, ``years`` later, and the day
    ``days_after`` its last day, ``years`` earlier."""
    day = col(ts).cast("date")
    return df.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
        F.add_months("first", 12 * years).alias("first"),
        F.date_add(F.add_months("last", -12 * years), days_after).alias("last"),
    )


def _later(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips. The order lines are joined last to the orders, so the largest
    table meets its small lookup first and is moved while it is still narrow."""
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    pickup_places = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    dropoff_places = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    lines = lines.join(pickup_places, col("l_suppkey") == col("s_suppkey"))
    orders = orders.join(dropoff_places, col("o_custkey") == col("c_custkey"))
    rows = lines.join(orders, col("l_orderkey") == col("o_orderkey"))

    return rows.selectExpr(
        "1L AS VendorID",
        f"timestampadd(MINUTE, {START}, o_orderdate) AS tpep_pickup_datetime",
        f"""CASE WHEN l_partkey % 97 != 0
                 THEN timestampadd(MINUTE, {START} + l_partkey % 125 - 2, o_orderdate)
            END AS tpep_dropoff_datetime""",
        "CAST(l_linenumber AS DOUBLE) AS passenger_count",
        "l_quantity / 4 AS trip_distance",
        """CAST(CASE l_orderkey % 8 WHEN 7 THEN 99 WHEN 0 THEN 7 ELSE l_orderkey % 8 END
                AS DOUBLE) AS RatecodeID""",
        "'N' AS store_and_fwd_flag",
        "CAST(s_nationkey AS BIGINT) AS PULocationID",
        "CAST(c_nationkey AS BIGINT) AS DOLocationID",
        "CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS payment_type",
        "floor(l_extendedprice / 10) / 100 AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "floor(l_extendedprice * l_discount / 10) / 100 AS tip_amount",
        "0.0D AS tolls_amount",
        "1.0D AS improvement_surcharge",
        "floor(l_extendedprice * (1 + l_tax + l_discount) / 10) / 100 AS total_amount",
        "2.5D AS congestion_surcharge",
        "CASE WHEN l_linenumber = 1 THEN 1.75D ELSE 0.0D END AS Airport_fee",
        "year(o_orderdate) AS year",
        "month(o_orderdate) AS month",
        "day(o_orderdate) AS day",
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs; the first region holds the airports."""
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    return nation.join(region, col("n_regionkey") == col("r_regionkey")).select(
        col("n_nationkey").alias("LocationID"),
        col("r_name").alias("Borough"),
        col("n_name").alias("Zone"),
        F.when(col("n_regionkey") == 0, "Airports").otherwise("Boro Zone").alias("service_zone"),
    )


def conversation_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(conversations, chats) from the turns of ``conversations``.

    A chat is a user turn with the assistant turn that follows it, if any. Turns are
    paired on (conversation, turn), so a very long conversation spreads over all tasks.
    Conversations that open with a system turn belong to team 1002, others to 1001.
    """
    turns = read(spark, sf_dir, "conversations")
    base = F.to_timestamp_ntz(lit("2024-10-08 12:00:00"))
    conversations = turns.groupBy("conv_id").agg(
        F.max(F.when(col("role") == "system", 1).otherwise(0)).alias("has_system"),
        F.count(lit(1)).alias("turns"),
    ).select(
        col("conv_id").alias("id"),
        (col("turns") + 100).alias("user_id"),
        (col("has_system") + 1001).alias("team_id"),
        _later(base, col("conv_id") * 15).alias("created_at"),
    )
    asked = turns.filter(col("role") == "user")
    answers = turns.filter(col("role") == "assistant").select(
        col("conv_id").alias("answer_conv"),
        (col("turn") - 1).alias("answers_turn"),
        col("text").alias("response"),
    )
    at = _later(base, col("conv_id") * 15 + col("turn"))
    chats = asked.join(
        answers,
        (col("conv_id") == col("answer_conv")) & (col("turn") == col("answers_turn")),
        "left",
    ).select(
        (col("conv_id") * 1_000_000_000 + col("turn")).alias("id"),
        col("conv_id").alias("conversation_id"),
        col("text").alias("user_request"),
        F.concat(lit("Explain: "), col("text")).alias("prompt"),
        "response",
        at.alias("created_at"),
        _later(at, lit(1)).alias("updated_at"),
    )
    return conversations, chats
