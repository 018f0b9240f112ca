"""Sample datasets next to the trips: chats, the order star and raw-file counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.operators.filters import by_team
from tripspark.sinks import tables as sink
from tripspark.sources.csv_text import read_csv_strings
from tripspark.sources.order_lines import read


def federated_chats(conversations: DataFrame, chats: DataFrame) -> DataFrame:
    """Chats of all conversations. The two sides may come from different catalogs."""
    c, ch = conversations.alias("c"), chats.alias("ch")
    return (
        c.join(ch, col("c.id") == col("ch.conversation_id"))
        .select(
            col("c.id").alias("conversation_id"),
            "c.user_id",
            "c.team_id",
            col("ch.id").alias("chat_id"),
            "ch.user_request",
            "ch.prompt",
            "ch.response",
            col("ch.created_at").alias("chat_created_at"),
            col("ch.updated_at").alias("chat_updated_at"),
        )
        .orderBy("chat_created_at")
    )


def conversation_chats(conversations: DataFrame, chats: DataFrame, team_id: int) -> DataFrame:
    """Chats of one team, oldest first."""
    return federated_chats(by_team(conversations, team_id), chats)


def order_star(spark, sf_dir: str) -> DataFrame:
    """Order lines with order, supplier, part, customer and nation, all inner joins.

    The lines meet suppliers and parts first, while they are narrow, and the orders
    with their customers last.
    """
    lines = (
        read(spark, sf_dir, "lineitem")
        .join(read(spark, sf_dir, "supplier"), col("l_suppkey") == col("s_suppkey"))
        .join(read(spark, sf_dir, "part"), col("l_partkey") == col("p_partkey"))
    )
    nation = read(spark, sf_dir, "nation")
    customers = read(spark, sf_dir, "customer").join(
        nation, col("c_nationkey") == col("n_nationkey")
    )
    orders = read(spark, sf_dir, "orders").join(customers, col("o_custkey") == col("c_custkey"))
    return lines.join(orders, col("l_orderkey") == col("o_orderkey")).select(
        col("l_orderkey").alias("orderkey"),
        col("l_partkey").alias("partkey"),
        col("l_suppkey").alias("suppkey"),
        col("l_linenumber").alias("linenumber"),
        col("l_quantity").alias("quantity"),
        col("l_extendedprice").alias("extendedprice"),
        col("l_discount").alias("discount"),
        col("l_tax").alias("tax"),
        col("l_returnflag").alias("returnflag"),
        col("l_linestatus").alias("linestatus"),
        col("l_shipdate").alias("shipdate"),
        col("o_custkey").alias("custkey"),
        col("o_orderstatus").alias("orderstatus"),
        col("o_totalprice").alias("totalprice"),
        col("o_orderdate").alias("orderdate"),
        col("o_orderpriority").alias("orderpriority"),
        col("s_name").alias("supplier_name"),
        col("s_acctbal").alias("supplier_acctbal"),
        col("p_name").alias("part_name"),
        col("p_brand").alias("brand"),
        col("p_type").alias("type"),
        col("p_size").alias("size"),
        col("p_retailprice").alias("retailprice"),
        col("c_name").alias("customer_name"),
        col("c_acctbal").alias("customer_acctbal"),
        col("c_mktsegment").alias("mktsegment"),
        col("n_name").alias("country"),
        col("n_regionkey").alias("regionkey"),
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count()


def union_count(first: DataFrame, second: DataFrame) -> DataFrame:
    """Number of rows of two inputs appended by position."""
    return first.union(second).agg(F.count("*").alias("n"))


def plus_columns(df: DataFrame, column: str) -> DataFrame:
    return df.select(
        col(column).alias("id"),
        (col(column) + 10).alias("plus_10"),
        (col(column) + 20).alias("plus_20"),
    )


def number_range(spark, n: int = 1_000_000) -> DataFrame:
    return plus_columns(spark.range(n), "id")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which a condition holds, and all others, NULL included."""
    holds = F.coalesce(condition, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def csv_roundtrip(df: DataFrame, folder: str) -> DataFrame:
    """Write a table as CSV, load the CSV as text into a second table and read it back."""
    spark = df.sparkSession
    sink.export_csv(df, f"{folder}/csv")
    texts = read_csv_strings(spark, f"{folder}/csv")
    texts.write.mode("overwrite").parquet(f"{folder}/table")
    return spark.read.schema(texts.schema).parquet(f"{folder}/table")
