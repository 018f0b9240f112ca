"""Catalog tables, listings and relational sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import lit
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's in which counts, minima and maxima of parquet files come from
    their footers: the aggregation is pushed into the scan, which opens no column."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    others = [f for f in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if f]
    session.conf.set(
        "spark.sql.sources.useV1SourceList", ",".join(f for f in others if f != "parquet")
    )
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def inventory(spark: SparkSession, tables: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Rows of parquet tables, and the least and greatest value of a column of whole numbers.

    ``tables`` has a path and a column, or None, by name. Nothing but footers is read. Columns
    whose footers may hold no or shortened statistics (text, timestamps) are not for this.
    """
    session = footer_session(spark)

    def row(name: str, path: str, column: str | None) -> DataFrame:
        rows = session.read.parquet(path)
        counts = [F.count(lit(1)).alias("row_count")]
        if column is not None:
            counts += [F.min(column).alias("least"), F.max(column).alias("greatest")]
        found = rows.agg(*counts)
        ends = ["least", "greatest"] if column is not None else [lit(None), lit(None)]
        return found.select(
            lit(name).alias("table_name"),
            # No footers, no count. As a count is never NULL to Spark, coalesce() would be left out.
            F.greatest("row_count", lit(0)).alias("row_count"),
            *[
                (found[e] if column is not None else e).cast("long").alias(n)
                for e, n in zip(ends, ("least", "greatest"), strict=True)
            ],
        )

    rows = [row(name, path, column) for name, (path, column) in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of a relational database, read in parallel slices of a numeric column.

    The bounds only set the slice width; rows outside them are read as well.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )
