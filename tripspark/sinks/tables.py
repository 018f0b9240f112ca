"""Creating, replacing and appending tables.

The same calls serve the built-in catalog and a configured v2 catalog such as Iceberg;
only the table name (``catalog.namespace.table``) and ``provider`` differ.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit
from pyspark.sql.types import StructType

from tripspark.sources.csv_text import write_csv

log = logging.getLogger(__name__)


def create_namespace(spark: SparkSession, name: str, required: bool = True) -> None:
    """Create a namespace if it is absent. With ``required=False`` a failure is only logged."""
    try:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")
    except PySparkException:
        if required:
            raise
        log.warning("namespace %s was not created; the table write may create it", name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    comment: str | None = None,
    partition_by: list[str] | None = None,
    provider: str = "parquet",
) -> None:
    """Create an empty table with NOT NULL columns and a comment where given."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in schema.fields
    )
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if comment:
        sql += f" COMMENT {_quote(comment)}"
    spark.sql(sql)


def _is_v2(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return catalog != "spark_catalog"


def refresh_table(df: DataFrame, name: str, provider: str = "parquet") -> None:
    """Replace the whole content and schema of a table, or create it."""
    if _is_v2(df.sparkSession, name):
        df.writeTo(name).using(provider).createOrReplace()
    else:
        df.write.mode("overwrite").format(provider).saveAsTable(name)


def _required(name: str, column: str) -> Column:
    problem = F.raise_error(lit(f"NULL in required column {column} of {name}"))
    return F.coalesce(col(column), problem).alias(column)


def append_rows(df: DataFrame, name: str, schema: StructType | None = None) -> None:
    """Append rows, matched to the table's columns by name.

    File tables of the built-in catalog record NOT NULL without enforcing it. With the
    ``schema`` the table was created from, the write fails on a NULL in such a column.
    """
    required = {f.name for f in schema.fields if not f.nullable} if schema else set()
    df.select(
        *[
            _required(name, c) if c in required else col(c)
            for c in df.sparkSession.table(name).columns
        ]
    ).write.insertInto(name)


def overwrite_partitions(
    df: DataFrame,
    name: str,
    partition_by: str,
    provider: str = "parquet",
    rebalance: bool = True,
    sort_by: str | Column | None = None,
    cluster: bool = False,
    observe: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Replace only the partitions present in ``df``, so a second run changes nothing.

    The rebalance step shuffles once and gives each partition value files near the advisory size:
    many small source files are merged and one very large day is split over several tasks. Rows
    sorted inside a file let a reader skip by the column's statistics. With ``cluster`` rows are
    dealt out by ranges of (partition, sort key) instead, so that the files of a large day hold
    different ranges too; the ranges cost a sampling pass over ``df``.

    ``observe`` is applied to the rows behind the shuffle, in the stage that writes them.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c.lower() != partition_by.lower()]
    ordered = df.select(*others, partition_by)
    create_table(spark, name, ordered.schema, partition_by=[partition_by], provider=provider)
    ordered = ordered.select(*spark.table(name).columns)

    def written(rows: DataFrame) -> DataFrame:
        if cluster and sort_by is not None:
            rows = rows.repartitionByRange(partition_by, sort_by)
        elif rebalance:
            rows = rows.hint("rebalance", partition_by)
        rows = observe(rows)
        return rows if sort_by is None else rows.sortWithinPartitions(partition_by, sort_by)

    if _is_v2(spark, name):
        written(ordered).writeTo(name).overwritePartitions()
        return
    _insert_partitions(ordered, name, written)


def _insert_partitions(
    df: DataFrame, name: str, written: Callable[[DataFrame], DataFrame]
) -> None:
    """Overwrite the partitions of a table of the built-in catalog that ``df`` has.

    Which partitions such a write replaces is a session setting, so the write runs in a session
    of its own with the caller's other settings; the caller's, and writes that run beside, see
    no change.
    """
    spark = df.sparkSession
    view = f"rows_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        session = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if session.conf.isModifiable(key):
                session.conf.set(key, value)
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
        rows = written(session.table(f"global_temp.{view}"))
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(name)


def write_bucketed(
    df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None
) -> None:
    """Replace a table that is divided by a hash of ``keys`` and sorted by them in each bucket.

    Tables with the same keys and number of buckets are joined, and grouped, without moving rows.
    One shuffle here gives each bucket one file.
    """
    writer = (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_days(spark: SparkSession, name: str, partition_by: str, days: Iterable[date]) -> None:
    """Remove whole days from a table partitioned by day."""
    days = [f"DATE'{day.isoformat()}'" for day in days]
    if not days:
        return
    if _is_v2(spark, name):
        spark.sql(f"DELETE FROM {name} WHERE {partition_by} IN ({', '.join(days)})")
        return
    parts = ", ".join(f"PARTITION ({partition_by} = {day})" for day in days)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    spark.catalog.refreshTable(name)


def overwrite_partition_files(df: DataFrame, path: str, partition_by: str) -> None:
    """The same for a folder of parquet files without a catalog entry."""
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path)


def export_rows(df: DataFrame, path: str, order_by: list[str]) -> None:
    """CSV with rows ordered within and across the part files."""
    export_csv(df.orderBy(*[col(c) for c in order_by]), path)
