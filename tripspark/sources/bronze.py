"""Bronze trip files: parquet under year=Y/month=M/day=D/ with unpadded month and day."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit
from pyspark.sql.types import StructType

from tripspark.schemas import BRONZE_PARTITIONS, BRONZE_TRIP

BRONZE_DAY = StructType(BRONZE_TRIP.fields + BRONZE_PARTITIONS.fields)
DAY_FOLDER = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/([^/]+)$")


def source_date():
    """Date of the bronze directory. The load date is this one, never the pickup date."""
    return F.make_date(col("year"), col("month"), col("day"))


def _months(first: date, last: date) -> Iterable[tuple[int, int, list[int]]]:
    """(year, month, days) of a range of days."""
    days: dict[tuple[int, int], list[int]] = {}
    for n in range((last - first).days + 1):
        day = first + timedelta(days=n)
        days.setdefault((day.year, day.month), []).append(day.day)
    return [(y, m, found) for (y, m), found in days.items()]


def day_files(
    spark: SparkSession, root: str, first: date | None = None, last: date | None = None
) -> dict[date, list[str]]:
    """The files of each day that has any, by name; no file is opened.

    With bounds only the folders of these days are listed, not the whole root.
    """
    root = root.rstrip("/")
    folders = [root]
    if first is not None and last is not None:
        folders = [
            f"{root}/year={y}/month={m}/day={{{','.join(map(str, days))}}}"
            for y, m, days in _months(first, last)
        ]
    found: dict[date, list[str]] = {}
    for folder in folders:
        listed = spark.read.schema(BRONZE_DAY).option("basePath", root)
        try:
            paths = listed.option("pathGlobFilter", "*.parquet").parquet(folder).inputFiles()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND" or folder == root:
                raise
            continue
        for path in paths:
            if match := DAY_FOLDER.search(path):
                day = date(*map(int, match.groups()[:3]))
                if (first is None or day >= first) and (last is None or day <= last):
                    found.setdefault(day, []).append(path)
    return {day: sorted(paths) for day, paths in sorted(found.items())}


def _same_schema(spark: SparkSession, root: str, paths: list[str]) -> list[tuple]:
    """(schema, paths) of groups whose files agree on their column types.

    Footers are read and compared by one distributed job; only where it finds types that
    differ are the paths halved.
    """
    try:
        reader = spark.read.option("mergeSchema", "true").option("basePath", root)
        return [(reader.parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError):
        if len(paths) == 1:
            raise
    half = len(paths) // 2
    return _same_schema(spark, root, paths[:half]) + _same_schema(spark, root, paths[half:])


def _typed(df: DataFrame) -> list:
    """The bronze columns in their types, whatever types a file has; missing ones are NULL."""
    there = {f.name.lower() for f in df.schema.fields}
    return [
        (col(f.name) if f.name.lower() in there else lit(None)).try_cast(f.dataType).alias(f.name)
        for f in BRONZE_DAY.fields
    ]


def read_days(
    spark: SparkSession, root: str, files: dict[date, list[str]], lineage: bool = True
) -> DataFrame:
    """Trips of the given days and files, each file read with its own types and cast.

    ``lineage`` adds the file each trip came from, its number among the day's files and the row
    position in it. Values that do not fit a type become NULL; unreadable files raise.
    """
    root = root.rstrip("/")
    paths = [path for some in files.values() for path in some]
    if not paths:
        empty = spark.createDataFrame([], BRONZE_DAY)
        if lineage:
            empty = empty.selectExpr(
                "*", "'' AS source_file", "0 AS file_number", "0L AS source_row"
            )
        return empty
    parts = []
    for schema, some in _same_schema(spark, root, paths):
        df = spark.read.schema(schema).option("basePath", root).parquet(*some)
        extra = []
        if lineage:
            extra = [
                col("_metadata.file_name").alias("source_file"),
                col("_metadata.row_index").alias("source_row"),
            ]
        parts.append(df.select(*_typed(df), *extra))
    trips = parts[0]
    for part in parts[1:]:
        trips = trips.unionByName(part)
    if not lineage:
        return trips
    numbers = spark.createDataFrame(
        [
            (day.year, day.month, day.day, unquote(path.rsplit("/", 1)[-1]), number)
            for day, some in files.items()
            for number, path in enumerate(some)
        ],
        "year int, month int, day int, source_file string, file_number int",
    )
    return trips.join(numbers, ["year", "month", "day", "source_file"], "left").select(
        *[f.name for f in BRONZE_DAY.fields], "source_file", "file_number", "source_row"
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    first: date | None = None,
    last: date | None = None,
    lineage: bool = True,
) -> DataFrame:
    """Trips of the days ``first`` to ``last``, both included. A day without a folder gives no
    rows."""
    return read_days(spark, root, day_files(spark, root, first, last), lineage)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file or directory with the schema of its footer."""
    return spark.read.parquet(path)


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Add where each row was read from: source label, file path and file size."""
    return df.select(
        "*",
        lit(source).alias("source"),
        col("_metadata.file_path").alias("original_path"),
        col("_metadata.file_size").alias("file_size"),
    )
