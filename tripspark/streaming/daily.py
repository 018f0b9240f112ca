"""Incremental bronze to silver: load the days whose files are new since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import col
from pyspark.sql.streaming import StreamingQuery

from tripspark.plans.silver import write_days
from tripspark.sources import bronze


def days_in(batch: DataFrame) -> list:
    """The distinct bronze days of a batch; at most one per file of the batch."""
    return [
        row[0]
        for row in batch.select(bronze.source_date().alias("d")).distinct().collect()
    ]


def reload_days(
    spark: SparkSession,
    root: str,
    table: str,
    days: list,
    offset_years: int,
    provider: str = "parquet",
) -> None:
    """Rebuild whole days from all their files; a day that cannot be read stops the stream.

    A batch may hold only some files of a day, and replacing a partition with a part of
    it would lose the rest, so the day is read again in full.
    """
    files: dict = {}
    for day in sorted(days):
        files |= bronze.day_files(spark, root, day, day)
    _, failed = write_days(spark, root, table, files, offset_years, provider)
    if failed:
        raise RuntimeError(f"days that could not be loaded: {failed}")


def load_new_files(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    offset_years: int = 1,
    provider: str = "parquet",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process every file that arrived since the last run, then stop.

    Files come in batches of at most ``files_per_batch``, so a first run over all of history is
    many bounded loads. The checkpoint remembers the files; the partition overwrite makes a
    repeated batch harmless, so a run that dies half way can simply be started again.
    """
    stream = (
        spark.readStream.schema(bronze.BRONZE_DAY)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(root)
        .select(*[col(f.name) for f in bronze.BRONZE_PARTITIONS.fields])
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        days = days_in(batch)
        if days:
            reload_days(spark, root, table, days, offset_years, provider)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
