"""Helpers that several operators share: intermediate tables, batches, row identity."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.session import shared_dir

# White space as the contracts define it; bytes.split() and bytes.strip() use the same set.
SPACE = " \t\n\x0b\x0c\r"

# Text handled at once inside a task, in bytes. Bounds a worker's memory, not the data.
SLICE_BYTES = 2 << 20

# How long the driver waits at most until listeners have seen the events of finished jobs.
LISTENERS_MS = 5_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    """A folder name of its own in the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it from there.

    It is computed once, survives lost executors and cuts the lineage.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let go of the shuffles of finished jobs, which Spark keeps as long as the driver holds their
    plans. So do events that wait for a listener, and the last one that each listener saw."""
    gc.collect()
    spark.sql("SET spark.sql.shuffle.partitions")  # whose events become the last ones
    try:
        spark._jsc.sc().listenerBus().waitUntilEmpty(LISTENERS_MS)
    except Py4JJavaError:  # a slow listener: these shuffles go the next time
        pass
    spark._jvm.System.gc()


def dropped(*tables: DataFrame) -> None:
    """Delete intermediate tables that nothing reads any more, and let go of the shuffles of the
    jobs that wrote them."""
    for table in tables:
        spark = table.sparkSession
        for folder in {os.path.dirname(name) for name in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    for spark in {t.sparkSession for t in tables}:
        released(spark)


def text_hash(text: str | Column) -> Column:
    """Tells rows with the same id apart. A NULL text counts as an empty one."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the table does not have yet, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about SLICE_BYTES of one text column, a row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(values).to_pylist()):
            size += n or 0
            if size >= SLICE_BYTES:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; NULL as an empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [t or b"" for t in values.to_pylist()]


def rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of the given schema from lists, numpy or Arrow arrays."""
    arrays = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
