"""Reconciling the files of two folders, from their listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit


def _relative(root: str) -> Column:
    """Path below ``root``. Listed paths carry a scheme, so the root is searched for."""
    tail = root.split("://", 1)[-1].rstrip("/") + "/"
    at = F.locate(tail, col("path"))
    below = F.substring(col("path"), at + len(tail), F.length(col("path")))
    return F.when(at > 0, below).otherwise(col("path"))


def manifest(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(rel_path, length) of every matching file below ``root``; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(_relative(root).alias("rel_path"), "length")


def target_keys(files: DataFrame, prefix: str) -> DataFrame:
    """Add the object key each file gets below ``prefix``."""
    return files.withColumn("key", F.concat(lit(prefix.rstrip("/") + "/"), col("rel_path")))


def new_files(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source files that the target does not have."""
    return source.join(target.select("rel_path"), "rel_path", "left_anti")


def validate(source: DataFrame, target: DataFrame) -> DataFrame:
    """Status of every source file: ``ok``, ``missing`` or ``size_mismatch``."""
    there = target.select("rel_path", col("length").alias("target_length"))
    status = (
        F.when(col("target_length").isNull(), "missing")
        .when(col("length") != col("target_length"), "size_mismatch")
        .otherwise("ok")
    )
    return source.join(there, "rel_path", "left").withColumn("status", status)


# Ranges of the names' hashes that two listings are compared by. Bounds what is broadcast.
RANGES = 1 << 14


def _range(ranges: int) -> Column:
    return F.pmod(F.xxhash64("rel_path"), lit(ranges))


def differing_ranges(source: DataFrame, target: DataFrame, ranges: int = RANGES) -> DataFrame:
    """(range): where two listings are not the same (rel_path, length) rows, ``ranges`` rows at most.

    A listing is added up per range where it is read, so a shuffle gets a row per range and task
    whatever the number of files.
    """

    def digests(listing: DataFrame, name: str) -> DataFrame:
        entry = F.xxhash64("rel_path", "length")
        other = F.xxhash64("length", "rel_path")
        return listing.groupBy(_range(ranges).alias("range")).agg(
            F.struct(F.count(lit(1)), F.bit_xor(entry), F.bit_xor(other)).alias(name)
        )

    both = digests(source, "here").join(digests(target, "there"), "range", "full_outer")
    return both.filter(~col("here").eqNullSafe(col("there"))).select("range")


def _in_differing(
    source: DataFrame, target: DataFrame, ranges: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source and target rows of the ranges that differ, and the other source rows."""
    differing = F.broadcast(differing_ranges(source, target, ranges))

    def rows(listing: DataFrame, how: str) -> DataFrame:
        ranged = listing.withColumn("range", _range(ranges))
        return ranged.join(differing, "range", how).drop("range")

    return rows(source, "left_semi"), rows(target, "left_semi"), rows(source, "left_anti")


def new_files_by_ranges(source: DataFrame, target: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``new_files`` of very long listings: only ranges that differ are joined."""
    here, there, _ = _in_differing(source, target, ranges)
    return new_files(here, there)


def validate_by_ranges(source: DataFrame, target: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``validate`` of very long listings of distinct names: only ranges that differ are joined,
    so the shuffle grows with the differences."""
    here, there, same = _in_differing(source, target, ranges)
    checked = validate(here, there)
    fine = same.withColumns({"target_length": col("length"), "status": lit("ok")})
    return checked.unionByName(fine)


def verdict(validated: DataFrame) -> DataFrame:
    """One row: number of bad files, and whether there are none."""
    bad = F.count_if(col("status") != "ok")
    return validated.agg(bad.alias("errors"), (bad == 0).alias("valid"))


def load_stats(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files and bytes to load, and files to skip because the target has them."""
    there = target.select("rel_path", lit(True).alias("there"))
    return (
        source.join(there, "rel_path", "left")
        .withColumn("status", F.when(col("there"), "skipped").otherwise("new"))
        .groupBy("status")
        .agg(F.count(lit(1)).alias("files"), F.sum("length").alias("total_size_bytes"))
    )


def content_hashes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """MD5 of every file. One task reads one file; files over 2 GB raise."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(_relative(root).alias("rel_path"), F.md5(col("content")).alias("md5"))


def hashes(objects: DataFrame, content: str) -> DataFrame:
    """MD5 of every object of a table with its content in a column."""
    return objects.select("rel_path", F.md5(col(content).cast("binary")).alias("md5"))


def is_empty(files: DataFrame) -> bool:
    """Whether there is nothing to load."""
    return files.isEmpty()
