"""Text files as numbered lines, without reading a file whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_splits(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """(path, file_name, _start, _id, line): ``_id`` grows within a split, ``_start`` with the splits of a file."""
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """(path, file_name, line_no, line), line_no = 1-based physical line of the file.

    Files stay splittable: a line is numbered inside its split, and the lines of
    the splits before it are added. Only the line feed ends a line.
    """
    raw = read_splits(spark, paths, recursive)
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        raw.groupBy("path", "_start")
        .agg(F.count(F.lit(1)).alias("_lines"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
        .drop("_lines")
    )
    return raw.join(splits, ["path", "_start"]).select(
        "path",
        "file_name",
        (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"),
        "line",
    )
