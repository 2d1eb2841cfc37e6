"""File inventories, documents and decoded field tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.session import cut_lineage

NORM_SCHEMA = (
    "frozen boolean, channels map<string, struct<method string, mean double, std double, "
    "median double, scale double, min double, max double, output_range array<double>, epsilon double>>"
)


FILE_SCHEMA = "path string, length bigint, mtime timestamp, is_dir boolean"


def _list_folders():
    """List the folders of each batch of rows, one level deep."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["path"]:
                files, inner = fs.FileSystem.from_uri(folder)
                scheme = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
                found = [
                    (scheme + info.path, info.size or 0, info.mtime, info.type == fs.FileType.Directory)
                    for info in files.get_file_info(fs.FileSelector(inner))
                ]
                yield pd.DataFrame(found, columns=["path", "length", "mtime", "is_dir"])

    return run


def read_workspace(
    spark: SparkSession, roots: str | Sequence[str], splits: int | None = None, max_depth: int = 64
) -> DataFrame:
    """All files below the roots as (path, length, mtime). Contents are not read.

    Stage markers are empty files, which a Spark file scan leaves out, so the
    folders are listed by tasks. One job lists one level of all trees and deals
    the folders that it finds out anew, so a case that is deep or wide is spread
    over tasks like any other; only folder names are shuffled. Trees deeper
    than ``max_depth`` (a link to a folder above) are an error.
    """
    names = [roots] if isinstance(roots, str) else list(roots)
    splits = splits or spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(r.rstrip("/"),) for r in names], "path string")
    found = None
    for _ in range(max_depth):
        listed = cut_lineage(folders.repartition(splits, "path").mapInPandas(_list_folders(), FILE_SCHEMA))
        files = listed.filter(~F.col("is_dir"))
        found = files if found is None else found.unionByName(files)
        folders = listed.filter("is_dir").select("path")
        if folders.isEmpty():
            return found.select("path", "length", "mtime")
    raise ValueError(f"folders more than {max_depth} levels deep")


def read_scenarios(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One flat JSON object per file: (path, params map). Other documents fail."""
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    params = F.from_json("value", "map<string,string>")
    checked = F.when(params.isNotNull() & F.ltrim("value").startswith("{"), params).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("path")))
    )
    return raw.select(F.col("_metadata.file_path").alias("path"), "value").select(
        "path", checked.alias("params")
    )


def read_statistics(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Frozen statistics documents as ``norm_stat`` rows; a text that is no object with channels is an error."""
    raw = spark.read.option("wholetext", True).text(paths if isinstance(paths, str) else list(paths))
    raw = raw.select(F.col("_metadata.file_path").alias("path"), "value")
    whole = F.ltrim("value").startswith("{") & F.rtrim("value").endswith("}")
    read = F.from_json("value", NORM_SCHEMA)
    bad = F.raise_error(F.concat(F.lit("not a statistics document: "), F.col("path")))
    docs = raw.select("path", F.when(whole & read["channels"].isNotNull(), read).otherwise(bad).alias("d")).select("path", "d.*")
    return docs.select("path", "frozen", F.explode("channels").alias("channel", "s")).select(
        "path",
        F.coalesce("frozen", F.lit(False)).alias("frozen"),
        "channel",
        F.lower(F.coalesce("s.method", F.lit("identity"))).alias("method"),
        *[F.col(f"s.{c}").alias(c) for c in ("mean", "std", "median", "scale", "min", "max")],
        F.get("s.output_range", F.lit(0)).alias("out_lo"),
        F.get("s.output_range", F.lit(1)).alias("out_hi"),
        F.col("s.epsilon").alias("epsilon"),
    )


FIELD_TABLES = ("source_block", "source_cell", "source_point", "source_value")


def read_fields(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The decoded field tables of a campaign, one Parquet folder each."""
    return {t: spark.read.parquet(f"{root}/{t}") for t in FIELD_TABLES}


def write_fields(tables: dict[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_samples(df: DataFrame, path: str) -> None:
    """Sample tensors, one folder per sample so that a reader prunes to its samples."""
    (
        df.repartition("sample_id")
        .write.mode("overwrite")
        .partitionBy("sample_id")
        .parquet(path)
    )


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Tensors of ``chunk_tensors``, one folder per sample; a sample's channels are written by several tasks.

    Rows lie by role, channel and chunk, so that the row groups of a file cover few channels and layers each.
    """
    (
        chunks.repartition("sample_id", "role", "channel")
        .sortWithinPartitions("sample_id", "role", "ordinal", "chunk")
        .write.mode("overwrite")
        .partitionBy("sample_id")
        .parquet(path)
    )


def read_chunks(
    spark: SparkSession, path: str, channels: Sequence[str] | None = None, z: tuple[int, int] | None = None
) -> DataFrame:
    """Chunks as they were written, or those of some channels and of the layers from ``z[0]`` up to ``z[1]``, exclusive.

    The tests of channel and layers reach the scan. Chunks that reach beyond
    ``z`` are cut: ``z0``, ``z1``, ``shape`` and ``data`` tell the part that is left.
    """
    found = spark.read.option("basePath", path).parquet(path)
    if channels is not None:
        found = found.where(F.col("channel").isin(*channels))
    if z is None:
        return found
    lo, hi = F.greatest("z0", F.lit(int(z[0]))), F.least("z1", F.lit(int(z[1])))
    layer = F.get("shape", F.lit(1)) * F.get("shape", F.lit(2))
    inside = found.where((F.col("z0") < int(z[1])) & (F.col("z1") > int(z[0])) & F.lit(int(z[0]) < int(z[1])))
    part = F.slice("data", (lo - F.col("z0")) * layer + 1, (hi - lo) * layer)
    cut = F.array(hi - lo, F.get("shape", F.lit(1)), F.get("shape", F.lit(2)))
    new = {"data": part, "shape": cut, "z0": lo, "z1": hi}
    return inside.select(*[new[c].alias(c) if c in new else F.col(c) for c in inside.columns])
