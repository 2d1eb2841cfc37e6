"""Stage summaries (one layout per stage), state files and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.operators.doe import union_all
from gridloom.operators.order import small_table
from gridloom.sources.lines import read_lines
from gridloom.sources.one_file import write_one_file

# Columns of each summary, its file, and what counts as success.
STAGE_COLUMNS = {
    "setup": (
        "csv_file", "row_number", "case_id", "case_name", "wd", "ws", "ws_for_setup",
        "case_dir", "status", "message",
    ),
    "mesh": ("csv_file", "row_number", "case_id", "case_name", "case_dir", "status", "message"),
    "flow": ("csv_file", "row_number", "case_id", "case_name", "case_dir", "status", "message"),
    "transport": (
        "csv_file", "row_number", "case_id", "flow_case_transport_case", "transport_case_dir",
        "status", "message",
    ),
    "post-processing": ("case_id", "case_dir", "status", "message"),
    "wall-distance": ("case_name", "case_dir", "target_time", "status", "message"),
}
STAGE_FILES = {
    "setup": "setup_cases_summary.csv",
    "mesh": "run_mesh_cases_summary.csv",
    "flow": "run_flow_cases_summary.csv",
    "transport": "run_transport_cases_summary.csv",
    "post-processing": "run_post_processing_cases_summary.csv",
}
STAGES = (
    (1, "setup", ["created", "dry_run"]),
    (2, "mesh", ["meshed", "continued"]),
    (3, "flow", ["solved", "continued"]),
    (4, "transport", ["solved", "continued"]),
    (5, "post-processing", ["completed"]),
)
RESULT_COLUMNS = (
    "csv_file", "row_number", "case_id", "case_name", "case_dir", "status", "message",
    "wd", "ws", "ws_for_setup", "target_time",
)
MANIFEST_COLUMNS = (
    "case_id", "row_number", "input_vtu", "output_vtu", "input_pt", "output_pt",
    "input_vti", "output_vti", "status", "message",
)


def stage_dim(spark: SparkSession) -> DataFrame:
    return small_table(spark, STAGES, "stage_ordinal int, stage string, success array<string>")


def read_summary(spark: SparkSession, paths: str | Sequence[str], stage: str) -> DataFrame:
    """One stage's summaries in the common schema; absent columns are NULL."""
    columns = STAGE_COLUMNS[stage]
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("enforceSchema", True)
        .schema(", ".join(f"`{c}` string" for c in columns))
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    renamed = raw.withColumnsRenamed(
        {"flow_case_transport_case": "case_name", "transport_case_dir": "case_dir"}
    )
    out = [F.lit(stage).alias("stage"), F.col("_metadata.file_path").alias("source")]
    for c in RESULT_COLUMNS:
        out.append(F.col(c) if c in renamed.columns else F.lit(None).cast("string").alias(c))
    return renamed.select(*out)


def read_stage_results(spark: SparkSession, root: str, stages: Sequence[str] | None = None) -> DataFrame:
    """Union of the stage summaries below ``root/batch_<id>/``."""
    found = [
        read_summary(spark, f"{root}/batch_*/{STAGE_FILES[s]}*", s)
        for s in (stages or list(STAGE_FILES))
    ]
    batch = F.regexp_extract("source", r"/batch_([^/]+)/", 1)
    return union_all(found).withColumn("batch_id", batch)


def write_stage_results(df: DataFrame, stage: str, path: str) -> None:
    """Every field quoted, inner quotes doubled, newlines kept; NULL becomes ''."""
    names = {"flow_case_transport_case": "case_name", "transport_case_dir": "case_dir"}
    fields = []
    for c in STAGE_COLUMNS[stage]:
        source = c if c in df.columns else names.get(c, c)
        value = F.col(source).cast("string") if source in df.columns else F.lit("")
        fields.append(F.coalesce(value, F.lit("")).alias(c))
    (
        df.select(*fields)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def quote_field(c: Column) -> Column:
    """One CSV field as the summaries write it."""
    return F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def write_manifest(df: DataFrame, path: str) -> None:
    """The manifest as one sorted CSV file, ``manifest.csv`` in ``path``, that many tasks write."""
    cells = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in MANIFEST_COLUMNS])
    ordered = cells.orderBy(F.col("row_number").try_cast("bigint"), "case_id")
    lines = ordered.select(F.to_csv(F.struct(*MANIFEST_COLUMNS), {"escape": '"'}).alias("line"))
    write_one_file(lines, path, "manifest.csv", ",".join(MANIFEST_COLUMNS))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'int' if c == 'row_number' else 'string'}" for c in MANIFEST_COLUMNS)
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def parse_key_values(lines: DataFrame) -> DataFrame:
    """(path, key, value) of ``key=value`` lines, split at the first ``=``."""
    pattern = r"(?s)^([^=]*)=(.*)$"
    return lines.filter(F.col("line").rlike(pattern)).select(
        "path",
        F.regexp_extract("line", pattern, 1).alias("key"),
        F.regexp_replace(F.regexp_extract("line", pattern, 2), "\r$", "").alias("value"),
    )


def pivot_key_values(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file with the given keys as columns; NULL when a key is absent."""
    return pairs.groupBy("path").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys]
    )


def read_kv(spark: SparkSession, paths: str | Sequence[str], keys: Sequence[str]) -> DataFrame:
    return pivot_key_values(parse_key_values(read_lines(spark, paths)), keys)


STATE_SCHEMA = "case_name string, stage string, message string, updated string, log string"


def read_state(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pipe-delimited state records."""
    return (
        spark.read.option("sep", "|")
        .option("quote", "")
        .schema(STATE_SCHEMA)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
