"""What a run over batch tables and a workspace would do, and its report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.operators import cases, inventory, report
from gridloom.sources.batch_csv import case_columns, read_batches
from gridloom.sources.workspace import read_workspace

MODES = {
    "mesh": inventory.mesh_mode,
    "flow": inventory.flow_mode,
    "transport": inventory.transport_mode,
}


def load_cases(spark: SparkSession, csv_paths: str | Sequence[str]) -> DataFrame:
    """batch_id, file_ord, row_number and the raw case, speed and direction cells."""
    return case_columns(read_batches(spark, csv_paths))


def plan_stage(rows: DataFrame, inv: DataFrame, stage: str, root: str, force: bool = False) -> DataFrame:
    """Per row: skipped or failed with its message, or the mode in which it runs."""
    judged = cases.classify_rows(rows, inventory.case_dirs(inv), stage, root)
    if stage not in MODES:
        return judged.withColumn("mode", F.lit(None).cast("string"))
    modes = MODES[stage](inventory.case_state(inv), force)
    joined = judged.join(modes, ["batch_id", "case_id"], "left")
    return joined.withColumn("mode", F.when(F.col("status").isNull(), F.col("mode")))


@dataclass
class RunReport:
    stages: DataFrame
    failures: DataFrame
    totals: DataFrame


def report_run(
    plan: DataFrame, batches: DataFrame, stages: DataFrame, results: DataFrame, selected: Sequence[str]
) -> RunReport:
    ran = stages.select("batch_id", "stage")
    shown = results.join(ran, ["batch_id", "stage"], "left_semi").filter(F.col("stage").isin(*selected))
    return RunReport(
        report.run_report(plan, batches, stages, results, selected),
        report.failed_rows(shown),
        report.run_totals(plan, batches),
    )


def report_status(spark: SparkSession, csv_paths: str | Sequence[str], root: str) -> DataFrame:
    """Case folder and stage markers of every named case of the batch tables."""
    rows = load_cases(spark, csv_paths).filter("raw_case <> ''")
    named = rows.select("batch_id", cases.case_id("raw_case").alias("case_id")).filter("case_id <> 'NA'")
    return inventory.status_report(named, inventory.parse_inventory(read_workspace(spark, root)))
