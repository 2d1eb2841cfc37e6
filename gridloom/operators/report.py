"""Roll-ups of stage results: counts, totals, failures, progress and active cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.functions.cells import first_absolute_path
from gridloom.sources.stage_csv import STAGES, stage_dim


def clean(c: Column) -> Column:
    """Report form of a field: quotes dropped, blanks trimmed."""
    return F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), '"', ""), r"^\s+|\s+$", "")


def stage_counts(results: DataFrame) -> DataFrame:
    """total, succeeded, skipped, failed and other per batch and stage.

    ``results``: batch_id, stage, status. One pass with partial aggregation.
    """
    dim = stage_dim(results.sparkSession)
    status = clean(F.col("status"))
    ok = F.array_contains("success", status)
    return (
        results.join(dim, "stage")
        .groupBy("batch_id", "stage_ordinal", "stage")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(ok).alias("succeeded"),
            F.count_if(~ok & (status == "skipped")).alias("skipped"),
            F.count_if(~ok & (status == "failed")).alias("failed"),
            F.count_if(~ok & ~status.isin("skipped", "failed")).alias("other"),
        )
    )


def failed_rows(results: DataFrame) -> DataFrame:
    """Failed result rows with the log path that their message names.

    The report order is (batch_id, stage_ordinal, row_number, case_id).
    """
    dim = stage_dim(results.sparkSession).drop("success")
    row = F.when(F.col("row_number").cast("string").rlike(r"^\d+$"), F.col("row_number")).try_cast("bigint")
    return results.filter(clean(F.col("status")) == "failed").join(dim, "stage").select(
        "batch_id",
        "stage_ordinal",
        "stage",
        F.coalesce(row, F.lit(0)).alias("row_number"),
        F.coalesce(F.nullif(clean(F.col("case_id")), F.lit("")), F.lit("unavailable")).alias("case_id"),
        first_absolute_path(clean(F.col("message"))).alias("log_path"),
    )


def in_report_order(failures: DataFrame) -> DataFrame:
    return failures.orderBy("batch_id", "stage_ordinal", "row_number", "case_id")


def run_report(
    plan: DataFrame, batches: DataFrame, stages: DataFrame, results: DataFrame, selected: Sequence[str]
) -> DataFrame:
    """One row per attempted batch and selected stage, in canonical stage order.

    ``plan``: ordinal, batch_id. ``batches``: batch_id, batch_result (only
    batches that started). ``stages``: batch_id, stage, stage_result. A stage
    that did not run never shows counts, even if an old summary exists.
    """
    wanted = F.array(
        *[
            F.struct(F.lit(o).alias("stage_ordinal"), F.lit(s).alias("stage"))
            for o, s, _ in STAGES
            if s in selected
        ]
    )
    started = plan.join(batches, "batch_id")
    grid = started.select("ordinal", "batch_id", "batch_result", F.inline(wanted))
    counts = stage_counts(results).drop("stage_ordinal")
    joined = grid.join(stages, ["batch_id", "stage"], "left").join(counts, ["batch_id", "stage"], "left")
    shown = F.col("stage_result").isNotNull() & F.col("total").isNotNull()

    def text(c: str) -> Column:
        return F.when(shown, F.col(c).cast("string")).otherwise(F.lit("unknown")).alias(c)

    return joined.select(
        "ordinal",
        "batch_id",
        "batch_result",
        "stage_ordinal",
        "stage",
        F.coalesce("stage_result", F.lit("not_attempted")).alias("stage_result"),
        F.when(shown, F.lit("available")).otherwise(F.lit("unavailable")).alias("summary"),
        *[text(c) for c in ("total", "succeeded", "skipped", "failed", "other")],
    )


def run_totals(plan: DataFrame, batches: DataFrame) -> DataFrame:
    """requested, attempted, succeeded, failed and not_started batches."""
    joined = plan.select("batch_id").join(batches.select("batch_id", "batch_result"), "batch_id", "left")
    result = F.col("batch_result")
    return joined.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(result.isNotNull()).alias("attempted"),
        F.count_if(result == "succeeded").alias("succeeded"),
        F.count_if(result.isNotNull() & (result != "succeeded")).alias("failed"),
        F.count_if(result.isNull()).alias("not_started"),
    )


def stage_order(stages: Sequence[str]) -> list[str]:
    """Requested stages in canonical order, each once."""
    known = [s for _, s, _ in STAGES]
    unknown = [s for s in stages if s not in known]
    if unknown:
        raise ValueError(f"unknown stages {unknown}")
    return [s for s in known if s in stages]


def progress_counters(status: Column) -> list[Column]:
    """The counters that all stage progress lines are made of."""
    counters = [F.count(F.lit(1)).alias("processed")]
    for s in ("created", "dry_run", "meshed", "solved", "continued", "completed", "skipped", "failed"):
        counters.append(F.count_if(status == s).alias(s))
    return counters


def progress(results: DataFrame, totals: DataFrame) -> DataFrame:
    """Progress per batch and stage.

    ``totals``: batch_id, stage, total, running, started. Pending cases are
    total - done - running for the mesh stage and total - started for the
    transport stage, never below zero.
    """
    counts = results.groupBy("batch_id", "stage").agg(*progress_counters(clean(F.col("status"))))
    joined = totals.join(counts, ["batch_id", "stage"], "left")

    def n(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    stage = F.col("stage")
    done = (
        F.when(stage == "mesh", n("meshed") + n("continued") + n("skipped") + n("failed"))
        .when(stage == "flow", n("solved") + n("continued") + n("failed"))
        .otherwise(n("processed"))
    )
    pending = F.when(
        stage == "mesh", F.greatest(F.lit(0), F.col("total") - done - F.col("running"))
    ).when(stage == "transport", F.greatest(F.lit(0), F.col("total") - F.col("started")))
    names = [c for c in counts.columns if c not in ("batch_id", "stage")]
    return joined.select(
        "batch_id", "stage", "total", "running", "started",
        *[n(c).alias(c) for c in names], done.alias("done"), pending.alias("pending"),
    )


def total_cases(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct named cases (all stages but setup) and non-blank rows (setup)."""
    return rows.groupBy(*by).agg(
        F.count_distinct(F.when(F.col("raw_case") != "", F.col("case_id"))).alias("cases"),
        F.count(F.lit(1)).alias("rows"),
    )


def latest_state(events: DataFrame, keys: Sequence[str] = ("batch_id", "case_name")) -> DataFrame:
    """Latest event per case by time, then stage and message."""
    rest = [c for c in events.columns if c not in keys]
    order = ["updated", *[c for c in rest if c != "updated"]]
    return events.groupBy(*keys).agg(
        F.max(F.struct(*order)).alias("_s")
    ).select(*keys, *[F.col(f"_s.{c}").alias(c) for c in rest])


def active_cases(
    events: DataFrame, finished: Sequence[str], k: int, by: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """The first k active cases per batch, and how many more there are.

    Rank limits run before the shuffle, so a hot batch sends k rows per task.
    """
    latest = latest_state(events, [*by, "case_name"]).filter(~F.col("stage").isin(*finished))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("case_name"))
    shown = latest.withColumn("rank", rank).filter(F.col("rank") <= k)
    counts = latest.groupBy(*by).agg(
        F.greatest(F.count(F.lit(1)) - k, F.lit(0)).cast("bigint").alias("more")
    )
    return shown.join(counts, list(by))
