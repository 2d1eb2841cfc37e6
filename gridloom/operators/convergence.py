"""Judging a flow run by its log, and the mean speed of its result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from gridloom.functions.statistics import is_finite
from gridloom.operators.order import small_table

# Residual limits of the steady solver.
RESIDUAL_LIMITS = {
    "Ux": 1e-4, "Uy": 1e-4, "Uz": 1e-4, "p": 1e-4, "k": 1e-4, "omega": 1e-4, "epsilon": 1e-4,
}


def last_residuals(log: DataFrame) -> DataFrame:
    """Initial residual of every field and solve at the last time of its log.

    ``log``: rows of a parsed solver log.
    """
    residuals = log.filter("kind = 'residual' and time is not null")
    ends = residuals.groupBy("path").agg(F.max("time").alias("time"))
    return residuals.join(ends, ["path", "time"]).select(
        "path", "time", "field", "solve_no", "initial_residual", "final_residual", "iterations"
    )


def residual_audit(log: DataFrame, limits: Mapping[str, float] = RESIDUAL_LIMITS) -> DataFrame:
    """Last residuals against their limits; fields without a limit are left out."""
    dim = small_table(log.sparkSession, list(limits.items()), "field string, residual_limit double")
    return last_residuals(log).join(dim, "field").select(
        "path", "time", "field", "solve_no", "initial_residual", "residual_limit",
        (F.col("initial_residual") <= F.col("residual_limit")).alias("within"),
    )


def convergence(log: DataFrame, limits: Mapping[str, float] = RESIDUAL_LIMITS) -> DataFrame:
    """One row per log. A run has converged when a marker line says so and every
    last residual is within its limit; reaching the end time is not enough."""
    residuals = residual_audit(log, limits).groupBy("path").agg(
        F.max("time").alias("final_time"),
        F.count(F.lit(1)).alias("residuals"),
        F.count_if(~F.col("within")).alias("above_limit"),
        F.max("initial_residual").alias("worst_residual"),
    )
    other = log.groupBy("path").agg(
        F.count_if(F.col("kind") == "converged").alias("markers"),
        F.max_by(
            F.struct("sum_local", "global_error", "cumulative"),
            F.when(F.col("kind") == "continuity", F.col("line_no")),
        ).alias("_c"),
    )
    joined = other.join(residuals, "path", "left")
    good = (F.col("markers") > 0) & (F.coalesce("above_limit", F.lit(1)) == 0)
    return joined.select(
        "path", "final_time", "residuals", "above_limit", "worst_residual", "markers",
        F.col("_c.sum_local").alias("sum_local"),
        F.col("_c.global_error").alias("global_error"),
        F.col("_c.cumulative").alias("cumulative"),
        good.alias("converged"),
    )


def mean_speed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Volume-weighted mean speed; NULL unless volume is positive and the result finite.

    ``cells``: keys, time, volume, ux, uy, uz.
    """
    speed = F.sqrt(F.col("ux") * F.col("ux") + F.col("uy") * F.col("uy") + F.col("uz") * F.col("uz"))
    sums = cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"),
        F.max("time").alias("time"),
        F.sum("volume").alias("total_volume"),
        F.sum(F.col("volume") * speed).alias("_flux"),
    )
    mean = F.when(F.col("total_volume") > 0, F.col("_flux") / F.col("total_volume"))
    return sums.withColumn("_mean", mean).select(
        *keys, "cells", "time", "total_volume",
        F.when(is_finite(F.col("_mean")) & (F.col("_mean") >= 0), F.col("_mean")).alias("mean_speed"),
    )
