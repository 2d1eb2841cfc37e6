"""Tool and solver logs, and ASCII surface geometry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.operators.order import BLOCK, blocked_row_number, carry_forward
from gridloom.sources.lines import read_lines

FLOAT = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"

# The line forms that the tools print.
CENTRE_LINE = r"(?i)set centre of rotation to"
BOUNDS_LINE = r"(?i)bounding box|overall bounds"
TIME_LINE = r"^\s*Time = (\S+)"
SOLVE_LINE = (
    rf"Solving for ([^,\s]+), Initial residual = ({FLOAT}), "
    rf"Final residual = ({FLOAT}), No Iterations (\d+)"
)
CONTINUITY_LINE = (
    rf"continuity errors : sum local = ({FLOAT}), global = ({FLOAT}), cumulative = ({FLOAT})"
)
CONVERGED_LINE = r"solution converged in (\d+) iterations"


def _last_numbers(line: Column, n: int) -> Column:
    """The last n blank-separated words of a line as doubles, brackets dropped."""
    words = F.filter(F.split(F.regexp_replace(line, r"[()]", ""), r"\s+"), lambda w: w != "")
    tail = F.slice(words, -n, n)
    return F.when(F.size(words) >= n, F.transform(tail, lambda w: w.try_cast("double")))


def parse_tool_log(lines: DataFrame) -> DataFrame:
    """Rotation centre and bounds per log; NULL when a log has no such line."""

    def first_match(pattern: str, n: int, name: str) -> Column:
        hit = F.col("line").rlike(pattern)
        return _last_numbers(
            F.min_by(F.when(hit, F.col("line")), F.when(hit, F.col("line_no"))), n
        ).alias(name)

    return lines.groupBy("path").agg(
        first_match(CENTRE_LINE, 3, "centre"), first_match(BOUNDS_LINE, 6, "bounds")
    )


def parse_solver_log(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """(path, line_no, kind, time, …) of a solver log.

    ``kind`` is residual, continuity or converged. Every row carries the time
    of the last ``Time =`` line before it; ``solve_no`` counts the solves of one
    field within one time step.
    """
    line = F.col("line")

    def pick(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))

    tagged = lines.select(
        "path",
        "line_no",
        pick(TIME_LINE, 1).alias("_time"),
        pick(SOLVE_LINE, 1).alias("field"),
        pick(SOLVE_LINE, 2).cast("double").alias("initial_residual"),
        pick(SOLVE_LINE, 3).cast("double").alias("final_residual"),
        pick(SOLVE_LINE, 4).cast("int").alias("iterations"),
        pick(CONTINUITY_LINE, 1).cast("double").alias("sum_local"),
        pick(CONTINUITY_LINE, 2).cast("double").alias("global_error"),
        pick(CONTINUITY_LINE, 3).cast("double").alias("cumulative"),
        pick(CONVERGED_LINE, 1).cast("int").alias("converged_in"),
    ).filter("coalesce(_time, field) is not null or sum_local is not null or converged_in is not null")
    timed = carry_forward(tagged, ["path"], "line_no", "_time", "time_name", block)
    kind = (
        F.when(F.col("field").isNotNull(), F.lit("residual"))
        .when(F.col("sum_local").isNotNull(), F.lit("continuity"))
        .otherwise(F.lit("converged"))
    )
    rows = timed.filter("field is not null or sum_local is not null or converged_in is not null")
    rows = rows.withColumn("kind", kind).withColumn("time", F.col("time_name").try_cast("double"))
    return _solve_numbers(rows, block).drop("_time")


def _solve_numbers(rows: DataFrame, block: int) -> DataFrame:
    keyed = rows.withColumn("_field", F.coalesce("field", F.lit(""))).withColumn(
        "_step", F.coalesce("time_name", F.lit(""))
    )
    numbered = blocked_row_number(
        keyed,
        ["path", "kind", "_step", "_field"],
        ["line_no"],
        F.floor(F.col("line_no") / block),
        "solve_no",
    )
    return numbered.drop("_field", "_step")


def read_solver_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_solver_log(read_lines(spark, paths))


def parse_stl(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """facet(surface, facet_id, vertex_no, x, y, z) of ASCII surfaces, one file each."""
    pattern = rf"^\s*vertex\s+({FLOAT})\s+({FLOAT})\s+({FLOAT})\s*$"
    vertices = lines.filter(F.col("line").rlike(pattern)).select(
        "path",
        "line_no",
        F.regexp_replace("file_name", r"(?i)\.stl$", "").alias("surface"),
        *[F.regexp_extract("line", pattern, i + 1).cast("double").alias(a) for i, a in enumerate("xyz")],
    )
    ranked = blocked_row_number(
        vertices, ["path"], ["line_no"], F.floor(F.col("line_no") / block), "_n"
    )
    return ranked.select(
        "path",
        "surface",
        F.floor((F.col("_n") - 1) / 3).alias("facet_id"),
        ((F.col("_n") - 1) % 3).cast("int").alias("vertex_no"),
        "x",
        "y",
        "z",
    )


def read_stl(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_stl(read_lines(spark, paths))
