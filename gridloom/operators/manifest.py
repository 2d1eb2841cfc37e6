"""The manifest of input and output field files per case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.cells import pair_case_id
from gridloom.operators.inventory import discover_vtk, latest_vtu
from gridloom.operators.order import first_of_group
from gridloom.sources.stage_csv import MANIFEST_COLUMNS


def pair_samples(rows: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Pair every row of a batch table with its first and latest field file.

    ``rows``: row_number and raw_case. ``files``: path. Result: case_id,
    row_number, input_vtu, output_vtu and problem (NULL when the pair is whole).
    The first row of a case counts as seen even when its files are missing.
    """
    keyed = rows.select(
        "row_number",
        F.regexp_replace(F.coalesce("raw_case", F.lit("")), r"(?U)^\s+|\s+$", "").alias("raw_case"),
        pair_case_id("raw_case").alias("case_id"),
    )
    marked = first_of_group(keyed, ["case_id"], ["row_number"], "is_first")
    found = discover_vtk(keyed.filter("case_id is not null"), files, root)
    outputs = latest_vtu(files)
    paired = found.join(outputs, "vtk_dir", "left")
    joined = marked.join(paired, "case_id", "left")

    def message(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    case = F.col("case_id")
    problem = (
        F.when(case.isNull(), F.lit("Empty Case value"))
        .when(~F.col("is_first"), message("Duplicate case in CSV: ", case))
        .when(
            F.coalesce("n_dirs", F.lit(0)) == 0,
            message(
                "Cannot find flow_0.vtu for '", case, f"' below {root}. Supported layouts are '",
                case, "/vtk' and '", case, "/flow/vtk'.",
            ),
        )
        .when(
            F.col("n_dirs") > 1,
            message("Multiple VTK directories found for ", case, ": ", F.array_join("dirs", ", ")),
        )
        .when(F.col("output_vtu").isNull(), message("No flow_latest_#.vtu found in ", F.col("vtk_dir")))
    )
    return joined.withColumn("problem", problem).select(
        F.when(F.col("problem").isNull(), case)
        .otherwise(
            F.coalesce(
                F.nullif(F.col("raw_case"), F.lit("")),
                F.concat(F.lit("row_"), F.col("row_number").cast("string")),
            )
        )
        .alias("case_id"),
        "row_number",
        F.when(F.col("problem").isNull(), F.concat("vtk_dir", F.lit("/flow_0.vtu"))).alias("input_vtu"),
        F.when(F.col("problem").isNull(), F.col("output_vtu")).alias("output_vtu"),
        "problem",
    )


def build_manifest(
    pairs: DataFrame, outcomes: DataFrame, input_data: str, output_data: str, write_pt: bool = False
) -> DataFrame:
    """Discovery failures and processed pairs in one table of ten columns.

    ``outcomes``: case_id, error, input_status, input_message, output_status,
    output_message; a pair with an error has status transform_failed, and so
    has a pair that has no outcome.
    """
    none = F.lit("")

    def target(folder: str, suffix: str) -> Column:
        return F.concat(F.lit(folder.rstrip("/") + "/"), F.col("case_id"), F.lit(suffix))

    failures = pairs.filter("problem is not null").select(
        "case_id", "row_number", none.alias("input_vtu"), none.alias("output_vtu"),
        none.alias("input_pt"), none.alias("output_pt"), none.alias("input_vti"), none.alias("output_vti"),
        F.lit("discovery_failed").alias("status"), F.col("problem").alias("message"),
    )
    text = F.concat(
        F.lit("input="), F.col("input_status"), F.lit(": "), F.col("input_message"),
        F.lit("; output="), F.col("output_status"), F.lit(": "), F.col("output_message"),
    )
    known = outcomes.withColumn("_known", F.lit(True))
    error = F.when(F.col("_known").isNull(), F.lit("no outcome of the transform")).otherwise(F.col("error"))
    done = pairs.filter("problem is null").join(known, "case_id", "left").withColumn("error", error).select(
        "case_id",
        "row_number",
        "input_vtu",
        "output_vtu",
        (target(input_data, ".pt") if write_pt else none).alias("input_pt"),
        (target(output_data, ".pt") if write_pt else none).alias("output_pt"),
        target(input_data, ".vti").alias("input_vti"),
        target(output_data, ".vti").alias("output_vti"),
        F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("transform_failed")).alias("status"),
        F.coalesce("error", text).alias("message"),
    )
    return failures.unionByName(done).select(*MANIFEST_COLUMNS)


def pair_outcomes(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Outcomes of cases for :func:`build_manifest` from those of their input and output samples.

    ``inputs``, ``outputs``: sample_id (the case), status and message of the
    two transforms. A case fails if either side does, or is not there at all.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("sample_id").alias("case_id"), F.col("status").alias(f"{name}_status"), F.col("message").alias(f"{name}_message"))

    def wrong(name: str) -> Column:
        status, message = F.col(f"{name}_status"), F.col(f"{name}_message")
        return F.when(status.isNull(), F.lit(f"{name} has no sample")).when(
            status != "ok", F.concat(F.lit(f"{name}: "), F.coalesce(message, F.lit("")))
        )

    both = side(inputs, "input").join(side(outputs, "output"), "case_id", "full")
    told = F.nullif(F.concat_ws("; ", wrong("input"), wrong("output")), F.lit(""))
    blank = [F.coalesce(f"{n}_{c}", F.lit("")).alias(f"{n}_{c}") for n in ("input", "output") for c in ("status", "message")]
    return both.select("case_id", told.alias("error"), *blank)


def in_manifest_order(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("row_number", "case_id")


def prep_totals(manifest: DataFrame) -> DataFrame:
    """total, successful, failed, and the overall status."""
    ok = F.col("status") == "ok"
    failed = F.count_if(~ok)
    return manifest.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        failed.alias("failed"),
        F.when(failed == 0, F.lit("ok")).otherwise(F.lit("partial_failure")).alias("status"),
    )
