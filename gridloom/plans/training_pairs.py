"""The manifest job: pair the field files of every case of a batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.cells import CASE_ALIASES, cell
from gridloom.operators import manifest
from gridloom.sources.batch_csv import read_batch_csv
from gridloom.sources.workspace import read_workspace


def discover(spark: SparkSession, batch_csv: str, cases_root: str) -> DataFrame:
    """Pairs and discovery problems of one batch table."""
    rows = read_batch_csv(spark, batch_csv, dialect="rfc")
    named = rows.select("row_number", cell("header", "cells", *CASE_ALIASES).alias("raw_case"))
    # Inventory paths carry a scheme; the root is given as a plain path.
    files = read_workspace(spark, cases_root)
    files = files.selectExpr("regexp_replace(path, '^[A-Za-z]+:(//)?', '') AS path")
    return manifest.pair_samples(named, files, cases_root)


def finish(pairs: DataFrame, outcomes: DataFrame, input_data: str, output_data: str, write_pt: bool = False):
    """Manifest and its totals after the transform has reported its outcomes."""
    table = manifest.build_manifest(pairs, outcomes, input_data, output_data, write_pt)
    return table, manifest.prep_totals(table)
