"""Registered queries: every operator over the shared tables, with its SQL oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MODULES = ("text", "angles", "experiments", "rows", "workspace", "reports", "fields", "samples", "logs", "files", "streams")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that must agree with it."""

    def add(fn):
        REGISTRY[fn.__name__] = Query(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"catalog.{m}")
    return REGISTRY
