"""From parameter definitions to audited batches of an experiment table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gridloom.operators import doe
from gridloom.operators.cases import PLANTS, SIDES, ZONES
from gridloom.sources.batch_csv import write_batches, write_csv


def default_factors() -> dict[str, object]:
    """The factor space of the committed campaign, source columns built by rule."""
    # Levels of the context factors.
    factors: dict[str, object] = {
        "met__WS_mps": [0.01, 0.2, 0.5, 1.0, 2.0, 5.0],
        "met__WD_deg": [0.0, 135.0, 175.5, 180.0],
        "met__stability": ["neutral", "stable"],
        "amb__RH_frac": 0.75,
        "amb__Pamb_Pa": 101300.0,
        "amb__Tamb_K": 301.15,
        "amb__Cbg_ugpm3": 0.0,
        "terrain__z0_m": 0.1,
    }
    # Emission per plant and zone, equal on both sides.
    emission = {
        "P1": {"SEB": 1500.0, "AEX": 550.0, "SEX": 750.0, "VOC": 750.0},
        "P2": {"SEB": (0.0, 1850.0, 2), "AEX": (0.0, 350.0, 2), "SEX": (0.0, 600.0, 2), "VOC": (0.0, 7000.0, 3)},
        "P3": {"SEB": 3750.0, "AEX": 350.0, "SEX": 200.0, "VOC": 1000.0},
    }
    variables = {
        "Uexit_mps": lambda plant, zone: 10.0,
        "Cemit_ugpm3": lambda plant, zone: emission[plant][zone],
        "Texit_K": lambda plant, zone: 333.15 if zone == "VOC" else 298.15,
    }
    for variable, value in variables.items():
        for _, plant in PLANTS:
            for side in SIDES:
                for zone in ZONES:
                    factors[f"{plant}_{zone}_{side}__{variable}"] = value(plant, zone)
    return factors


@dataclass
class Campaign:
    table: DataFrame
    summary: DataFrame
    combinations: DataFrame
    audit: DataFrame


def plan_campaign(
    spark: SparkSession, factors: Mapping[str, object], n: int = 128, seed: int = 42, **options
) -> Campaign:
    """The experiment table with its audits."""
    defs = doe.normalize_params(factors)
    table = doe.generate(spark, factors, n, seed, **options)
    definitions = doe.param_table(spark, defs)
    levels = {d["name"]: d["levels"] for d in defs if d["kind"] == "discrete"}
    return Campaign(
        table,
        doe.level_summary(definitions),
        doe.full_factorial(definitions),
        doe.coverage_audit(table, levels),
    )


def write_campaign(campaign: Campaign, root: str, batch_size: int = 16) -> None:
    write_csv(campaign.table, f"{root}/table")
    write_csv(campaign.summary.orderBy("ordinal").drop("ordinal"), f"{root}/levels")
    audit = campaign.audit.orderBy("parameter_ordinal", "level_ordinal")
    write_csv(audit.drop("parameter_ordinal", "level_ordinal"), f"{root}/coverage")
    write_batches(campaign.table, "Case", f"{root}/batches", batch_size)
