"""Names of experiment parameters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two accepted name forms.
SOURCE_NAME = r"^P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__(Uexit_mps|Cemit_ugpm3|Texit_K)$"
CONTEXT_NAME = r"^(met|amb|terrain)__[A-Za-z][A-Za-z0-9]*(_[A-Za-z0-9]+)*$"


def snake_case(c: Column) -> Column:
    text = F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_")
    return F.regexp_replace(text, r"^_+|_+$", "")


def doe_case_name(c: Column) -> Column:
    """snake_case of every part between double underscores, which are kept."""
    return F.array_join(F.transform(F.split(c, "__"), snake_case), "__")


def is_param_name(c: Column) -> Column:
    return F.coalesce(c.rlike(SOURCE_NAME) | c.rlike(CONTEXT_NAME), F.lit(False))


def parse_param(c: Column) -> Column:
    """plant, zone, side, variable and unit of a source parameter; NULL for others."""
    pattern = r"^(P[0-9]+)_(SEB|AEX|SEX|VOC)_([AB])__([A-Za-z]+)_([A-Za-z0-9]+)$"

    def part(i: int) -> Column:
        return F.regexp_extract(c, pattern, i)

    return F.when(
        c.rlike(SOURCE_NAME),
        F.struct(
            part(1).alias("plant"),
            part(2).alias("zone"),
            part(3).alias("side"),
            part(4).alias("variable"),
            part(5).alias("unit"),
        ),
    )
