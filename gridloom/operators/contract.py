"""Field contracts: defaults, parsing, and consistency checks over many contracts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.operators.order import small_table

DISCRETE_KINDS = ("categorical", "binary_mask", "region_id")
KINDS = ("vector", "continuous_scalar", *DISCRETE_KINDS)
ROLES = ("INPUT", "TARGET", "AUXILIARY")
SPEC_SCHEMA = (
    "source_name string, output_channels array<string>, role string, kind string, required boolean, "
    "expected_components int, association string, interpolation string, extrapolation string, "
    "fill double, scale double, offset double, rotate boolean, volumetric boolean, min_valid double"
)


def with_defaults(spec: DataFrame) -> DataFrame:
    """Absent options of field specs replaced by their defaults."""
    kind = F.lower(F.trim("kind"))
    discrete = kind.isin(*DISCRETE_KINDS)
    return spec.select(
        *[c for c in spec.columns if c not in _DEFAULTED],
        kind.alias("kind"),
        F.upper(F.trim("role")).alias("role"),
        F.coalesce("required", F.lit(True)).alias("required"),
        F.coalesce("expected_components", F.when(kind == "vector", 3).otherwise(1)).alias("expected_components"),
        F.upper("association").alias("association"),
        F.lower(F.coalesce("interpolation", F.when(discrete, "nearest").otherwise("linear"))).alias("interpolation"),
        F.upper(F.coalesce("extrapolation", F.lit("MARK_INVALID"))).alias("extrapolation"),
        F.coalesce("fill", F.lit(0.0)).alias("fill"),
        F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.coalesce("offset", F.lit(0.0)).alias("offset"),
        F.coalesce("rotate", kind == "vector").alias("rotate"),
        F.coalesce("volumetric", F.lit(True)).alias("volumetric"),
        F.coalesce("min_valid", F.lit(0.0)).alias("min_valid"),
    )


_DEFAULTED = (
    "kind", "role", "required", "expected_components", "association", "interpolation", "extrapolation",
    "fill", "scale", "offset", "rotate", "volumetric", "min_valid",
)


def spec_problems(spec: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, source_name, problem) of field specs with defaults applied."""
    kind = F.col("kind")
    discrete = kind.isin(*DISCRETE_KINDS)
    n = F.size("output_channels")

    def rule(bad: Column, text: str) -> Column:
        return F.when(bad, F.lit(text))

    finite = [
        rule(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), f"{c} must be finite")
        for c in ("fill", "scale", "offset", "min_valid")
    ]
    problems = F.array(
        rule(F.coalesce(F.trim("source_name"), F.lit("")) == "", "source_name is empty"),
        rule(F.coalesce(n, F.lit(0)) < 1, "output_channels is empty"),
        rule(F.exists("output_channels", lambda c: F.trim(c) == ""), "an output channel is empty"),
        rule(F.size(F.array_distinct("output_channels")) != n, "duplicate output channels"),
        rule(~kind.isin(*KINDS), "unsupported kind"),
        rule(F.col("expected_components") <= 0, "expected_components must be positive"),
        rule((kind == "vector") & (F.col("expected_components") != 3), "a vector has three components"),
        rule(F.col("expected_components") != n, "component count differs from the channels"),
        rule(~F.col("role").isin(*ROLES), "unsupported role"),
        rule(F.col("association").isNotNull() & ~F.col("association").isin("POINT", "CELL"), "unsupported association"),
        rule(~F.col("interpolation").isin("linear", "nearest"), "unsupported interpolation"),
        rule(discrete & (F.col("interpolation") != "nearest"), "a discrete field needs nearest interpolation"),
        rule(~F.col("extrapolation").isin("ERROR", "MARK_INVALID"), "unsupported extrapolation policy"),
        rule(~F.col("min_valid").between(0.0, 1.0), "min_valid is outside 0..1"),
        rule((kind == "vector") & (F.col("offset") != 0.0), "a vector has no offset"),
        *finite,
    )
    return spec.select(*keys, "source_name", F.explode(F.array_compact(problems)).alias("problem"))


def check_contract(declared: DataFrame, model: DataFrame, stats: DataFrame) -> DataFrame:
    """Violations (contract_id, rule, channel) of many contracts at once.

    ``declared``: contract_id, channel, origin (field, derived or scenario),
    role, required, representation, has_producer. ``model``: contract_id, list
    (input or target), channel. ``stats``: contract_id, channel.

    All facts about one channel of one contract meet in one aggregate row; only
    counters are kept, whatever the number of declarations.
    """
    key = ["contract_id", "channel"]
    field = F.col("origin") == "field"
    facts = declared.select(
        *key,
        F.lit(1).alias("declared"),
        F.when((F.col("origin") != "scenario") | (F.col("representation") == "broadcast"), 1).otherwise(0).alias("spatial"),
        F.when((F.col("origin") == "scenario") & (F.col("representation") == "global"), 1).otherwise(0).alias("global"),
        F.when(field & (F.col("role") == "TARGET"), 1).otherwise(0).alias("target_field"),
        F.when(field & (F.col("role") != "TARGET"), 1).otherwise(0).alias("other_field"),
        F.when(field & ~F.col("required"), 1).otherwise(0).alias("optional_field"),
        F.when((F.col("origin") == "derived") & ~F.col("has_producer"), 1).otherwise(0).alias("unproduced"),
        F.when(
            (F.col("origin") == "scenario")
            & ~F.coalesce(F.col("representation").isin("broadcast", "global"), F.lit(False)),
            1,
        ).otherwise(0).alias("bad_representation"),
        F.lit(0).alias("inputs"),
        F.lit(0).alias("targets"),
        F.lit(0).alias("stats"),
    )
    zero = [c for c in facts.columns if c not in (*key, "inputs", "targets", "stats")]
    uses = model.select(
        *key,
        *[F.lit(0).alias(c) for c in zero],
        F.when(F.col("list") == "input", 1).otherwise(0).alias("inputs"),
        F.when(F.col("list") == "target", 1).otherwise(0).alias("targets"),
        F.lit(0).alias("stats"),
    )
    known = stats.select(
        *key, *[F.lit(0).alias(c) for c in [*zero, "inputs", "targets"]], F.lit(1).alias("stats")
    )
    merged = facts.unionByName(uses).unionByName(known)
    counts = merged.groupBy(*key).agg(*[F.sum(c).alias(c) for c in merged.columns if c not in key])
    c = F.col
    used = (c("inputs") > 0) | (c("targets") > 0)
    rules = {
        "duplicate input channel": c("inputs") > 1,
        "duplicate target channel": c("targets") > 1,
        "channel is input and target": (c("inputs") > 0) & (c("targets") > 0),
        "channel is declared twice": c("declared") > 1,
        "optional field feeds the model": (c("optional_field") > 0) & used,
        "derived channel has no producer": c("unproduced") > 0,
        "unknown representation": c("bad_representation") > 0,
        "model channel has no producer": used & (c("spatial") == 0),
        "target field is an input": (c("target_field") > 0) & (c("inputs") > 0),
        "field-backed target needs role TARGET": (c("other_field") > 0) & (c("targets") > 0),
        "target field is not a target": (c("target_field") > 0) & (c("targets") == 0),
        "global channel is spatial": (c("global") > 0) & used,
        "channel has no statistic": (used | (c("global") > 0)) & (c("stats") == 0),
    }
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return counts.select("contract_id", F.explode(broken).alias("rule"), "channel")


def list_difference(a: Column, b: Column) -> Column:
    return F.array_except(a, b)


def list_overlap(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def merge_lists(*lists: Column) -> Column:
    """Order-preserving union of channel lists."""
    return F.array_distinct(F.concat(*lists))


# ----------------------------------------------------- documents on the driver


def parse_fields(contract: Mapping) -> list[tuple]:
    """Field specs of a contract document, with defaults, as ``field_spec`` rows."""
    raw = contract.get("fields")
    if not isinstance(raw, list) or not raw:
        raise ValueError("the contract needs a list of fields")
    rows = []
    for f in raw:
        kind = str(f["kind"]).strip().lower()
        channels = [str(c).strip() for c in f["output_channels"]]
        n = int(f.get("expected_components", 3 if kind == "vector" else 1))
        interpolation = str(f.get("interpolation", "nearest" if kind in DISCRETE_KINDS else "linear")).lower()
        numbers = [
            float(f.get(k, d))
            for k, d in (("fill_value_physical", 0.0), ("value_scale", 1.0), ("value_offset", 0.0))
        ]
        minimum = float(f.get("minimum_valid_fraction", 0.0))
        association = f.get("preferred_source_association")
        role = str(f["role"]).strip().upper()
        policy = str(f.get("extrapolation_policy", "MARK_INVALID")).upper()
        name = str(f["source_name"]).strip()
        problems = [
            (not name, "empty source name"),
            (not all(channels) or len(set(channels)) != len(channels), "empty or duplicate channels"),
            (kind not in KINDS, f"unsupported kind {kind}"),
            (n <= 0 or n != len(channels), "component count differs from the channels"),
            (kind == "vector" and n != 3, "a vector has three components"),
            (role not in ROLES, f"unsupported role {role}"),
            (interpolation not in ("linear", "nearest"), "unsupported interpolation"),
            (kind in DISCRETE_KINDS and interpolation != "nearest", "a discrete field needs nearest"),
            (policy not in ("ERROR", "MARK_INVALID"), "unsupported extrapolation policy"),
            (not all(math.isfinite(v) for v in [*numbers, minimum]), "options must be finite"),
            (not 0.0 <= minimum <= 1.0, "minimum_valid_fraction is outside 0..1"),
            (kind == "vector" and numbers[2] != 0.0, "a vector has no offset"),
            (association is not None and str(association).upper() not in ("POINT", "CELL"), "unsupported association"),
        ]
        for bad, text in problems:
            if bad:
                raise ValueError(f"field {name!r}: {text}")
        rows.append(
            (
                name, channels, role, kind, bool(f.get("required", True)), n,
                None if association is None else str(association).upper(), interpolation, policy, *numbers,
                bool(f.get("rotate_vector", kind == "vector")),
                bool(f.get("require_volumetric_source", True)), minimum,
            )
        )
    return rows


def field_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return small_table(spark, rows, SPEC_SCHEMA)


def contract_channels(spark: SparkSession, contracts: Mapping[str, Mapping]) -> tuple[DataFrame, DataFrame]:
    """Exploded ``declared`` and ``model`` tables of contract documents."""
    declared, model = [], []
    for cid, doc in contracts.items():
        for row in parse_fields(doc):
            declared += [(cid, ch, "field", row[2], row[4], None, True) for ch in row[1]]
        derived = doc.get("derived_features", {})
        produced = set(derived.get("mask_channel_map", {}))
        if derived.get("derive_signed_distance", True):
            produced.add(derived.get("signed_distance_name", "signed_distance"))
        declared += [
            (cid, ch, "derived", None, True, None, ch in produced) for ch in derived.get("output_channels", [])
        ]
        for p in doc.get("scenario_parameters", []):
            shape = str(p.get("representation", "")).lower()
            declared += [(cid, ch, "scenario", None, True, shape, True) for ch in p["output_channels"]]
        for name in ("input", "target"):
            model += [(cid, name, ch) for ch in doc.get(f"{name}_channels", [])]
    return (
        spark.createDataFrame(
            declared,
            "contract_id string, channel string, origin string, role string, required boolean, "
            "representation string, has_producer boolean",
        ),
        spark.createDataFrame(model, "contract_id string, list string, channel string"),
    )
