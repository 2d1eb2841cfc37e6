"""Scenario parameters of many samples as channels or global features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.angles import toward_unit
from gridloom.operators.normalize import with_stats
from gridloom.functions.statistics import normalize


@dataclass(frozen=True)
class Parameter:
    """One declared scenario parameter."""

    name: str
    type: str
    representation: str
    output_channels: tuple[str, ...]
    default: object = None
    categories: tuple[str, ...] = ()
    convention: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        expected = {"scalar": 1, "angle": 2, "categorical": len(self.categories)}
        if self.type not in expected:
            raise ValueError(f"unsupported parameter type {self.type!r}")
        if self.representation not in ("broadcast", "global"):
            raise ValueError(f"unsupported representation {self.representation!r}")
        if self.type == "categorical" and not self.categories:
            raise ValueError(f"{self.name} has no categories")
        if len(self.output_channels) != expected[self.type]:
            raise ValueError(f"{self.name} needs {expected[self.type]} output channels")


def parse_parameters(documents: Sequence[Mapping]) -> list[Parameter]:
    return [
        Parameter(
            str(d["name"]),
            str(d["type"]).lower(),
            str(d["representation"]).lower(),
            tuple(str(c) for c in d["output_channels"]),
            d.get("default"),
            tuple(str(c) for c in d.get("categories", ())),
            dict(d.get("convention", {})),
        )
        for d in documents
    ]


def _raw(p: Parameter, params: Column) -> Column:
    given = F.try_element_at(params, F.lit(p.name))
    return given if p.default is None else F.coalesce(given, F.lit(str(p.default)))


def encode(p: Parameter, params: Column) -> Column:
    """Array of the parameter's channel values; NULL when it is missing or unknown."""
    raw = _raw(p, params)
    if p.type == "scalar":
        number = raw.try_cast("double")
        return F.when(number.isNotNull(), F.array(number))
    if p.type == "angle":
        number = raw.try_cast("double")
        unit = toward_unit(number, **p.convention)
        return F.when(number.isNotNull(), F.array(unit["y"], unit["x"]))
    known = F.array(*[F.lit(c) for c in p.categories])
    one_hot = F.transform(known, lambda c: (c == raw).cast("double"))
    return F.when(F.array_contains(known, raw), one_hot)


def encode_scenarios(samples: DataFrame, parameters: Sequence[Parameter]) -> DataFrame:
    """(sample_id, ordinal, name, representation, channel, value, used_default, problem).

    ``samples``: sample_id and params map<string,string>. One narrow pass.
    """
    params = F.col("params")
    entries = []
    step = max([1000, *[len(p.output_channels) for p in parameters]])
    for i, p in enumerate(parameters):
        values = encode(p, params)
        given = F.try_element_at(params, F.lit(p.name))
        problem = F.when(
            values.isNull(),
            F.when(_raw(p, params).isNull(), F.lit(f"scenario lacks {p.name}")).otherwise(
                F.concat(F.lit(f"unusable value of {p.name}: "), _raw(p, params))
            ),
        )
        for j, channel in enumerate(p.output_channels):
            entries.append(
                F.struct(
                    F.lit(i * step + j).alias("ordinal"),
                    F.lit(p.name).alias("name"),
                    F.lit(p.representation).alias("representation"),
                    F.lit(channel).alias("channel"),
                    F.get(values, F.lit(j)).alias("value"),
                    given.isNull().alias("used_default"),
                    problem.alias("problem"),
                )
            )
    return samples.select("sample_id", F.inline(F.array(*entries)))


def scenario_problems(encoded: DataFrame) -> DataFrame:
    """(sample_id, subject, problem) of parameters that a sample lacks or gives wrongly, once for each."""
    found = encoded.filter("problem is not null").select("sample_id", F.col("name").alias("subject"), "problem")
    return found.distinct()


def broadcast_channels(encoded: DataFrame, cells: DataFrame) -> DataFrame:
    """Scenario channels on every cell of their sample.

    ``cells``: sample_id, idx. The encoded side has a handful of rows per
    sample; Spark picks the join by its size.
    """
    per_sample = encoded.filter("representation = 'broadcast'").select("sample_id", "channel", "value")
    return cells.select("sample_id", "idx").join(per_sample, "sample_id").select(
        "sample_id", "channel", "idx", "value", F.lit(True).alias("valid")
    )


def global_features(encoded: DataFrame, stats: DataFrame | None = None, on: Sequence[str] = ("channel",)) -> DataFrame:
    """Global vector per sample in declared order, normalised when stats are given, which are joined on ``on``."""
    rows = encoded.filter("representation = 'global'")
    value = F.col("value")
    if stats is not None:
        rows = with_stats(rows, stats) if list(on) == ["channel"] else rows.join(stats, list(on))
        value = normalize(value)
    ordered = F.array_sort(
        F.collect_list(F.struct("ordinal", "channel", value.cast("float").alias("value")))
    )
    return rows.groupBy("sample_id").agg(ordered.alias("_o")).select(
        "sample_id",
        F.transform("_o", lambda o: o["channel"]).alias("names"),
        F.transform("_o", lambda o: o["value"]).alias("features"),
    )
