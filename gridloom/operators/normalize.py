"""Frozen statistics applied to channels. Statistics are never fitted here."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.functions.statistics import METHODS, denormalize, is_finite, normalize
from gridloom.operators.order import small_table

STAT_COLUMNS = (
    "method", "mean", "std", "median", "scale", "min", "max", "out_lo", "out_hi", "epsilon",
)
STAT_SCHEMA = "channel string, method string, " + ", ".join(f"`{c}` double" for c in STAT_COLUMNS[1:])


def parse_statistics(document: Mapping) -> list[tuple]:
    """Checked ``norm_stat`` rows of a statistics document on the driver."""
    if document.get("frozen") is not True:
        raise ValueError("the statistics document must be frozen")
    if not isinstance(document.get("channels"), Mapping):
        raise ValueError("the statistics document needs a channels object")
    rows = []
    for channel, s in document["channels"].items():
        lo, hi = s.get("output_range", (None, None))
        values = [s.get(k) for k in ("mean", "std", "median", "scale", "min", "max")]
        rows.append(
            (
                channel,
                str(s.get("method", "identity")).lower(),
                *[None if v is None else float(v) for v in [*values, lo, hi, s.get("epsilon")]],
            )
        )
    return rows


def stat_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return small_table(spark, rows, STAT_SCHEMA)


def invalid_statistics(stats: DataFrame) -> DataFrame:
    """(channel, problem) of statistics that cannot be applied."""
    method = F.lower(F.coalesce("method", F.lit("identity")))

    def bad(c: Column) -> Column:
        return ~is_finite(c) | (c <= 0)

    problem = (
        F.when(~method.isin(*METHODS), F.lit("unsupported method"))
        .when(
            method.isin("zscore", "log1p_zscore", "signed_log1p_zscore") & bad(F.col("std")),
            F.lit("std must be finite and positive"),
        )
        .when((method == "robust_zscore") & bad(F.col("scale")), F.lit("scale must be finite and positive"))
        .when(
            (method == "minmax") & bad(F.col("max") - F.col("min")),
            F.lit("max-min must be finite and positive"),
        )
        .when(
            (method == "minmax")
            & bad(F.coalesce("out_hi", F.lit(1.0)) - F.coalesce("out_lo", F.lit(0.0))),
            F.lit("output range must be finite and positive"),
        )
        .when(
            (method == "log1p_zscore") & F.col("epsilon").isNotNull() & ~is_finite(F.col("epsilon")),
            F.lit("epsilon must be finite"),
        )
    )
    columns = ["path", "channel"] if "path" in stats.columns else ["channel"]
    if "frozen" in stats.columns:
        problem = F.when(~F.col("frozen"), F.lit("statistics are not frozen")).otherwise(problem)
    return stats.select(*columns, problem.alias("problem")).filter("problem is not null")


def with_stats(channels: DataFrame, stats: DataFrame) -> DataFrame:
    """Join each channel row with its statistic (a contract table)."""
    return channels.join(F.broadcast(stats), "channel")


def channels_without_stats(channels: DataFrame, stats: DataFrame) -> DataFrame:
    """Channels that have no statistic: an error before anything is normalised."""
    return channels.select("channel").distinct().join(stats.select("channel"), "channel", "left_anti")


def apply_normalization(channels: DataFrame, stats: DataFrame) -> DataFrame:
    """``value`` normalised to float32. A value without a result fails the job."""
    joined = with_stats(channels, stats)
    y = normalize(F.col("value"))
    checked = F.when(is_finite(y), y).otherwise(
        F.raise_error(F.concat(F.lit("normalisation of "), F.col("channel"), F.lit(" is not finite"))).cast("double")
    )
    return joined.withColumn("value", checked.cast("float")).select(*channels.columns)


def normalized_or_null(channels: DataFrame, stats: DataFrame, on: Sequence[str] = ("channel",)) -> DataFrame:
    """``value`` normalised to float32, NULL where it has no finite result or no statistic."""
    joined = channels.join(stats, list(on), "left")
    y = normalize(F.col("value"))
    known = F.col("method").isNotNull() & is_finite(y)
    return joined.withColumn("value", F.when(known, y).cast("float")).select(*channels.columns)


# ------------------------------------------------- statistics of many documents


def versioned_statistics(spark: SparkSession, documents: Sequence[tuple[str, int, Mapping]]) -> DataFrame:
    """Statistics of several frozen documents: document, version and the columns of ``stat_table``."""
    rows = [(name, int(version), *row) for name, version, d in documents for row in parse_statistics(d)]
    return small_table(spark, rows, f"document string, version int, {STAT_SCHEMA}")


def declared_statistics(declared: DataFrame, stats: DataFrame, channels: Sequence[str]) -> DataFrame:
    """The statistic of every model channel of every sample, or the problem with it.

    ``declared``: sample_id, document and version; a NULL version means the
    document's latest. ``stats``: document, version, channel and the columns of
    a statistic. Result: sample_id, channel, the statistic, document, version
    and problem: no document declared, an unknown document or version, a
    channel without a statistic, or one that is declared twice. Each sample has
    exactly one row for each channel, so nothing multiplies or vanishes when
    cells are joined with it.
    """
    latest = stats.groupBy("document").agg(F.max("version").alias("_latest"))
    known = stats.select("document", "version").distinct().withColumn("_known", F.lit(True))
    columns = [F.col(f"_s.{c}").alias(c) for c in STAT_COLUMNS]
    single = stats.groupBy("document", "version", "channel").agg(
        F.first(F.struct(*STAT_COLUMNS)).alias("_s"), F.count(F.lit(1)).alias("_rows")
    )
    per_sample = declared.groupBy("sample_id").agg(
        F.first(F.struct("document", "version")).alias("_d"), F.count(F.lit(1)).alias("_declared")
    ).select("sample_id", "_declared", "_d.document", "_d.version")
    wanted = (
        per_sample.join(latest, "document", "left")
        .withColumn("version", F.coalesce("version", "_latest"))
        .join(known, ["document", "version"], "left")
        .withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels]).cast("array<string>")))
    )
    problem = (
        F.when(F.col("_declared") > 1, F.lit("several statistics documents are declared"))
        .when(F.col("document").isNull(), F.lit("no statistics document is declared"))
        .when(F.col("_latest").isNull(), F.concat(F.lit("unknown statistics document "), F.col("document")))
        .when(F.col("_known").isNull(), F.concat_ws(" ", F.col("document"), F.lit("has no version"), F.col("version").cast("string")))
        .when(F.col("_rows").isNull(), F.lit("channel has no statistic"))
        .when(F.col("_rows") > 1, F.lit("channel has several statistics"))
    )
    return wanted.join(single, ["document", "version", "channel"], "left").select(
        "sample_id", "channel", *columns, "document", "version", problem.alias("problem")
    )


def unnormalizable(channels: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows per channel that have no finite normalised value."""
    joined = with_stats(channels, stats)
    return (
        joined.filter(~is_finite(normalize(F.col("value"))))
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def invert_normalization(channels: DataFrame, stats: DataFrame) -> DataFrame:
    """Physical float32 values; a result that is not finite fails the job."""
    joined = with_stats(channels, stats)
    x = denormalize(F.col("value").cast("double"))
    checked = F.when(x.isNotNull(), x).otherwise(
        F.raise_error(F.concat(F.lit("inverse of "), F.col("channel"), F.lit(" is not finite"))).cast("double")
    )
    return joined.withColumn("value", checked.cast("float")).select(*channels.columns)


def normalize_number(value: float, stat: Sequence) -> float:
    """One contract constant (a padding value) normalised on the driver."""
    s = dict(zip(("channel", *STAT_COLUMNS), stat))
    method = s["method"]
    if method == "identity":
        return value
    if method == "zscore":
        return (value - s["mean"]) / s["std"]
    if method == "robust_zscore":
        return (value - s["median"]) / s["scale"]
    if method == "minmax":
        lo, hi = (0.0, 1.0) if s["out_lo"] is None else (s["out_lo"], s["out_hi"])
        return lo + (value - s["min"]) * (hi - lo) / (s["max"] - s["min"])
    if method == "log1p_zscore":
        return (math.log1p(value + (s["epsilon"] or 0.0)) - s["mean"]) / s["std"]
    if method == "signed_log1p_zscore":
        return (math.copysign(math.log1p(abs(value)), value) - s["mean"]) / s["std"]
    raise ValueError(f"unsupported method {method!r}")
