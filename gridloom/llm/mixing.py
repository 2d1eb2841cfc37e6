"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words (water filling: shares by weight,
capped at ``cap`` times the source, the excess reshared). Within the mix a
source's weight changes over training time t in [0, 1] by the density
``1 + slope (2t - 1)``; its integral ``t + slope (t^2 - t)`` is the share of
its target that is due until t. A document that begins after ``c`` words of
its source's shuffled, repeated stream is therefore trained at the time where
that integral equals ``c / target``. Documents are range-sorted by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, running_total
from gridloom.session import cut_lineage

#: White space that ends a word for sizes.
SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Slopes of the weight schedules, repeating like the weights: early, late, and even.
SLOPES = (-0.5, 0.5, 0.0)


def with_size(docs: DataFrame) -> DataFrame:
    """``size``: the number of runs of anything but white space; 0 for a null text."""
    pieces = F.split(F.coalesce("text", F.lit("")), SPACE)
    ends = (F.get(pieces, F.lit(0)) == "").cast("int") + (
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")
    ).cast("int")
    return docs.withColumn("size", (F.size(pieces) - ends).cast("long"))


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    slopes: Sequence[float] = SLOPES,
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """One row per source: ``source, rank, source_size, weight, slope, target``.

    Sources are ranked by code point, null last, and take weights and slopes
    in turn. The level that all uncapped sources share per unit of weight
    rises while some source is above its cap; each step is one aggregate over
    the sources and only its two sums reach the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1))
    order = [F.col("source").asc_nulls_last()]
    ranked = running_total(sums, order, "_one", "rank").drop("_one")
    turn = lambda values: F.get(F.array(*map(F.lit, map(float, values))), (F.col("rank") % len(values)).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", turn(weights)).withColumn("slope", turn(slopes)))
    total = ranked.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("source_size") * cap <= F.lit(level) * F.col("weight")
        got = ranked.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(full.cast("int")).alias("capped"),
        ).first()
        if not got["weights"] or (got["capped"] == capped):
            break
        capped = got["capped"]
        level = (share * total - cap * got["fixed"]) / got["weights"]
    return ranked.withColumn("target", F.least(F.col("source_size") * cap, F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    slopes: Sequence[float] = SLOPES,
    share: float = 1.5,
    cap: float = 2.0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs(doc_id, source, text)``, sorted by training position.

    ``taken`` words of the document are in the mix (at most ``cap`` times its
    size, whole epochs first, then the part of the last one up to the target);
    ``position`` is the training time of its first word, null if it isn't
    taken, and ``epochs`` holds the time of every pass. Null sources are one
    source, the last. Null and empty texts have size 0 and are taken nowhere.
    Ties in the shuffled order are equal rows in all that counts here. An
    empty table gives no row. ``keep`` names further columns to carry.
    """
    sized = with_size(docs).select("doc_id", "source", "size", *keep)
    targets = bounded_broadcast(source_targets(sized, weights, slopes, share, cap))
    joined = sized.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # A reproducible shuffle inside each source.
    joined = joined.withColumn("_hash", F.md5(F.col("doc_id").cast("string")))
    order = [F.col("rank"), F.col("_hash").asc_nulls_last(), F.col("size")]
    placed = running_total(joined, order, "size", "_from", group=["rank"])
    due = F.floor(F.col("target") + 0.5)
    passes = range(max(1, int(-(-cap // 1))))
    begin = [F.col("_from") + F.col("source_size") * e for e in passes]
    part = [F.greatest(F.lit(0), F.least(b + F.col("size"), due) - b) for b in begin]
    taken = part[0]
    for p in part[1:]:
        taken = taken + p
    u = lambda b: b.cast("double") / F.col("target")
    a = F.col("slope")
    time = lambda b: F.when(a == 0, u(b)).otherwise(
        ((a - 1) + F.sqrt((1 - a) * (1 - a) + 4 * a * u(b))) / (2 * a)
    )
    out = placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(part[0] > 0, time(begin[0])).alias("position"),
        F.array_compact(
            F.array(*[F.when(p > 0, F.struct(time(b).alias("time"), p.cast("long").alias("words"))) for b, p in zip(begin, part)])
        ).alias("epochs"),
        *keep,
    )
    return out.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )
