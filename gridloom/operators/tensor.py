"""Padding, tensors, predictions, hashes and provenance."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.statistics import is_finite
from gridloom.operators.grid import Grid
from gridloom.operators.normalize import invert_normalization
from gridloom.operators.order import small_table


@dataclass(frozen=True)
class Padding:
    """Physical window inside the model grid; all triples are (z, y, x)."""

    physical: tuple[int, int, int]
    model: tuple[int, int, int]
    before: tuple[int, int, int]

    @property
    def after(self) -> tuple[int, ...]:
        return tuple(m - p - b for m, p, b in zip(self.model, self.physical, self.before))

    @property
    def size(self) -> int:
        return math.prod(self.model)

    def to_model(self, idx: Column) -> Column:
        """Model index of a physical index."""
        _, ny, nx = self.physical
        z, y, x = F.floor(idx / (ny * nx)), F.floor(idx / nx) % ny, idx % nx
        _, my, mx = self.model
        bz, by, bx = self.before
        return ((z + bz) * my + (y + by)) * mx + (x + bx)

    def to_physical(self, idx: Column) -> Column:
        """Physical index of a model index, NULL for padding cells."""
        pz, py, px = self.physical
        _, my, mx = self.model
        bz, by, bx = self.before
        z, y, x = F.floor(idx / (my * mx)) - bz, F.floor(idx / mx) % my - by, idx % mx - bx
        inside = z.between(0, pz - 1) & y.between(0, py - 1) & x.between(0, px - 1)
        return F.when(inside, (z * py + y) * px + x)


def plan_padding(
    grid: Grid,
    model_shape: Sequence[int] | None = None,
    divisor: Sequence[int] = (16, 16, 16),
    alignment: str = "symmetric",
) -> Padding:
    """Explicit model shape, or every axis rounded up to its divisor."""
    nx, ny, nz = grid.dims
    physical = (nz, ny, nx)
    if model_shape is None:
        model = tuple(-(-p // d) * d for p, d in zip(physical, divisor))
    else:
        model = tuple(int(m) for m in model_shape)
        if any(m < p for m, p in zip(model, physical)):
            raise ValueError(f"model shape {model} is smaller than {physical}")
        if any(m % d for m, d in zip(model, divisor)):
            raise ValueError(f"model shape {model} is not divisible by {tuple(divisor)}")
    if alignment not in ("symmetric", "end"):
        raise ValueError(f"unknown alignment {alignment!r}")
    before = tuple((m - p) // 2 if alignment == "symmetric" else 0 for m, p in zip(model, physical))
    return Padding(physical, model, before)


def _pad_cells(keys: DataFrame, padding: Padding) -> DataFrame:
    """The padding cells of every key row, generated layer by layer."""
    mz, my, mx = padding.model
    layers = keys.withColumn("_z", F.explode(F.sequence(F.lit(0), F.lit(mz - 1))))
    cells = layers.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(my * mx - 1))))
    idx = F.col("_z").cast("bigint") * (my * mx) + F.col("_i")
    return (
        cells.withColumn("idx", idx)
        .filter(padding.to_physical(F.col("idx")).isNull())
        .drop("_z", "_i")
    )


def pad_channels(
    channels: DataFrame, samples: DataFrame, padding: Padding, pad_values: Mapping[str, float] | DataFrame
) -> DataFrame:
    """Channels on the model grid: sample_id, channel, idx, value.

    Physical cells only move to their model index; padding cells are generated
    from the sample list, so no cell is joined or shuffled. ``pad_values`` are
    normalised already and needed for every channel: one number for each, or a
    table (sample_id, channel, value) where samples differ.
    """
    moved = channels.select(
        "sample_id", "channel", padding.to_model(F.col("idx")).alias("idx"), F.col("value").cast("float").alias("value")
    )
    if padding.model == padding.physical:
        return moved
    if isinstance(pad_values, DataFrame):
        keys = pad_values.select("sample_id", "channel", F.col("value").cast("float").alias("value"))
        return moved.unionByName(_pad_cells(keys, padding).select("sample_id", "channel", "idx", "value"))
    names = F.array(
        *[
            F.struct(F.lit(c).alias("channel"), F.lit(float(v)).cast("float").alias("value"))
            for c, v in pad_values.items()
        ]
    )
    keys = samples.select("sample_id", F.inline(names))
    return moved.unionByName(_pad_cells(keys, padding).select("sample_id", "channel", "idx", "value"))


def unpadded_channels(channels: Sequence[str], pad_values: Mapping[str, float]) -> list[str]:
    """Model channels without a declared padding value: an error."""
    return [c for c in channels if c not in pad_values]


def pad_masks(masks: DataFrame, samples: DataFrame, padding: Padding, names: Sequence[str]) -> DataFrame:
    """Masks on the model grid (false in the padding) plus ``padding_mask``."""
    moved = masks.select(
        "sample_id", padding.to_model(F.col("idx")).alias("idx"), *names, F.lit(False).alias("padding_mask")
    )
    if padding.model == padding.physical:
        return moved
    empty = _pad_cells(samples.select("sample_id"), padding).select(
        "sample_id", "idx", *[F.lit(False).alias(n) for n in names], F.lit(True).alias("padding_mask")
    )
    return moved.unionByName(empty)


def padding_overlap(masks: DataFrame) -> DataFrame:
    """Cells per sample where the padding meets the domain (must be none)."""
    return masks.groupBy("sample_id").agg(
        F.count_if(F.col("padding_mask") & F.col("domain_mask")).alias("overlap")
    )


def tensor_layers(channels: DataFrame, shape: Sequence[int]) -> DataFrame:
    """One row per sample, channel and z layer: values in index order.

    A layer is the unit that a task collects, so a large grid is never sorted
    as a whole; ``complete`` tells whether the layer has all of its cells.
    """
    _, ny, nx = shape
    layer = F.floor(F.col("idx") / (ny * nx)).cast("int")
    keyed = channels.withColumn("iz", layer)
    cells = F.array_sort(F.collect_list(F.struct("idx", "value")))
    return keyed.groupBy("sample_id", "channel", "iz").agg(cells.alias("_c")).select(
        "sample_id", "channel", "iz", F.col("_c.value").alias("data"), (F.size("_c") == ny * nx).alias("complete")
    )


def mark_tensors(
    channels: DataFrame, samples: DataFrame, shape: Sequence[int], inputs: Sequence[str], targets: Sequence[str]
) -> DataFrame:
    """sample_tensor(sample_id, role, ordinal, channel, shape, data array<float>, problem).

    Every sample has one row for each channel of each role, in contract order.
    Where its cells are absent, incomplete or without a finite value, ``data``
    is NULL and ``problem`` says so, and the other samples go on.
    """
    order = [("x", i, c) for i, c in enumerate(inputs)] + [("y", i, c) for i, c in enumerate(targets)]
    if not order:
        raise ValueError("no input and no target channel")
    wanted = channels.filter(F.col("channel").isin(*{c for _, _, c in order}))
    layers = tensor_layers(wanted.withColumn("value", F.col("value").cast("float")), shape)
    whole = layers.groupBy("sample_id", "channel").agg(
        F.array_sort(F.collect_list(F.struct("iz", "data"))).alias("_l")
    )
    data = F.flatten(F.col("_l.data"))
    made = whole.select("sample_id", "channel", data.alias("_data"))
    entries = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(i).alias("ordinal"), F.lit(c).alias("channel")) for r, i, c in order])
    due = samples.select("sample_id").distinct().select("sample_id", F.inline(entries))
    problem = (
        F.when(F.col("_data").isNull(), F.lit("channel is absent"))
        .when(F.size("_data") != math.prod(shape), F.lit("channel is incomplete"))
        .when(F.exists("_data", lambda v: ~is_finite(v)), F.lit("value is not finite"))
    )
    found = due.join(made, ["sample_id", "channel"], "left").withColumn("problem", problem)
    return found.select(
        "sample_id",
        "role",
        "ordinal",
        "channel",
        F.array(*[F.lit(int(s)) for s in shape]).alias("shape"),
        F.when(F.col("problem").isNull(), F.col("_data")).alias("data"),
        "problem",
    )


def build_tensors(
    channels: DataFrame, shape: Sequence[int], inputs: Sequence[str], targets: Sequence[str]
) -> DataFrame:
    """sample_tensor(sample_id, role, ordinal, channel, shape, data array<float>).

    Channels come in contract order per role. A channel whose cells are not
    complete, or that a sample lacks, fails the job.
    """
    order = [("x", i, c) for i, c in enumerate(inputs)] + [("y", i, c) for i, c in enumerate(targets)]
    dim = small_table(channels.sparkSession, order, "role string, ordinal int, channel string")
    wanted = channels.join(dim.select("channel").distinct(), "channel", "left_semi")
    layers = tensor_layers(wanted.withColumn("value", F.col("value").cast("float")), shape)
    whole = layers.groupBy("sample_id", "channel").agg(
        F.array_sort(F.collect_list(F.struct("iz", "data"))).alias("_l")
    )
    size = math.prod(shape)
    data = F.flatten(F.col("_l.data"))
    checked = F.when(F.size(data) == size, data).otherwise(
        F.raise_error(F.concat(F.lit("incomplete channel "), F.col("channel"))).cast("array<float>")
    )
    declared = F.explode(F.array(*[F.lit(c) for c in dict.fromkeys([*inputs, *targets])]).cast("array<string>"))
    due = channels.select("sample_id").distinct().select("sample_id", declared.alias("channel"))
    found = due.join(whole, ["sample_id", "channel"], "left")
    return found.select("sample_id", "channel", checked.alias("data")).join(dim, "channel").select(
        "sample_id",
        "role",
        "ordinal",
        "channel",
        F.array(*[F.lit(int(s)) for s in shape]).alias("shape"),
        "data",
    )


def tensor_heads(samples: DataFrame, shape: Sequence[int], inputs: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """sample_head(sample_id, role, channels, shape): what ``x`` and ``y`` of each sample hold, in contract order.

    The shape is (channels, z, y, x); ``x`` of a contract of targets alone has 0 channels.
    """
    roles = [
        F.struct(
            F.lit(role).alias("role"),
            F.array(*[F.lit(c) for c in names]).cast("array<string>").alias("channels"),
            F.array(*[F.lit(int(n)) for n in (len(names), *shape)]).alias("shape"),
        )
        for role, names in (("x", inputs), ("y", targets))
    ]
    return samples.select("sample_id").distinct().select("sample_id", F.inline(F.array(*roles)))


def chunk_tensors(
    channels: DataFrame, samples: DataFrame, shape: Sequence[int], inputs: Sequence[str], targets: Sequence[str], layers: int = 1
) -> DataFrame:
    """Tensors in chunks of z layers: sample_id, role, ordinal, channel, chunk, z0, z1, shape, data array<float>, problem.

    A chunk holds the layers from ``z0`` up to ``z1``, exclusive, and is the
    largest thing that a task or a row holds. Every sample has all chunks of
    each channel of each role. Where cells are absent, repeated or without a
    finite value, ``data`` of that chunk is NULL and ``problem`` says so.
    """
    order = [("x", i, c) for i, c in enumerate(inputs)] + [("y", i, c) for i, c in enumerate(targets)]
    if not order:
        raise ValueError("no input and no target channel")
    if layers < 1:
        raise ValueError("a chunk has one layer or more")
    nz, ny, nx = (int(s) for s in shape)
    cells = channels.filter(F.col("channel").isin(*{c for _, _, c in order})).select(
        "sample_id", "channel", F.col("idx").cast("bigint").alias("idx"), F.col("value").cast("float").alias("value")
    )
    made = cells.groupBy("sample_id", "channel", F.floor(F.col("idx") / (ny * nx * layers)).cast("int").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("_c")
    )
    entries = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(i).alias("ordinal"), F.lit(c).alias("channel")) for r, i, c in order])
    due = samples.select("sample_id").distinct().select("sample_id", F.inline(entries))
    due = due.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(-(-nz // layers) - 1))))
    due = due.withColumn("z0", F.col("chunk") * layers).withColumn("z1", F.least(F.col("z0") + layers, F.lit(nz)))
    whole = F.sequence(F.col("z0").cast("bigint") * (ny * nx), F.col("z1").cast("bigint") * (ny * nx) - 1)
    problem = (
        F.when(F.col("_c").isNull(), F.lit("chunk is absent"))
        .when(F.col("_c.idx") != whole, F.lit("chunk is incomplete"))
        .when(F.exists("_c", lambda c: ~is_finite(c["value"])), F.lit("value is not finite"))
    )
    found = due.join(made, ["sample_id", "channel", "chunk"], "left").withColumn("problem", problem)
    return found.select(
        "sample_id",
        "role",
        "ordinal",
        "channel",
        "chunk",
        "z0",
        "z1",
        F.array(F.col("z1") - F.col("z0"), F.lit(ny), F.lit(nx)).alias("shape"),
        F.when(F.col("problem").isNull(), F.col("_c.value")).alias("data"),
        "problem",
    )


def build_mask_tensors(masks: DataFrame, shape: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Masks as tensors of role ``mask`` with boolean data."""
    long = masks.select("sample_id", "idx", *names).unpivot(["sample_id", "idx"], list(names), "channel", "value")
    layers = tensor_layers(long, shape)
    dim = small_table(
        masks.sparkSession, [(i, n) for i, n in enumerate(names)], "ordinal int, channel string"
    )
    whole = layers.groupBy("sample_id", "channel").agg(
        F.array_sort(F.collect_list(F.struct("iz", "data"))).alias("_l")
    )
    data = F.flatten(F.col("_l.data"))
    data = F.when(F.size(data) == math.prod(shape), data).otherwise(
        F.raise_error(F.concat(F.lit("incomplete mask "), F.col("channel"))).cast("array<boolean>")
    )
    return whole.join(dim, "channel").select(
        "sample_id",
        F.lit("mask").alias("role"),
        "ordinal",
        "channel",
        F.array(F.lit(1), *[F.lit(int(s)) for s in shape]).alias("shape"),
        data.alias("data"),
    )


def to_cells(tensors: DataFrame) -> DataFrame:
    """Tensor data back to one row per cell."""
    keep = [c for c in tensors.columns if c not in ("data", "shape")]
    return tensors.select(*keep, F.posexplode("data").alias("_p", "value")).select(
        *keep, F.col("_p").cast("bigint").alias("idx"), "value"
    )


def inverse_prediction(
    predictions: DataFrame, padding: Padding, stats: DataFrame, channels: Sequence[str]
) -> DataFrame:
    """Cropped physical values of predictions ``[C,Z,Y,X]`` or ``[1,C,Z,Y,X]``.

    ``predictions``: sample_id, shape array<int>, data array<float> in C order.
    A wrong shape fails the job.
    """
    size = padding.size
    want = [len(channels), *padding.model]
    plain = F.array(*[F.lit(v) for v in want])
    batched = F.array(*[F.lit(v) for v in [1, *want]])
    good = (F.col("shape") == plain) | (F.col("shape") == batched)
    data = F.when(good & (F.size("data") == size * len(channels)), F.col("data")).otherwise(
        F.raise_error(F.concat(F.lit("wrong prediction shape "), F.to_json("shape"))).cast("array<float>")
    )
    names = F.array(*[F.lit(c) for c in channels])
    cells = predictions.select("sample_id", F.posexplode(data).alias("_p", "value"))
    cropped = cells.select(
        "sample_id",
        F.get(names, F.floor(F.col("_p") / size).cast("int")).alias("channel"),
        padding.to_physical((F.col("_p") % size).cast("bigint")).alias("idx"),
        "value",
    ).filter("idx is not null")
    return invert_normalization(cropped, stats)


# --------------------------------------------------------------------- hashes


def document_hash(document: Mapping) -> str:
    """SHA-256 of a contract as compact JSON with sorted keys."""
    text = json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def content_hash(c: Column) -> Column:
    """SHA-256 hex of a text or binary column."""
    return F.sha2(c, 256)


def array_hash(dtype: str):
    """Pandas UDF (data, shape) -> SHA-256 over type name, shape and bytes of an array."""

    @F.pandas_udf("string")
    def digest(data: pd.Series, shape: pd.Series) -> pd.Series:
        def one(values, dims) -> str:
            h = hashlib.sha256(str(np.dtype(dtype)).encode("ascii"))
            h.update(np.asarray(dims, dtype=np.int64).tobytes())
            h.update(np.ascontiguousarray(values, dtype=dtype).tobytes())
            return h.hexdigest()

        return pd.Series([one(v, d) for v, d in zip(data, shape)])

    return digest


def stack_channels(tensors: DataFrame) -> DataFrame:
    """One array [C,Z,Y,X] per sample and role, channels in their order."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "data")))
    grouped = tensors.groupBy("sample_id", "role").agg(
        ordered.alias("_o"), F.first("shape").alias("_s")
    )
    return grouped.select(
        "sample_id",
        "role",
        F.concat(F.array(F.size("_o")), "_s").alias("shape"),
        F.flatten(F.col("_o.data")).alias("data"),
    )


def float_bits(x: Column) -> Column:
    """The 32 bits of a float as a whole number, by arithmetic alone.

    NaN has one form. The exponent is guessed from just below, so a power of
    two may be taken as twice the power before, which has the same bits.
    """
    a = F.abs(x.cast("double"))
    e = F.floor(F.log2(a) - 1e-9)
    bits = (
        F.when(a.isNull(), None)
        .when(F.isnan(a), float(0x7FC00000))
        .when(a == float("inf"), float(0x7F800000))
        .when(a < 2.0**-126, a * 2.0**149)
        .otherwise((e + 126) * 2.0**23 + a / F.pow(F.lit(2.0), e) * 2.0**23)
    )
    negative = ~F.isnan(a) & ((x < 0) | (x.cast("string") == "-0.0"))
    return bits.cast("bigint") + F.when(negative, F.lit(1 << 31)).otherwise(F.lit(0))


def float_bytes(data: Column) -> Column:
    """An array of floats as bytes, four for each, high byte first."""
    return F.unhex(F.array_join(F.transform(data, lambda v: F.lpad(F.hex(float_bits(v)), 8, "0")), ""))


def content_digests(tensors: DataFrame) -> DataFrame:
    """x and y digests per sample in two levels: of each z layer's bytes, then of the ordered list of these.

    ``tensors``: sample_id, role, ordinal, shape [Z, Y, X] and data. A channel
    is cut into layers in its own row and only digests meet, so no row ever
    holds several channels. The second level covers type, shape, and the
    layers by channel and z. A role without channels has no digest.
    """
    plane = F.element_at("shape", 2) * F.element_at("shape", 3)
    layer = lambda z: F.slice("data", z * plane + 1, plane)
    own = F.transform(F.sequence(F.lit(0), F.element_at("shape", 1) - 1), lambda z: F.sha2(float_bytes(layer(z)), 256))
    listed = tensors.select("sample_id", "role", "ordinal", F.array_join("shape", "x").alias("_shape"), own.alias("_layers"))
    grouped = listed.groupBy("sample_id", "role").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "_layers"))).alias("_o"), F.min("_shape").alias("_shape")
    )
    text = F.concat_ws(
        "\n", F.lit("float32"), F.concat_ws("x", F.size("_o").cast("string"), F.col("_shape")), F.flatten(F.col("_o._layers"))
    )
    hashed = grouped.select("sample_id", "role", F.sha2(text, 256).alias("digest"))
    return hashed.groupBy("sample_id").agg(
        *[F.max(F.when(F.col("role") == r, F.col("digest"))).alias(f"{r}_digest") for r in ("x", "y")]
    )


def tensor_hashes(tensors: DataFrame) -> DataFrame:
    """x and y hashes per sample."""
    stacked = stack_channels(tensors)
    hashed = stacked.select(
        "sample_id", "role", array_hash("float32")(F.col("data"), F.col("shape")).alias("sha256")
    )
    return hashed.groupBy("sample_id").agg(
        *[F.max(F.when(F.col("role") == r, F.col("sha256"))).alias(f"{r}_sha256") for r in ("x", "y")]
    )


# ----------------------------------------------------------------- provenance


def channel_provenance(values: DataFrame, contract_fields: DataFrame) -> DataFrame:
    """Valid fraction and contract facts of every channel, as one map per sample.

    ``contract_fields`` (small): channel, source_field, role, kind,
    target_unit, extrapolation_policy, fill_value.
    """
    fraction = values.groupBy("sample_id", "channel").agg(
        F.avg(F.col("valid").cast("int")).alias("valid_fraction")
    )
    facts = [c for c in contract_fields.columns if c != "channel"]
    joined = fraction.join(F.broadcast(contract_fields), "channel")
    entry = F.struct("channel", F.struct("valid_fraction", *facts).alias("facts"))
    return joined.groupBy("sample_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("resampling")
    )


def provenance(
    samples: DataFrame,
    grid: Grid,
    padding: Padding,
    inputs: Sequence[str],
    targets: Sequence[str],
    contract_hash: str,
    statistics_hash: str,
    parts: Mapping[str, DataFrame],
) -> DataFrame:
    """One metadata row per sample; ``parts`` are tables keyed by sample_id.

    Every column of a part becomes a field of the struct named after it.
    """
    def numbers(values: Sequence) -> Column:
        return F.array(*[F.lit(v) for v in values])

    out = samples.select("sample_id").distinct()
    for name, df in parts.items():
        rest = [c for c in df.columns if c != "sample_id"]
        out = out.join(df.select("sample_id", F.struct(*rest).alias(name)), "sample_id", "left")
    return out.select(
        "sample_id",
        F.lit(contract_hash).alias("contract_sha256"),
        F.lit(statistics_hash).alias("normalization_sha256"),
        F.struct(
            numbers(grid.origin).alias("cell_center_origin_xyz"),
            numbers(grid.spacing).alias("spacing_xyz"),
            numbers(grid.dims).alias("dimensions_xyz"),
        ).alias("grid"),
        F.struct(
            numbers(padding.physical).alias("physical_shape_zyx"),
            numbers(padding.model).alias("model_shape_zyx"),
            numbers(padding.before).alias("pad_before_zyx"),
            numbers(padding.after).alias("pad_after_zyx"),
        ).alias("padding"),
        F.struct(
            numbers(inputs).cast("array<string>").alias("x"), numbers(targets).cast("array<string>").alias("y")
        ).alias("channel_order"),
        *parts,
    )
