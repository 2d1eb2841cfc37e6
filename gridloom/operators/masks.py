"""Masks, distances and boundary overrides on the canonical grid.

Masks live in one wide table: sample_id, idx and one boolean column per mask.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.functions.angles import FACE_NORMALS, toward_unit, wind_faces
from gridloom.operators.grid import Grid, face_column, with_position
from gridloom.operators.order import small_table


def domain_mask(cells: DataFrame, grid: Grid, bounds: DataFrame | None = None) -> DataFrame:
    """Whole grid, or the inclusive box of the sample's volumetric blocks.

    ``bounds``: sample_id, xmin … zmax, one row per sample.
    """
    if bounds is None:
        return cells.withColumn("domain_mask", F.lit(True))
    joined = with_position(cells, grid).join(bounds, "sample_id", "left")
    inside = None
    for a in "xyz":
        test = F.col(a).between(F.col(f"{a}min"), F.col(f"{a}max"))
        inside = test if inside is None else inside & test
    return joined.select(*cells.columns, F.coalesce(inside, F.lit(False)).alias("domain_mask"))


def phase_masks(cells: DataFrame, reference_valid: str) -> DataFrame:
    """fluid, solid and outside from the reference validity and the domain."""
    fluid = F.col(reference_valid) & F.col("domain_mask")
    return cells.withColumns(
        {
            "fluid_mask": fluid,
            "solid_mask": F.col("domain_mask") & ~fluid,
            "outside_mask": ~F.col("domain_mask"),
        }
    )


def erode(cells: DataFrame, grid: Grid, mask: str, name: str, together: bool = False) -> DataFrame:
    """3 x 3 x 3 erosion; outside the grid counts as false.

    A running minimum per axis. The x and y passes share one partitioning by
    z layer, so the whole erosion moves the data twice, or not at all where it
    is dealt out by whole samples already (``together``).
    """
    placed = with_position(cells, grid).drop("x", "y", "z")
    placed = placed if together else placed.repartition("sample_id", "iz")
    value = F.col(mask)
    current = placed.withColumn(name, value)
    for axis, lines in (("ix", ("iz", "iy")), ("iy", ("iz", "ix")), ("iz", ("iy", "ix"))):
        # Neighbours by position, so an absent cell counts as outside too.
        near = Window.partitionBy("sample_id", *lines).orderBy(axis).rangeBetween(-1, 1)
        whole = F.min(name).over(near) & (F.count(name).over(near) == 3)
        current = current.withColumn(name, whole)
    return current.drop("ix", "iy", "iz")


def fluid_boundary(cells: DataFrame, grid: Grid, together: bool = False) -> DataFrame:
    eroded = erode(cells, grid, "fluid_mask", "_core", together)
    return eroded.withColumn("fluid_boundary_mask", F.col("fluid_mask") & ~F.col("_core")).drop("_core")


#: Pairs of cells in all rows together up to which they are simply compared.
SMALL_PLANE = 500_000
#: Cells of a slab that one task holds at once; a single layer may be larger.
SLAB_CELLS = 500_000


def lower_envelope(f: np.ndarray, step: float) -> np.ndarray:
    """Along each row of ``f``: the least of ``f[j] + (distance of i and j)^2``, infinite where a row has no finite value.

    Every finite entry is a parabola. A row keeps a stack of those that are
    lowest somewhere and where each begins; a new one removes what it covers.
    Each parabola enters and leaves once, so a row costs its length; all rows
    go together. A small plane is done by comparing all pairs of a row at once.
    """
    rows, n = f.shape
    at = np.arange(n) * step
    if rows * n * n <= SMALL_PLANE:
        return (f[:, None, :] + (at[:, None] - at[None]) ** 2).min(axis=2)
    apex = np.zeros((rows, n), np.int64)
    begin = np.full((rows, n + 1), np.inf)
    last = np.full(rows, -1)
    for q in range(n):
        todo = np.flatnonzero(np.isfinite(f[:, q]))
        while len(todo):
            bare = last[todo] < 0
            new = todo[bare]
            last[new], apex[new, 0], begin[new, 0] = 0, q, -np.inf
            todo = todo[~bare]
            if not len(todo):
                break
            p = apex[todo, last[todo]]
            meet = (f[todo, q] + at[q] ** 2 - f[todo, p] - at[p] ** 2) / (2 * (at[q] - at[p]))
            over = meet <= begin[todo, last[todo]]
            kept = todo[~over]
            last[kept] += 1
            apex[kept, last[kept]], begin[kept, last[kept]] = q, meet[~over]
            todo = todo[over]
            last[todo] -= 1
        begin[np.arange(rows), last + 1] = np.inf
    out = np.full((rows, n), np.inf)
    some = np.flatnonzero(last >= 0)
    here = np.zeros(len(some), np.int64)
    for q in range(n):
        while len(further := np.flatnonzero(begin[some, here + 1] < at[q])):
            here[further] += 1
        p = apex[some, here]
        out[some, q] = f[some, p] + (at[q] - at[p]) ** 2
    return out


def _slab_pass(
    cells: DataFrame, grid: Grid, axis: str, thickness: int, along: str, names: Sequence[str]
) -> DataFrame:
    """Envelopes along the named axes, in slabs of so many layers of ``axis`` of every sample."""
    sizes, steps = dict(zip("xyz", grid.dims)), dict(zip("xyz", grid.spacing))
    shape = [min(thickness, sizes[a]) if a == axis else sizes[a] for a in "zyx"]

    def solve(table: pa.Table) -> pa.Table:
        at = {a: table.column(f"i{a}").to_numpy() for a in "zyx"}
        at[axis] = at[axis] % thickness
        place = (at["z"], at["y"], at["x"])
        for name in names:
            f = np.full(shape, np.inf)
            f[place] = table.column(name).to_numpy()
            for a in along:
                lines = np.ascontiguousarray(np.moveaxis(f, "zyx".index(a), -1))
                done = lower_envelope(lines.reshape(-1, sizes[a]), steps[a])
                f = np.moveaxis(done.reshape(lines.shape), -1, "zyx".index(a))
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(f[place]))
        return table

    slab = F.floor(F.col(f"i{axis}") / thickness).alias("_slab")
    return cells.groupBy("sample_id", slab).applyInArrow(solve, cells.schema)


def distance_to_background(cells: DataFrame, grid: Grid, masks: Mapping[str, str]) -> DataFrame:
    """Euclidean distance of each true cell to the nearest false cell of a mask.

    ``masks``: mask column -> distance column; all of them share the passes.
    The grid's edge is no background, nor is an absent cell; a grid without any
    background has no distance (NULL).

    Only keys and squares travel, in slabs of a bounded number of cells: one
    shuffle for the passes along x and y and one for z, or one for all three
    where a whole grid is no larger than a slab. A join brings the other
    columns back.
    """
    names = [f"_sq{i}" for i in range(len(masks))]
    infinity = float("inf")
    done = with_position(cells.select("sample_id", "idx", *masks), grid).select(
        "sample_id", "idx", "iz", "iy", "ix",
        *[F.when(F.col(m), F.lit(infinity)).otherwise(F.lit(0.0)).alias(n) for n, m in zip(names, masks)],
    )
    nx, ny, nz = grid.dims
    if grid.size <= SLAB_CELLS:
        done = _slab_pass(done, grid, "z", nz, "xyz", names)
    else:
        done = _slab_pass(done, grid, "z", max(1, SLAB_CELLS // (nx * ny)), "xy", names)
        done = _slab_pass(done, grid, "y", max(1, SLAB_CELLS // (nx * nz)), "z", names)
    out = done.select("sample_id", "idx", *[F.when(F.col(n) < infinity, F.sqrt(n)).alias(d) for n, d in zip(names, masks.values())])
    return cells.join(out, ["sample_id", "idx"]).select(*cells.columns, *masks.values())


def signed_distance(cells: DataFrame, grid: Grid, wall: str | None = None, wall_valid: str | None = None) -> DataFrame:
    """Positive in the fluid, negative in the solid, zero outside.

    A valid wall distance replaces the transform in the fluid, floored at 0.
    """
    done = distance_to_background(cells, grid, {"fluid_mask": "_fluid", "solid_mask": "_solid"})
    fluid = F.col("_fluid")
    if wall is not None:
        fluid = F.when(F.col(wall_valid), F.greatest(F.col(wall), F.lit(0.0))).otherwise(fluid)
    value = F.when(F.col("fluid_mask"), fluid).when(F.col("solid_mask"), -F.col("_solid")).otherwise(F.lit(0.0))
    return done.withColumn("signed_distance", value).drop("_fluid", "_solid")


def near_wall(cells: DataFrame, grid: Grid, wall: str | None, wall_valid: str | None, threshold: float | None = None) -> DataFrame:
    """Fluid cells near a wall; without a wall distance the boundary cells."""
    limit = 1.5 * min(grid.spacing) if threshold is None else threshold
    if not limit >= 0.0 or limit == float("inf"):
        raise ValueError("the near-wall threshold must be finite and not negative")
    if wall is None:
        return cells.withColumn("near_wall_mask", F.col("fluid_boundary_mask"))
    near = F.col("fluid_mask") & F.col(wall_valid) & (F.col(wall) <= limit)
    return cells.withColumn("near_wall_mask", F.coalesce(near, F.lit(False)))


def wind_masks(cells: DataFrame, grid: Grid, degrees: str, **convention: str) -> DataFrame:
    """Inlet and outlet face of each sample's wind direction, fluid cells only.

    ``degrees`` is a column of the sample; NULL means that the scenario has no
    wind direction and gives no wind mask (NULL).
    """
    faces = wind_faces(toward_unit(F.col(degrees), **convention))
    joined = cells.withColumn("_f", faces)

    def on(face: Column) -> Column:
        hit = F.lit(None).cast("boolean")
        for name, _, _ in FACE_NORMALS:
            hit = F.when(face == name, face_column(grid, name.removesuffix("_face_mask"), F.col("idx"))).otherwise(hit)
        return F.when(F.col(degrees).isNotNull(), hit & F.col("fluid_mask"))

    return joined.withColumns(
        {"wind_inlet_mask": on(F.col("_f.inlet")), "wind_outlet_mask": on(F.col("_f.outlet"))}
    ).drop("_f")


def target_masks(cells: DataFrame, target_valid: Sequence[str]) -> DataFrame:
    """Valid targets inside the domain; loss and metric masks add the fluid."""
    valid = F.lit(bool(target_valid))
    for c in target_valid:
        valid = valid & F.col(c)
    valid = valid & F.col("domain_mask")
    loss = valid & F.col("fluid_mask")
    return cells.withColumns({"target_valid_mask": valid, "loss_mask": loss, "metric_mask": loss})


def target_validity(values: DataFrame, channels: Sequence[str]) -> DataFrame:
    """AND of the validity of several channels per cell, from the long table."""
    return (
        values.filter(F.col("channel").isin(*channels))
        .groupBy("sample_id", "idx")
        .agg((F.every("valid") & (F.count(F.lit(1)) == len(channels))).alias("target_valid"))
    )


def check_masks(masks: DataFrame) -> DataFrame:
    """Number of cells per sample that break each invariant (all zero is good)."""
    m = F.col
    return masks.groupBy("sample_id").agg(
        F.count_if(m("fluid_mask") & m("solid_mask")).alias("fluid_and_solid"),
        F.count_if((m("fluid_mask") | m("solid_mask")) & ~m("domain_mask")).alias("outside_domain"),
        F.count_if(m("loss_mask") & ~m("target_valid_mask")).alias("loss_without_target"),
    )


def mask_fractions(masks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of every mask per sample."""
    return masks.groupBy("sample_id").agg(*[F.avg(F.col(n).cast("int")).alias(n) for n in names])


def select_masks(masks: DataFrame, mask_map: Mapping[str, str]) -> DataFrame:
    """Declared output channels from internal masks, in their declared order.

    Long form: sample_id, idx, ordinal, channel, value. An unknown mask fails.
    """
    unknown = sorted(set(mask_map.values()) - set(masks.columns))
    if unknown:
        raise ValueError(f"unknown masks {unknown}")
    dim = small_table(
        masks.sparkSession,
        [(i, c, m) for i, (c, m) in enumerate(mask_map.items())],
        "ordinal int, channel string, mask string",
    )
    used = sorted(set(mask_map.values()))
    long = masks.select("sample_id", "idx", *used).unpivot(["sample_id", "idx"], used, "mask", "value")
    return long.join(dim, "mask").select("sample_id", "idx", "ordinal", "channel", "value")


def mask_channels(selected: DataFrame) -> DataFrame:
    """Masks as channels of 0 and 1; every cell of a mask is valid."""
    return selected.select(
        "sample_id", "channel", "idx", F.col("value").cast("double").alias("value"), F.lit(True).alias("valid")
    )


@dataclass(frozen=True)
class BoundaryValue:
    """A physical value for one channel on one grid face."""

    channel: str
    face: str
    value: float


def apply_boundary_values(channels: DataFrame, grid: Grid, specs: Sequence[BoundaryValue]) -> DataFrame:
    """Overrides on fluid cells of a face, in list order: a later one wins.

    ``channels``: sample_id, channel, idx, value, fluid_mask. Masks must be
    final and normalisation still to come.
    """
    value = F.col("value")
    for s in specs:
        hit = (F.col("channel") == s.channel) & face_column(grid, s.face, F.col("idx")) & F.col("fluid_mask")
        value = F.when(hit, F.lit(s.value)).otherwise(value)
    return channels.withColumn("value", value)


def boundary_cells(masks: DataFrame, grid: Grid, specs: Sequence[BoundaryValue]) -> DataFrame:
    """How many cells each override sets, per sample."""
    return masks.groupBy("sample_id").agg(
        *[
            F.count_if(face_column(grid, s.face, F.col("idx")) & F.col("fluid_mask")).alias(f"bc_{i:02d}")
            for i, s in enumerate(specs)
        ]
    )


def unknown_overrides(samples: DataFrame, produced: DataFrame, channels: Sequence[str]) -> DataFrame:
    """(sample_id, subject, problem) of overridden channels that a sample doesn't produce.

    ``produced``: sample_id, channel. ``channels``: those that overrides name.
    """
    names = F.explode(F.array(*[F.lit(c) for c in dict.fromkeys(channels)]).cast("array<string>"))
    wanted = samples.select("sample_id").distinct().select("sample_id", names.alias("channel"))
    return wanted.join(produced, ["sample_id", "channel"], "left_anti").select(
        "sample_id", F.col("channel").alias("subject"), F.lit("overridden channel is not produced").alias("problem")
    )


def unknown_boundary_channels(channels: DataFrame, specs: Sequence[BoundaryValue]) -> list[str]:
    """Override channels that no sample produces."""
    wanted = sorted({s.channel for s in specs})
    known = channels.filter(F.col("channel").isin(*wanted)).select("channel").distinct().collect()
    return [c for c in wanted if c not in {r["channel"] for r in known}]
