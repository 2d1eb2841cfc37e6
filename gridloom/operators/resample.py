"""From cells and points of source blocks to channels on the canonical grid.

Field values travel in columns ``v0 … v<n-1>``, one per component; the number
of components is part of the field contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.statistics import is_finite
from gridloom.operators.grid import CoordinateMap, Grid, map_bounds, unmap_point

CELL_KEY = ("sample_id", "block_id", "cell_id")
POINT_KEY = ("sample_id", "block_id", "point_id")
DISCRETE = ("categorical", "binary_mask", "region_id")
POLICIES = ("ERROR_ON_OVERLAP", "REGION_PRIORITY", "VALIDITY_PRIORITY", "WEIGHTED_BLEND")


def components(n: int) -> list[str]:
    return [f"v{i}" for i in range(n)]


def spread_values(values: DataFrame, n: int) -> DataFrame:
    """``values array<double>`` to component columns."""
    rest = [c for c in values.columns if c != "values"]
    return values.select(*rest, *[F.get("values", F.lit(i)).alias(f"v{i}") for i in range(n)])


# -------------------------------------------------------------- harmonisation


def cell_to_point(cells: DataFrame, values: DataFrame, n: int = 1) -> DataFrame:
    """Point value = mean over the cells that use the point.

    ``cells``: cell key, point_ids. ``values``: cell key, v0 … .
    """
    # Join first: the cells are shuffled once, not once per corner.
    whole = cells.select(*CELL_KEY, "point_ids").join(values.select(*CELL_KEY, *components(n)), list(CELL_KEY))
    joined = whole.select(*CELL_KEY, *components(n), F.explode("point_ids").alias("point_id"))
    return joined.groupBy(*POINT_KEY).agg(*[F.avg(v).alias(v) for v in components(n)])


def point_to_cell(
    cells: DataFrame, values: DataFrame, n: int = 1, kind: str = "continuous_scalar", together: bool = False
) -> DataFrame:
    """Cell value from its points: majority for discrete kinds, else the mean.

    Of equally frequent values the smallest wins. ``together``: the tables are
    dealt out by whole samples already.
    """
    used = cells.select(*CELL_KEY, F.explode("point_ids").alias("point_id"))
    joined = used.join(values.select(*POINT_KEY, *components(n)), list(POINT_KEY)).select(*CELL_KEY, *components(n))
    if kind not in DISCRETE:
        return joined.groupBy(*CELL_KEY).agg(*[F.avg(v).alias(v) for v in components(n)])
    # Counts are plain numbers: no map of values per cell is built, sorted or shuffled.
    joined = joined if together else joined.repartition(*CELL_KEY)
    found = None
    for v in components(n):
        counts = joined.groupBy(*CELL_KEY, v).agg((-F.count(v)).alias("_n"))
        best = counts.groupBy(*CELL_KEY).agg(F.min(F.struct("_n", v)).alias("_b"))
        best = best.select(*CELL_KEY, F.col(f"_b.{v}").alias(v))
        found = best if found is None else found.join(best, list(CELL_KEY))
    return found


# ------------------------------------------------------------- point location


def locate(cells: DataFrame, grid: Grid, keep: Sequence[str] = (), cmap: CoordinateMap | None = None) -> DataFrame:
    """Grid cells whose centre lies in each axis-aligned source cell.

    The grid is regular, so a source cell knows the index range it covers: the
    hits are generated from the cell itself and no join of points with cells is
    needed. Bounds are inclusive; a face shared by two cells hits both.

    With ``cmap`` the cells are boxes in source coordinates under any proper
    rotation: the range comes from the mapped box's bounds, and a centre is
    taken back to the source to be tested there. Its source coordinates then
    come back as ``sx``, ``sy``, ``sz``.
    """
    def reach(axis: int, low: Column, high: Column) -> tuple[Column, Column]:
        """First and last index that may lie inside: one of margin on both sides."""
        o, d, n = grid.origin[axis], grid.spacing[axis], grid.dims[axis]
        return F.greatest(F.ceil((low - o) / d) - 1, F.lit(0)), F.least(F.floor((high - o) / d) + 1, F.lit(n - 1))

    def indices(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    # The sample stays a plain column: Spark still knows by which column the hits are dealt out.
    rest = [*CELL_KEY[1:], *keep]
    if cmap is None:
        rows = cells.select("sample_id", F.struct(*rest).alias("_cell"), *[f"{a}{s}" for a in "xyz" for s in ("lo", "hi")])
        for n, a in ((2, "z"), (1, "y"), (0, "x")):
            low, high = F.col(f"{a}lo"), F.col(f"{a}hi")
            others = [c for c in rows.columns if c not in (f"{a}lo", f"{a}hi")]
            first, last = reach(n, low, high)
            rows = rows.select(*others, low, high, F.explode(indices(first, last)).alias(f"i{a}"))
            # The exact test on the centre comes after the margin.
            rows = rows.filter(grid.centre(n, F.col(f"i{a}")).between(low, high)).select(*others, f"i{a}")
        idx = grid.index(F.col("ix"), F.col("iy"), F.col("iz")).alias("idx")
        return rows.select("sample_id", *[F.col(f"_cell.{c}").alias(c) for c in rest], "iz", "iy", "ix", idx)

    own = [f"{a}{s}" for a in "xyz" for s in ("lo", "hi")]
    # All that a cell carries travels in one struct, which keeps the generated code small.
    rows = cells.select("sample_id", F.struct(*dict.fromkeys([*rest, *own])).alias("_cell"), *own)
    rows = map_bounds(rows, cmap).select(
        "sample_id", "_cell", *[c.alias(f"_{e}{a}") for n, a in enumerate("xyz") for e, c in zip("fl", reach(n, F.col(f"{a}lo"), F.col(f"{a}hi")))]
    )
    for a in "zyx":
        names = [c for c in rows.columns if c not in (f"_f{a}", f"_l{a}")]
        rows = rows.select(*names, F.explode(indices(F.col(f"_f{a}"), F.col(f"_l{a}"))).alias(f"i{a}"))
    at = unmap_point(cmap, [grid.centre(n, F.col(f"i{a}")) for n, a in enumerate("xyz")])
    rows = rows.select("sample_id", "_cell", "iz", "iy", "ix", *[c.alias(f"s{a}") for a, c in zip("xyz", at)])
    for a in "xyz":
        rows = rows.filter(F.col(f"s{a}").between(F.col(f"_cell.{a}lo"), F.col(f"_cell.{a}hi")))
    idx = grid.index(F.col("ix"), F.col("iy"), F.col("iz")).alias("idx")
    return rows.select("sample_id", *[F.col(f"_cell.{c}").alias(c) for c in rest], "iz", "iy", "ix", "sx", "sy", "sz", idx)


def resample_nearest(
    cells: DataFrame, values: DataFrame, grid: Grid, n: int = 1, cmap: CoordinateMap | None = None
) -> DataFrame:
    """Value of the containing cell; on shared faces the least cell id wins."""
    sized = cells.join(values.select(*CELL_KEY, *components(n)), list(CELL_KEY))
    hits = locate(sized, grid, components(n), cmap)
    best = hits.groupBy("sample_id", "block_id", "idx").agg(
        F.min(F.struct("cell_id", *components(n))).alias("_b")
    )
    return _validated(best.select("sample_id", "block_id", "idx", *[F.col(f"_b.{v}").alias(v) for v in components(n)]), n)


def resample_linear(
    cells: DataFrame, points: DataFrame, values: DataFrame, grid: Grid, n: int = 1, cmap: CoordinateMap | None = None,
    together: bool = False,
) -> DataFrame:
    """Trilinear interpolation of point values inside the containing cell.

    ``cells``: cell key, point_ids and bounds xlo … zhi; ``points``: point key,
    x, y, z; ``values``: point key, v0 … . A corner is told by its coordinates,
    so the order of ``point_ids`` does not matter. With ``cmap`` cells and
    points are in source coordinates, and the weights are taken there.
    ``together``: the tables are dealt out by whole samples already.
    """
    names = components(n)
    bounds = [f"{a}{s}" for a in "xyz" for s in ("lo", "hi")]
    middles = [((F.col(f"{a}lo") + F.col(f"{a}hi")) / 2).alias(f"_{a}") for a in "xyz"]
    used = cells.select(*CELL_KEY, *middles, F.explode("point_ids").alias("point_id"))
    at = points.select(*POINT_KEY, "x", "y", "z").join(values.select(*POINT_KEY, *names), list(POINT_KEY))
    corner = sum((F.col(a) > F.col(f"_{a}")).cast("int") * 2**k for k, a in enumerate("xyz"))
    corners = used.join(at, list(POINT_KEY)).select(*CELL_KEY, corner.alias("_c"), *names)
    # The corners go to their cells as narrow rows, the bounds once a cell.
    corners = corners if together else corners.repartition(*CELL_KEY)
    corners = corners.groupBy(*CELL_KEY).agg(
        *[F.max(F.when(F.col("_c") == c, F.col(v))).alias(f"{v}_{c}") for v in names for c in range(8)]
    )
    boxes = corners.join(cells.select(*CELL_KEY, *bounds), list(CELL_KEY))
    parts = [f"{v}_{c}" for v in names for c in range(8)]
    hits = locate(boxes, grid, [*bounds, *parts], cmap)

    def share(axis: int) -> Column:
        a = "xyz"[axis]
        length = F.col(f"{a}hi") - F.col(f"{a}lo")
        at = grid.centre(axis, F.col(f"i{a}")) if cmap is None else F.col(f"s{a}")
        inside = at - F.col(f"{a}lo")
        return F.when(length > 0, inside / length).otherwise(F.lit(0.0))

    # Blended where the hits arise, step by step to keep the generated code small: only the values are shuffled.
    key = ("sample_id", "block_id", "idx", "cell_id")
    weighed = hits.select(*key, *parts, *[share(axis).alias(f"_t{axis}") for axis in range(3)])
    weighed = weighed.select(*key, *parts, *[_weight(c).alias(f"_w{c}") for c in range(8)])
    blended = [sum((F.col(f"_w{c}") * F.col(f"{v}_{c}") for c in range(1, 8)), F.col("_w0") * F.col(f"{v}_0")) for v in names]
    best = weighed.select(*key, *[b.alias(v) for b, v in zip(blended, names)]).groupBy("sample_id", "block_id", "idx").agg(
        F.min(F.struct("cell_id", *names)).alias("_b")
    )
    return _validated(best.select("sample_id", "block_id", "idx", *[F.col(f"_b.{v}").alias(v) for v in names]), n)


def _weight(corner: int) -> Column:
    """Share of a corner from the shares ``_t0`` to ``_t2`` along the axes."""
    x, y, z = (F.col(f"_t{a}") if corner >> a & 1 else 1 - F.col(f"_t{a}") for a in range(3))
    return x * y * z


def _validated(df: DataFrame, n: int) -> DataFrame:
    """A row is valid only when all of its components are finite."""
    valid = is_finite(F.col("v0"))
    for v in components(n)[1:]:
        valid = valid & is_finite(F.col(v))
    return df.withColumn("valid", valid)


# ------------------------------------------------------------------- assembly


def assemble(sampled: DataFrame, policy: str, n: int = 1, keys: Sequence[str] = ("sample_id", "field")) -> DataFrame:
    """One value per key and grid cell out of several blocks.

    ``sampled``: keys, block_id, priority, idx, v0 …, valid. Only cells with a
    valid value come back, with the number of blocks that cover them. Every
    policy is one aggregate with partial combination; no group is collected.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown conflict policy {policy!r}")
    keys, names = list(keys), components(n)
    valid = sampled.filter("valid")
    rank = F.col("priority")
    if policy == "VALIDITY_PRIORITY":
        # All blocks share one grid, so the valid count ranks like the fraction.
        hits = valid.groupBy(*keys, "block_id").agg(F.count(F.lit(1)).alias("_hits"))
        valid = valid.join(hits, [*keys, "block_id"])
        rank = F.struct((-F.col("_hits")).alias("h"), F.col("priority").alias("p"))
    if policy == "WEIGHTED_BLEND":
        picks = [F.avg(v).alias(v) for v in names]
        return valid.groupBy(*keys, "idx").agg(*picks, F.count(F.lit(1)).alias("overlap"))
    chosen = valid.groupBy(*keys, "idx").agg(
        F.min(F.struct(rank.alias("_r"), *names)).alias("_b"), F.count(F.lit(1)).alias("overlap")
    )
    return chosen.select(*keys, "idx", *[F.col(f"_b.{v}").alias(v) for v in names], "overlap")


def overlaps(assembled: DataFrame, keys: Sequence[str] = ("sample_id", "field")) -> DataFrame:
    """Grid cells that more than one block covers, per key."""
    return assembled.groupBy(*keys).agg(F.count_if(F.col("overlap") > 1).alias("overlapping"))


def check_overlaps(assembled: DataFrame, keys: Sequence[str] = ("sample_id", "field")) -> DataFrame:
    """Keys that break the ERROR_ON_OVERLAP policy."""
    return overlaps(assembled, keys).filter("overlapping > 0")


def fill_and_split(
    assembled: DataFrame, channels: Sequence[str], grid: Grid, fill: float = 0.0, samples: DataFrame | None = None
) -> DataFrame:
    """channel_value(sample_id, channel, idx, value, valid) over the whole grid.

    Cells without a valid source get the declared fill and ``valid = false``.
    Rows of absent cells are generated per sample and removed by an anti join.
    """
    n = len(channels)
    have = assembled.select("sample_id", "idx", *components(n), F.lit(True).alias("valid"))
    wanted = (have if samples is None else samples).select("sample_id").distinct()
    nx, ny, nz = grid.dims
    layers = wanted.select("sample_id", F.explode(F.sequence(F.lit(0), F.lit(nz - 1))).alias("_z"))
    everywhere = layers.select(
        "sample_id", "_z", F.explode(F.sequence(F.lit(0), F.lit(nx * ny - 1))).alias("_i")
    ).select("sample_id", (F.col("_z").cast("bigint") * (nx * ny) + F.col("_i")).alias("idx"))
    full = everywhere.join(have, ["sample_id", "idx"], "left")
    value = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("channel"),
                    F.when(F.col("valid"), F.col(v)).otherwise(F.lit(float(fill))).alias("value"),
                )
                for c, v in zip(channels, components(n))
            ]
        )
    )
    return full.select("sample_id", "idx", F.coalesce("valid", F.lit(False)).alias("valid"), value.alias("c")).select(
        "sample_id", "c.channel", "idx", "c.value", "valid"
    )


# -------------------------------------------------------------------- quality


def field_quality(values: DataFrame, keys: Sequence[str], minimum: float = 0.0, policy: str = "MARK_INVALID") -> DataFrame:
    """Valid fraction per key against the contract: passed is false below it.

    Under ERROR every cell must be valid.
    """
    counts = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if("valid").alias("valid_cells")
    )
    fraction = F.col("valid_cells") / F.col("cells")
    passed = fraction >= minimum
    if policy == "ERROR":
        passed = passed & (F.col("valid_cells") == F.col("cells"))
    return counts.select(*keys, "cells", "valid_cells", fraction.alias("valid_fraction"), passed.alias("passed"))


def finite_fraction(values: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Share of finite entries per array; usable is false when there is none."""
    c = F.col(value)
    return values.groupBy(*keys).agg(
        F.avg(is_finite(c).cast("int")).alias("finite_fraction"), F.bool_or(is_finite(c)).alias("usable")
    )


def is_volumetric(cells: DataFrame) -> DataFrame:
    """Blocks that hold at least one three-dimensional cell."""
    return cells.groupBy("sample_id", "block_id").agg(F.bool_or(F.col("cell_dim") == 3).alias("is_volumetric"))


def inspect_fields(blocks: DataFrame, values: DataFrame, specs: DataFrame) -> DataFrame:
    """Field matches per sample, spec and block with the rule that each breaks.

    ``blocks``: sample_id, block_id, is_volumetric. ``values``: sample_id,
    block_id, field, association, values. ``specs`` (small): source_name,
    expected_components, association, required, volumetric.
    """
    key = ["sample_id", "block_id", "field"]
    finite = F.aggregate(F.col("values"), F.lit(0), lambda a, x: a + is_finite(x).cast("int"))
    arrays = values.groupBy(*key, "association").agg(
        F.count(F.lit(1)).alias("entries"),
        F.max(F.size("values")).alias("n_components"),
        (F.sum(finite) / F.sum(F.size("values"))).alias("finite_fraction"),
    )
    wide = arrays.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_associations"),
        *[
            F.max(
                F.when(
                    F.col("association") == a,
                    F.struct("association", "entries", "n_components", "finite_fraction"),
                )
            ).alias(f"_{a}")
            for a in ("POINT", "CELL")
        ],
    )
    spec = specs.select(
        F.col("source_name").alias("field"),
        F.col("association").alias("preferred"),
        "expected_components",
    )
    joined = wide.join(F.broadcast(spec), "field").join(
        blocks.select("sample_id", "block_id", "is_volumetric"), ["sample_id", "block_id"]
    )
    chosen = (
        F.when((F.col("preferred") == "CELL") & F.col("_CELL").isNotNull(), F.col("_CELL"))
        .when(F.col("_POINT").isNotNull(), F.col("_POINT"))
        .otherwise(F.col("_CELL"))
    )
    problem = (
        F.when(
            (F.col("n_associations") > 1) & F.col("preferred").isNull(), F.lit("ambiguous association")
        )
        .when(F.col("_a.n_components") != F.col("expected_components"), F.lit("wrong component count"))
        .when(F.col("_a.finite_fraction") == 0.0, F.lit("no finite values"))
    )
    return joined.withColumn("_a", chosen).select(
        *key, "_a.association", "_a.entries", "_a.n_components", "_a.finite_fraction",
        "is_volumetric", problem.alias("problem"),
    )


def missing_required(samples: DataFrame, report: DataFrame, specs: DataFrame) -> DataFrame:
    """Required fields that a sample lacks, or has only on surface blocks."""
    names = specs.filter("required").select(F.col("source_name").alias("field"), "volumetric").collect()
    wanted = samples.select(
        "sample_id",
        F.inline(
            F.array(
                *[F.struct(F.lit(r["field"]).alias("field"), F.lit(r["volumetric"]).alias("volumetric")) for r in names]
            )
        ),
    )
    found = report.groupBy("sample_id", "field").agg(F.bool_or("is_volumetric").alias("_vol"))
    joined = wanted.join(found, ["sample_id", "field"], "left")
    problem = F.when(F.col("_vol").isNull(), F.lit("required field is absent")).when(
        F.col("volumetric") & ~F.col("_vol"), F.lit("only on non-volumetric blocks")
    )
    return joined.select("sample_id", "field", problem.alias("problem")).filter("problem is not null")


def block_summary(cells: DataFrame, points: DataFrame, values: DataFrame) -> DataFrame:
    """Counts, bounds and sorted array names per block."""
    key = ["sample_id", "block_id"]
    n_cells = cells.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_cells"), F.bool_or(F.col("cell_dim") == 3).alias("is_volumetric")
    )
    n_points = points.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_points"),
        *[f(a).alias(f"{a}{n}") for a in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))],
    )

    def arrays(association: str) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("association") == association, F.col("field"))))

    names = values.groupBy(*key).agg(
        arrays("POINT").alias("point_arrays"), arrays("CELL").alias("cell_arrays")
    )
    return n_cells.join(n_points, key, "left").join(names, key, "left")
