"""The canonical grid, coordinate maps and rotated geometry."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FACES = ("x_min", "x_max", "y_min", "y_max", "z_min", "z_max")


@dataclass(frozen=True)
class Grid:
    """Cell-centred grid; index law ``idx = (iz * ny + iy) * nx + ix``."""

    origin: tuple[float, float, float]
    spacing: tuple[float, float, float]
    dims: tuple[int, int, int]

    def __post_init__(self) -> None:
        if len(self.origin) != 3 or not all(math.isfinite(v) for v in self.origin):
            raise ValueError("origin needs three finite numbers")
        if len(self.spacing) != 3 or not all(math.isfinite(v) and v > 0 for v in self.spacing):
            raise ValueError("spacing needs three positive numbers")
        if len(self.dims) != 3 or not all(int(v) > 0 for v in self.dims):
            raise ValueError("dims needs three positive integers")

    @property
    def size(self) -> int:
        nx, ny, nz = self.dims
        return nx * ny * nz

    @property
    def bounds(self) -> tuple[float, ...]:
        """(x_lo, x_hi, y_lo, y_hi, z_lo, z_hi), half a cell outside the centres."""
        out: list[float] = []
        for o, d, n in zip(self.origin, self.spacing, self.dims):
            out += [o - 0.5 * d, o + (n - 0.5) * d]
        return tuple(out)

    def ix(self, idx: Column) -> Column:
        return (idx % self.dims[0]).cast("int")

    def iy(self, idx: Column) -> Column:
        return (F.floor(idx / self.dims[0]) % self.dims[1]).cast("int")

    def iz(self, idx: Column) -> Column:
        return F.floor(idx / (self.dims[0] * self.dims[1])).cast("int")

    def index(self, ix: Column, iy: Column, iz: Column) -> Column:
        return (iz.cast("bigint") * self.dims[1] + iy) * self.dims[0] + ix

    def centre(self, axis: int, i: Column) -> Column:
        return F.lit(float(self.origin[axis])) + i * F.lit(float(self.spacing[axis]))

    def axes(self, idx: Column) -> tuple[Column, Column, Column]:
        return self.ix(idx), self.iy(idx), self.iz(idx)


def canonical_grid(spark: SparkSession, grid: Grid, partitions: int | None = None) -> DataFrame:
    """grid_cell(idx, iz, iy, ix, x, y, z), generated where it is used."""
    return with_position(spark.range(0, grid.size, 1, partitions).withColumnRenamed("id", "idx"), grid)


def with_position(df: DataFrame, grid: Grid) -> DataFrame:
    """Add iz, iy, ix and the cell centre to rows that have ``idx``."""
    ix, iy, iz = grid.axes(F.col("idx"))
    placed = df.withColumns({"iz": iz, "iy": iy, "ix": ix})
    return placed.withColumns(
        {a: grid.centre(n, F.col(f"i{a}")) for n, a in enumerate("xyz")}
    )


def face_column(grid: Grid, face: str, idx: Column) -> Column:
    """Is the cell on the named grid face?"""
    if face not in FACES:
        raise ValueError(f"unknown face {face!r}")
    axis = "xyz".index(face[0])
    i = grid.axes(idx)[axis]
    return i == (0 if face.endswith("min") else grid.dims[axis] - 1)


def face_masks(df: DataFrame, grid: Grid) -> DataFrame:
    return df.withColumns({f"{f}_face_mask": face_column(grid, f, F.col("idx")) for f in FACES})


@dataclass(frozen=True)
class CoordinateMap:
    """``p -> R (s p) + t`` with a proper rotation R and a positive scale s."""

    scale: float = 1.0
    rotation: tuple[tuple[float, float, float], ...] = ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))
    translation: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __post_init__(self) -> None:
        r = self.rotation
        if len(r) != 3 or any(len(row) != 3 for row in r):
            raise ValueError("rotation must be 3 x 3")
        error = max(
            abs(sum(r[i][k] * r[j][k] for k in range(3)) - (i == j)) for i in range(3) for j in range(3)
        )
        det = sum(
            r[0][i] * (r[1][(i + 1) % 3] * r[2][(i + 2) % 3] - r[1][(i + 2) % 3] * r[2][(i + 1) % 3])
            for i in range(3)
        )
        if not error <= 1e-6 or abs(det - 1.0) > 1e-6:
            raise ValueError("rotation must be proper and orthonormal")
        if not (math.isfinite(self.scale) and self.scale > 0):
            raise ValueError("scale must be positive")
        if len(self.translation) != 3:
            raise ValueError("translation needs three numbers")

    @property
    def axis_aligned(self) -> bool:
        """Whether the rotation only swaps or flips axes."""
        return all(min(abs(v), abs(abs(v) - 1.0)) <= 1e-6 for row in self.rotation for v in row)


def _rotated(rotation: Sequence[Sequence[float]], v: Sequence[Column]) -> list[Column]:
    return [row[0] * v[0] + row[1] * v[1] + row[2] * v[2] for row in rotation]


def map_points(df: DataFrame, m: CoordinateMap, xyz: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    scaled = [F.col(c) * m.scale for c in xyz]
    moved = [r + t for r, t in zip(_rotated(m.rotation, scaled), m.translation)]
    return df.withColumns(dict(zip(xyz, moved)))


def unmap_point(m: CoordinateMap, xyz: Sequence[Column]) -> list[Column]:
    """Source coordinates of a target point: the rotation's transpose undoes it."""
    moved = [c - t for c, t in zip(xyz, m.translation)]
    columns = list(zip(*m.rotation))
    return [v / m.scale for v in _rotated(columns, moved)]


def map_bounds(df: DataFrame, m: CoordinateMap) -> DataFrame:
    """Smallest target boxes (xlo … zhi) around the mapped boxes of ``df``.

    The middle of a box is mapped; its half widths add up by the absolute
    entries of the rotation.
    """
    middle = [(F.col(f"{a}lo") + F.col(f"{a}hi")) / 2 * m.scale for a in "xyz"]
    half = [(F.col(f"{a}hi") - F.col(f"{a}lo")) / 2 * m.scale for a in "xyz"]
    centre = [c + t for c, t in zip(_rotated(m.rotation, middle), m.translation)]
    wide = _rotated([[abs(v) for v in row] for row in m.rotation], half)
    return df.withColumns(
        {f"{a}{side}": (c - w if side == "lo" else c + w) for a, c, w in zip("xyz", centre, wide) for side in ("lo", "hi")}
    )


def map_vectors(
    df: DataFrame, m: CoordinateMap, value_scale: float, uvw: Sequence[str], rotate: bool = True
) -> DataFrame:
    """Vectors are scaled, then rotated, never moved."""
    scaled = [F.col(c) * value_scale for c in uvw]
    return df.withColumns(dict(zip(uvw, _rotated(m.rotation, scaled) if rotate else scaled)))


def convert_units(value: Column, scale: float = 1.0, offset: float = 0.0) -> Column:
    return value * scale + offset


def bbox(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bounding box per key of points (x, y, z)."""
    return df.groupBy(*by).agg(
        *[f(a).alias(f"{a}{n}") for a in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))]
    )


def union_bounds(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union of block bounds (xmin … zmax) per key."""
    return blocks.groupBy(*by).agg(
        *[F.min(f"{a}min").alias(f"{a}min") for a in "xyz"],
        *[F.max(f"{a}max").alias(f"{a}max") for a in "xyz"],
    )


def place_surfaces(cases: DataFrame, surfaces: Sequence[str]) -> DataFrame:
    """Placements (case_id, angle, surface): every case uses the named surfaces."""
    names = F.array(*[F.lit(s) for s in surfaces])
    return cases.select("case_id", "angle", F.explode(names).alias("surface"))


def surface_placements(facets: DataFrame, placements: DataFrame, base_surface: str) -> DataFrame:
    """``placements`` with the centre (cx, cy) of the base surface's box: all that a case has to keep.

    One short row for each case and surface, however many facets a surface has.
    """
    box = bbox(facets.filter(F.col("surface") == base_surface), ["surface"]).first()
    if box is None:
        raise ValueError(f"no facets of the base surface {base_surface!r}")
    cx, cy = (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2
    return placements.select("case_id", "angle", "surface", F.lit(cx).alias("cx"), F.lit(cy).alias("cy"))


def placed_facets(facets: DataFrame, kept: DataFrame, splits: int = 8) -> DataFrame:
    """A view of the facets as the cases have them: (case_id, surface, facet_id, vertex_no, x, y, z).

    ``kept`` is what ``surface_placements`` gives. A filter on case or surface
    reaches both tables before they meet. There are few surfaces, so a surface
    is cut in ``splits`` parts and each placement meets all of them.
    """
    parts = facets.withColumn("_part", F.pmod(F.col("facet_id"), F.lit(splits)).cast("int"))
    wanted = kept.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    a = F.radians("angle")
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    return parts.join(wanted, ["surface", "_part"]).select(
        "case_id",
        "surface",
        "facet_id",
        "vertex_no",
        (F.col("cx") + F.cos(a) * dx - F.sin(a) * dy).alias("x"),
        (F.col("cy") + F.sin(a) * dx + F.cos(a) * dy).alias("y"),
        "z",
    )


def rotate_surfaces(
    facets: DataFrame, placements: DataFrame, base_surface: str, splits: int = 8
) -> DataFrame:
    """Every case's copy of its surfaces, turned about the base surface's centre.

    ``facets``: surface, facet_id, vertex_no, x, y, z. ``placements``: case_id,
    angle (degrees), surface.
    """
    return placed_facets(facets, surface_placements(facets, placements, base_surface), splits)


def parse_grid(contract: Mapping) -> Grid:
    """Grid of a contract document."""
    physical = contract["grid"]["physical_grid"]
    return Grid(
        tuple(float(v) for v in physical["cell_center_origin_xyz"]),
        tuple(float(v) for v in physical["spacing_xyz"]),
        tuple(int(v) for v in physical["dimensions_xyz"]),
    )


def parse_coordinate_map(contract: Mapping) -> CoordinateMap:
    coord = contract.get("coordinate_map", {})
    default = CoordinateMap()
    return CoordinateMap(
        float(coord.get("length_scale", 1.0)),
        tuple(tuple(float(v) for v in row) for row in coord.get("rotation_source_to_target", default.rotation)),
        tuple(float(v) for v in coord.get("translation_target_xyz", default.translation)),
    )
