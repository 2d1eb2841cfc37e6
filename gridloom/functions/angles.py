"""Wind directions, rotations and the domain box around a rotated geometry."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Offset of the geometry to north, face order for ties.
GEOMETRY_OFFSET_DEG = 25
FACE_NORMALS = (
    ("x_min_face_mask", -1.0, 0.0),
    ("x_max_face_mask", 1.0, 0.0),
    ("y_min_face_mask", 0.0, -1.0),
    ("y_max_face_mask", 0.0, 1.0),
)
ZERO_DIRECTIONS = {
    "positive_x": 0.0,
    "positive_y": math.pi / 2.0,
    "negative_x": math.pi,
    "negative_y": -math.pi / 2.0,
}


def _wrap(degrees: Column) -> Column:
    # Adding zero takes the sign off a negative zero.
    return degrees - 360 * F.floor(degrees / 360) + F.lit(0.0)


def wind_direction(c: Column) -> Column:
    """Direction in [0, 360)."""
    return _wrap(c)


def wind_direction_text(c: Column) -> Column:
    """Direction with three decimals; the exact value of the double is rounded, as printf does."""
    return F.call_function("format_number", _wrap(c), F.lit("0.000"))


def geometry_rotation(c: Column) -> Column:
    """Angle by which the geometry turns for a wind direction."""
    return _wrap(c + GEOMETRY_OFFSET_DEG)


def rotate_xy(x: Column, y: Column, degrees: Column) -> Column:
    """Rotated 2-D vector; sine, cosine and result are kept to nine decimals."""
    s = F.round(F.sin(F.radians(degrees)), 9)
    c = F.round(F.cos(F.radians(degrees)), 9)
    return F.struct(
        F.round(c * x - s * y, 9).alias("x"), F.round(s * x + c * y, 9).alias("y")
    )


def toward_unit(
    degrees: Column,
    zero_direction: str = "positive_y",
    rotation: str = "clockwise",
    semantic: str = "from",
) -> Column:
    """Unit vector that points where the flow goes."""
    if zero_direction not in ZERO_DIRECTIONS:
        raise ValueError(f"unsupported zero direction {zero_direction!r}")
    if rotation not in ("clockwise", "counterclockwise"):
        raise ValueError(f"unsupported rotation {rotation!r}")
    if semantic not in ("from", "toward"):
        raise ValueError(f"unsupported semantic {semantic!r}")
    turn = -1.0 if rotation == "clockwise" else 1.0
    sign = -1.0 if semantic == "from" else 1.0
    theta = F.lit(ZERO_DIRECTIONS[zero_direction]) + turn * F.radians(degrees)
    return F.struct((sign * F.cos(theta)).alias("x"), (sign * F.sin(theta)).alias("y"))


def wind_faces(unit: Column) -> Column:
    """Inlet face (least dot product with the normal) and outlet face (greatest)."""

    def ranked(sign: int) -> Column:
        return F.array(
            *[
                F.struct(
                    (sign * (unit["x"] * nx + unit["y"] * ny)).alias("score"),
                    F.lit(order).alias("ord"),
                    F.lit(name).alias("name"),
                )
                for order, (name, nx, ny) in enumerate(FACE_NORMALS)
            ]
        )

    return F.struct(
        F.array_min(ranked(1))["name"].alias("inlet"), F.array_min(ranked(-1))["name"].alias("outlet")
    )


def domain_box(
    cx: Column,
    cy: Column,
    lower_z: Column,
    upper_z: Column,
    height: float = 40.0,
    radius: float = 300.0,
    inlet: float = 10.0,
    outlet: float = 20.0,
    side: float = 5.0,
    top: float = 8.0,
    scale: float = 1.0,
) -> Column:
    """Extents and background cell counts of the flow domain.

    Every extent is rounded to three decimals before the counts use it.
    """
    x_min = F.round(cx - radius - inlet * height, 3)
    x_max = F.round(cx + radius + outlet * height, 3)
    y_min = F.round(cy - radius - side * height, 3)
    y_max = F.round(cy + radius + side * height, 3)
    z_max = F.round(upper_z + top * height, 3)
    spacing = round(scale * height, 3)

    def count(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(1), F.floor((hi - lo) / spacing + 0.999999).cast("int"))

    return F.struct(
        x_min.alias("x_min"),
        x_max.alias("x_max"),
        y_min.alias("y_min"),
        y_max.alias("y_max"),
        lower_z.alias("z_min"),
        z_max.alias("z_max"),
        F.lit(spacing).alias("dx_far"),
        count(x_min, x_max).alias("nx"),
        count(y_min, y_max).alias("ny"),
        count(lower_z, z_max).alias("nz"),
    )
