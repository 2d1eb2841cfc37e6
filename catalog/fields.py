"""Grids, resampling, assembly, masks and distances.

``orders`` is read as gridded field data: 1,500 consecutive orders are the
cells of one sample, so the number of samples grows with the table.
"""

import math

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.operators import grid as grids
from gridloom.operators import masks as m
from gridloom.operators import resample as rs
from gridloom.operators.order import small_table
from gridloom.session import cut_lineage

GRID = grids.Grid((-10.0, 5.0, 0.0), (2.0, 1.5, 1.0), (15, 10, 10))

CELLS_SQL = """
    SELECT cast(o_orderkey // 1500 AS varchar) AS sample_id, o_orderkey % 1500 AS idx, (o_orderkey % 15)::int AS ix,
           ((o_orderkey % 1500) // 15 % 10)::int AS iy, ((o_orderkey % 1500) // 150)::int AS iz,
           -10.0::double + (o_orderkey % 15) * 2.0::double AS x, 5.0::double + ((o_orderkey % 1500) // 15 % 10) * 1.5::double AS y,
           0.0::double + ((o_orderkey % 1500) // 150) * 1.0::double AS z,
           o_orderstatus <> 'P' AS valid, o_totalprice AS value, (o_custkey % 50) / 4 AS wall, o_orderpriority <> '5-LOW' AS wall_valid,
           o_orderpriority <> '1-URGENT' AS valid_u, o_custkey AS custkey
    FROM orders
"""


def field_cells(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.floor(key / 1500).cast("string").alias("sample_id"),
        (key % 1500).alias("idx"),
        (F.col("o_orderstatus") != "P").alias("valid"),
        F.col("o_totalprice").alias("value"),
        ((F.col("o_custkey") % 50) / 4).alias("wall"),
        (F.col("o_orderpriority") != "5-LOW").alias("wall_valid"),
        (F.col("o_orderpriority") != "1-URGENT").alias("valid_u"),
        F.col("o_custkey").alias("custkey"),
    )


@query(f"WITH c AS ({CELLS_SQL}) SELECT sample_id, idx, iz, iy, ix, x, y, z FROM c")
def grid_positions(spark, sf):
    cells = field_cells(spark, sf).select("sample_id", "idx")
    return grids.with_position(cells, GRID)


@query(
    f"""
    WITH c AS ({CELLS_SQL})
    SELECT sample_id, min(x) - 1.0 AS x_lo, max(x) + 1.0 AS x_hi, min(y) - 0.75 AS y_lo, max(y) + 0.75 AS y_hi,
           min(z) - 0.5 AS z_lo, max(z) + 0.5 AS z_hi, count(*) AS cells FROM c GROUP BY sample_id
    """
)
def grid_extent(spark, sf):
    """Every sample fills the bounds of the grid."""
    names = ("x_lo", "x_hi", "y_lo", "y_hi", "z_lo", "z_hi")
    return (
        field_cells(spark, sf)
        .groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("cells"))
        .select("*", *[F.lit(v).alias(n) for n, v in zip(names, GRID.bounds)])
    )


MAP = grids.CoordinateMap(2.0, ((0.6, -0.8, 0.0), (0.8, 0.6, 0.0), (0.0, 0.0, 1.0)), (1.0, -2.0, 0.5))


def points(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", *[e[i].cast("double").alias(a) for i, a in enumerate("xyz")],
        *[e[i + 3].cast("double").alias(f"u{a}") for i, a in enumerate("xyz")], e[6].cast("double").alias("p"),
    )


@query(
    """
    WITH s AS (SELECT vec_id, embedding[1]::double * 2.0 AS x, embedding[2]::double * 2.0 AS y, embedding[3]::double * 2.0 AS z,
                 embedding[4]::double * 3.0 AS ux, embedding[5]::double * 3.0 AS uy, embedding[6]::double * 3.0 AS uz, embedding[7]::double AS p FROM embeddings)
    SELECT vec_id, round(0.6 * x - 0.8 * y + 1.0, 9) AS x, round(0.8 * x + 0.6 * y - 2.0, 9) AS y, round(z + 0.5, 9) AS z,
           round(0.6 * ux - 0.8 * uy, 9) AS ux, round(0.8 * ux + 0.6 * uy, 9) AS uy, round(uz, 9) AS uz, round(p * 10.0 + 1.0, 9) AS p
    FROM s
    """
)
def mapped_points(spark, sf):
    moved = grids.map_points(points(spark, sf), MAP)
    turned = grids.map_vectors(moved, MAP, 3.0, ("ux", "uy", "uz"))
    scaled = turned.withColumn("p", grids.convert_units(F.col("p"), 10.0, 1.0))
    return scaled.select("vec_id", *[F.round(c, 9).alias(c) for c in ("x", "y", "z", "ux", "uy", "uz", "p")])


@query(
    """
    SELECT label, min(embedding[1])::double AS xmin, max(embedding[1])::double AS xmax, min(embedding[2])::double AS ymin,
           max(embedding[2])::double AS ymax, min(embedding[3])::double AS zmin, max(embedding[3])::double AS zmax FROM embeddings GROUP BY label
    """
)
def surface_bounds(spark, sf):
    return grids.bbox(points(spark, sf), ["label"])


@query(
    """
    WITH f AS (SELECT 's' || label AS surface, vec_id AS facet_id, embedding[1]::double AS x, embedding[2]::double AS y, embedding[3]::double AS z FROM embeddings),
    c AS (SELECT (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy FROM f WHERE surface = 's0'),
    n AS (SELECT n_name AS case_id, radians((n_nationkey * 17 + 25) % 360) AS a FROM nation)
    SELECT case_id, surface, facet_id, 0 AS vertex_no, round(cx + cos(a) * (x - cx) - sin(a) * (y - cy), 9) AS x,
           round(cy + sin(a) * (x - cx) + cos(a) * (y - cy), 9) AS y, z FROM f, c, n
    """
)
def rotated_surfaces(spark, sf):
    facets = points(spark, sf).select(
        F.concat(F.lit("s"), F.col("label").cast("string")).alias("surface"), F.col("vec_id").alias("facet_id"),
        F.lit(0).alias("vertex_no"), "x", "y", "z",
    )
    cases = table(spark, sf, "nation").select(
        F.col("n_name").alias("case_id"), ((F.col("n_nationkey") * 17 + 25) % 360).cast("double").alias("angle")
    )
    placed = grids.place_surfaces(cases, [f"s{i}" for i in range(10)])
    turned = grids.rotate_surfaces(facets, placed, "s0")
    return turned.withColumns({"x": F.round("x", 9), "y": F.round("y", 9)})


@query(
    """
    WITH f AS (SELECT 's' || label AS surface, vec_id AS facet_id, embedding[1]::double AS x, embedding[2]::double AS y, embedding[3]::double AS z FROM embeddings),
    c AS (SELECT (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy FROM f WHERE surface = 's0'),
    n AS (SELECT n_name AS case_id, ((n_nationkey * 17 + 25) % 360)::double AS angle FROM nation),
    k AS (SELECT case_id, angle, surface, cx, cy FROM n, (SELECT DISTINCT surface FROM f WHERE surface IS NOT NULL) s, c WHERE substr(surface, 2)::int % 5 <> angle % 5),
    p AS (SELECT k.*, cx + cos(radians(angle)) * (x - cx) - sin(radians(angle)) * (y - cy) AS px, cy + sin(radians(angle)) * (x - cx) + cos(radians(angle)) * (y - cy) AS py, z
          FROM k JOIN f USING (surface))
    SELECT case_id, surface, angle, round(cx, 6) AS cx, round(cy, 6) AS cy, count(*) AS facets, round(min(px), 6) AS xmin, round(max(px), 6) AS xmax,
           round(min(py), 6) AS ymin, round(max(py), 6) AS ymax, min(z) AS zmin, max(z) AS zmax FROM p GROUP BY case_id, surface, angle, cx, cy
    """
)
def placed_surfaces(spark, sf):
    """Cases keep a row for each surface they use; the facets are placed when they are read, here for their bounds."""
    facets = points(spark, sf).where("label IS NOT NULL").select(
        F.concat(F.lit("s"), F.col("label").cast("string")).alias("surface"), F.col("vec_id").alias("facet_id"),
        F.lit(0).alias("vertex_no"), "x", "y", "z",
    )
    cases = table(spark, sf, "nation").select(
        F.col("n_name").alias("case_id"), ((F.col("n_nationkey") * 17 + 25) % 360).cast("double").alias("angle")
    )
    used = grids.place_surfaces(cases, [f"s{i}" for i in range(10)])
    used = used.where(F.substring("surface", 2, 9).cast("int") % 5 != F.col("angle") % 5)
    kept = cut_lineage(grids.surface_placements(facets, used, "s0"))
    bounds = grids.bbox(grids.placed_facets(facets, kept), ["case_id", "surface"])
    counts = facets.groupBy("surface").agg(F.count(F.lit(1)).alias("facets"))
    found = kept.join(bounds, ["case_id", "surface"]).join(counts, "surface")
    return found.withColumns({c: F.round(c, 6) for c in ("cx", "cy", "xmin", "xmax", "ymin", "ymax")})


# ------------------------------------------------------------------- assembly

SAMPLED_SQL = """
    SELECT 's' || (l_suppkey % 3) AS sample_id, CASE l_linestatus WHEN 'F' THEN 'p' ELSE 'T' END AS field, l_linenumber AS block_id,
           l_linenumber * 3 % 8 AS priority, l_partkey AS idx, l_quantity AS v0, l_discount > 0.03 AS valid FROM lineitem
"""


def sampled(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("s"), (F.col("l_suppkey") % 3).cast("string")).alias("sample_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("p")).otherwise(F.lit("T")).alias("field"),
        F.col("l_linenumber").alias("block_id"),
        (F.col("l_linenumber") * 3 % 8).alias("priority"),
        F.col("l_partkey").alias("idx"),
        F.col("l_quantity").alias("v0"),
        (F.col("l_discount") > 0.03).alias("valid"),
    )


@query(
    f"""
    WITH s AS ({SAMPLED_SQL})
    SELECT sample_id, field, idx, first(v0 ORDER BY priority, v0) AS v0, count(*) AS overlap FROM s WHERE valid GROUP BY ALL
    """
)
def region_priority(spark, sf):
    return rs.assemble(sampled(spark, sf), "REGION_PRIORITY")


@query(
    f"""
    WITH s AS ({SAMPLED_SQL}), h AS (SELECT sample_id, field, block_id, count(*) AS hits FROM s WHERE valid GROUP BY ALL)
    SELECT sample_id, field, idx, first(v0 ORDER BY hits DESC, priority, v0) AS v0, count(*) AS overlap
    FROM s JOIN h USING (sample_id, field, block_id) WHERE valid GROUP BY ALL
    """
)
def validity_priority(spark, sf):
    return rs.assemble(sampled(spark, sf), "VALIDITY_PRIORITY")


@query(
    f"""
    WITH s AS ({SAMPLED_SQL}) SELECT sample_id, field, idx, avg(v0) AS v0, count(*) AS overlap FROM s WHERE valid GROUP BY ALL
    """
)
def weighted_blend(spark, sf):
    return rs.assemble(sampled(spark, sf), "WEIGHTED_BLEND")


@query(
    f"""
    WITH s AS ({SAMPLED_SQL}), a AS (SELECT sample_id, field, idx, count(*) AS n FROM s WHERE valid GROUP BY ALL)
    SELECT sample_id, field, count(*) FILTER (n > 1) AS overlapping FROM a GROUP BY ALL HAVING count(*) FILTER (n > 1) > 0
    """
)
def overlap_violations(spark, sf):
    return rs.check_overlaps(rs.assemble(sampled(spark, sf), "ERROR_ON_OVERLAP"))


@query(
    f"""
    WITH c AS ({CELLS_SQL}), u AS (SELECT sample_id, idx, valid, unnest([{{'c': 'Ux', 'v': value}}, {{'c': 'Uy', 'v': wall}}]) AS e FROM c)
    SELECT sample_id, e.c AS channel, idx, CASE WHEN valid THEN e.v ELSE -1.0 END AS value, valid FROM u
    """
)
def filled_channels(spark, sf):
    """Invalid cells are absent before; the fill brings the whole grid back."""
    known = field_cells(spark, sf).filter("valid").select(
        "sample_id", "idx", F.col("value").alias("v0"), F.col("wall").alias("v1")
    )
    return rs.fill_and_split(known, ["Ux", "Uy"], GRID, fill=-1.0)


@query(
    f"""
    WITH c AS ({CELLS_SQL}), g AS (SELECT sample_id, count(*) AS cells, count(*) FILTER (valid) AS valid_cells FROM c GROUP BY ALL)
    SELECT *, valid_cells / cells AS valid_fraction, valid_cells / cells >= 0.66 AS passed FROM g
    """
)
def valid_fractions(spark, sf):
    return rs.field_quality(field_cells(spark, sf), ["sample_id"], minimum=0.66)


@query(
    """
    SELECT l_suppkey, avg(CASE WHEN l_discount = 0 THEN 0 ELSE 1 END) AS finite_fraction, bool_or(l_discount <> 0) AS usable
    FROM lineitem GROUP BY l_suppkey
    """
)
def finite_fractions(spark, sf):
    value = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    rows = table(spark, sf, "lineitem").select("l_suppkey", value.alias("value"))
    return rs.finite_fraction(rows, ["l_suppkey"])


# ----------------------------------------------------------------- resampling

# A box mesh per sample: 15 x 10 x 10 cells of 3 x 2 x 2.5, one order each.
TARGET = grids.Grid((0.75, 0.5, 0.25), (2.0, 1.5, 2.0), (23, 14, 13))
MESH_SQL = f"""
    WITH oc AS ({CELLS_SQL}),
    cells AS (SELECT sample_id, 0 AS block_id, idx AS cell_id, ix, iy, iz, 3.0 * ix AS xlo, 3.0 * (ix + 1) AS xhi, 2.0 * iy AS ylo, 2.0 * (iy + 1) AS yhi,
                2.5 * iz AS zlo, 2.5 * (iz + 1) AS zhi, custkey::double AS v,
                list_transform(range(0, 8), lambda c: ((iz + c // 4) * 11 + iy + c // 2 % 2) * 16 + ix + c % 2) AS point_ids FROM oc),
    pts AS (SELECT sample_id, p AS point_id, avg(v) AS v FROM (SELECT sample_id, v, unnest(point_ids) AS p FROM cells) GROUP BY ALL)
"""
HITS_SQL = """
    hits AS (SELECT sample_id, cell_id, xlo, xhi, ylo, yhi, zlo, zhi, ix AS cx, iy AS cy, iz AS cz, v, gx, gy, gz, (gz * 14 + gy) * 23 + gx AS idx FROM
       (SELECT *, unnest(range(0, 13)) AS gz FROM (SELECT * FROM (SELECT *, unnest(range(0, 14)) AS gy FROM
          (SELECT * FROM (SELECT *, unnest(range(0, 23)) AS gx FROM cells) WHERE 0.75 + gx * 2.0 BETWEEN xlo AND xhi))
        WHERE 0.5 + gy * 1.5 BETWEEN ylo AND yhi)) WHERE 0.25 + gz * 2.0 BETWEEN zlo AND zhi)
"""


def mesh(spark, sf):
    """Cells, points and cell values of the box meshes."""
    cells = grids.with_position(field_cells(spark, sf), GRID).drop("x", "y", "z")
    corner = lambda c: (
        ((F.col("iz") + (c // 4)) * 11 + F.col("iy") + (c // 2 % 2)) * 16 + F.col("ix") + (c % 2)
    ).cast("bigint")
    bounds = {}
    for a, size in (("x", 3.0), ("y", 2.0), ("z", 2.5)):
        bounds[f"{a}lo"] = F.col(f"i{a}") * size
        bounds[f"{a}hi"] = (F.col(f"i{a}") + 1) * size
    boxes = cells.select(
        "sample_id", F.lit(0).alias("block_id"), F.col("idx").alias("cell_id"), F.lit(3).alias("cell_dim"),
        *[v.alias(k) for k, v in bounds.items()], F.array(*[corner(c) for c in range(8)]).alias("point_ids"),
        F.col("custkey").cast("double").alias("v0"),
    )
    used = boxes.select("sample_id", "block_id", F.explode("point_ids").alias("point_id")).distinct()
    pts = used.select(
        "*",
        ((F.col("point_id") % 16) * 3.0).alias("x"),
        ((F.floor(F.col("point_id") / 16) % 11) * 2.0).alias("y"),
        (F.floor(F.col("point_id") / 176) * 2.5).alias("z"),
    )
    return boxes.drop("v0"), pts, boxes.select("sample_id", "block_id", "cell_id", "v0")


@query(f"{MESH_SQL}, {HITS_SQL} SELECT sample_id, 0 AS block_id, cell_id, gz AS iz, gy AS iy, gx AS ix, idx FROM hits")
def located_cells(spark, sf):
    cells, _, _ = mesh(spark, sf)
    return rs.locate(cells, TARGET)


@query(
    f"""
    {MESH_SQL}, {HITS_SQL} SELECT sample_id, 0 AS block_id, idx, arg_min(v, cell_id) AS v0, true AS valid FROM hits GROUP BY ALL
    """
)
def nearest_values(spark, sf):
    cells, _, values = mesh(spark, sf)
    return rs.resample_nearest(cells, values, TARGET)


@query(f"{MESH_SQL} SELECT sample_id, 0 AS block_id, point_id, v AS v0 FROM pts")
def point_means(spark, sf):
    cells, _, values = mesh(spark, sf)
    return rs.cell_to_point(cells, values)


CATEGORY_SQL = """
    cat AS (SELECT sample_id, point_id, floor(v) % 3 AS k FROM pts),
    used AS (SELECT c.sample_id, c.cell_id, k, count(*) AS n FROM (SELECT sample_id, cell_id, unnest(point_ids) AS point_id FROM cells) c
             JOIN cat USING (sample_id, point_id) GROUP BY ALL)
"""


@query(
    f"{MESH_SQL}, {CATEGORY_SQL} SELECT sample_id, 0 AS block_id, cell_id, first(k ORDER BY n DESC, k)::double AS v0 FROM used GROUP BY sample_id, cell_id"
)
def cell_majority(spark, sf):
    cells, _, values = mesh(spark, sf)
    at = rs.cell_to_point(cells, values).withColumn("v0", (F.floor("v0") % 3).cast("double"))
    return rs.point_to_cell(cells, at, kind="categorical")


@query(
    f"""
    {MESH_SQL}, w AS (SELECT sample_id, point_id, floor(v) AS v FROM pts)
    SELECT c.sample_id, 0 AS block_id, cell_id, sum(w.v) / count(*) AS v0
    FROM (SELECT sample_id, cell_id, unnest(point_ids) AS point_id FROM cells) c JOIN w USING (sample_id, point_id) GROUP BY ALL
    """
)
def cell_means(spark, sf):
    cells, _, values = mesh(spark, sf)
    at = rs.cell_to_point(cells, values).withColumn("v0", F.floor("v0").cast("double"))
    return rs.point_to_cell(cells, at)


@query(
    f"""
    {MESH_SQL}, {HITS_SQL},
    best AS (SELECT sample_id, idx, min(cell_id) AS cell_id FROM hits GROUP BY ALL),
    b AS (SELECT h.*, (0.75 + gx * 2.0 - xlo) / 3.0 AS tx, (0.5 + gy * 1.5 - ylo) / 2.0 AS ty, (0.25 + gz * 2.0 - zlo) / 2.5 AS tz
          FROM hits h JOIN best USING (sample_id, idx, cell_id)),
    c AS (SELECT *, unnest(range(0, 8)) AS c FROM b),
    k AS (SELECT c.*, pts.v AS pv FROM c JOIN pts ON pts.sample_id = c.sample_id
            AND pts.point_id = ((cz + c.c // 4) * 11 + cy + c.c // 2 % 2) * 16 + cx + c.c % 2)
    SELECT sample_id, 0 AS block_id, idx, round(sum(pv * (CASE WHEN c % 2 = 1 THEN tx ELSE 1 - tx END) * (CASE WHEN c // 2 % 2 = 1 THEN ty ELSE 1 - ty END)
           * (CASE WHEN c // 4 = 1 THEN tz ELSE 1 - tz END)), 9) AS v0, true AS valid FROM k GROUP BY sample_id, idx
    """
)
def linear_values(spark, sf):
    cells, pts, values = mesh(spark, sf)
    at = rs.cell_to_point(cells, values)
    return rs.resample_linear(cells, pts, at, TARGET).withColumn("v0", F.round("v0", 9))


# A map that no swap of axes gives: a turn by 20 degrees about x, then by 30 about z, scaled and moved.
_A, _B = math.radians(20.0), math.radians(30.0)
TURN = grids.CoordinateMap(
    1.2,
    (
        (math.cos(_B), -math.sin(_B) * math.cos(_A), math.sin(_B) * math.sin(_A)),
        (math.sin(_B), math.cos(_B) * math.cos(_A), -math.cos(_B) * math.sin(_A)),
        (0.0, math.sin(_A), math.cos(_A)),
    ),
    (10.0, -6.5, -2.0),
)


def _source_sql(axis: int) -> str:
    r, t = TURN.rotation, TURN.translation
    moved = ("(0.75 + gx * 2.0", "(0.5 + gy * 1.5", "(0.25 + gz * 2.0")
    parts = [f"({r[k][axis]!r})::double * {moved[k]} - ({t[k]!r})::double)" for k in range(3)]
    return f"({' + '.join(parts)}) / {TURN.scale!r}::double"


# Grid centres taken back to the source, and the box of the mesh that holds each (of two that share a face, the first).
TURNED_SQL = f"""
    spots AS (SELECT *, (gz * 14 + gy) * 23 + gx AS idx, {_source_sql(0)} AS sx, {_source_sql(1)} AS sy, {_source_sql(2)} AS sz
       FROM (SELECT unnest(range(0, 23)) AS gx), (SELECT unnest(range(0, 14)) AS gy), (SELECT unnest(range(0, 13)) AS gz)),
    near AS (SELECT idx, sx, sy, sz, floor(sx / 3.0)::int - dx AS ix, floor(sy / 2.0)::int - dy AS iy, floor(sz / 2.5)::int - dz AS iz
       FROM spots, (SELECT unnest(range(0, 2)) AS dx), (SELECT unnest(range(0, 2)) AS dy), (SELECT unnest(range(0, 2)) AS dz)),
    held AS (SELECT c.*, idx, sx, sy, sz FROM near n JOIN cells c USING (ix, iy, iz)
       WHERE sx BETWEEN xlo AND xhi AND sy BETWEEN ylo AND yhi AND sz BETWEEN zlo AND zhi
       QUALIFY row_number() OVER (PARTITION BY sample_id, idx ORDER BY cell_id) = 1)
"""


@query(f"{MESH_SQL}, {TURNED_SQL} SELECT sample_id, 0 AS block_id, idx, v AS v0, true AS valid FROM held")
def turned_nearest_values(spark, sf):
    """The grid's centres in meshes that are turned against it."""
    cells, _, values = mesh(spark, sf)
    return rs.resample_nearest(cells, values, TARGET, cmap=TURN)


@query(
    f"""
    {MESH_SQL}, {TURNED_SQL},
    b AS (SELECT *, (sx - xlo) / 3.0 AS tx, (sy - ylo) / 2.0 AS ty, (sz - zlo) / 2.5 AS tz, unnest(range(0, 8)) AS c FROM held),
    k AS (SELECT b.*, pts.v AS pv FROM b JOIN pts ON pts.sample_id = b.sample_id
            AND pts.point_id = ((iz + c // 4) * 11 + iy + c // 2 % 2) * 16 + ix + c % 2)
    SELECT sample_id, 0 AS block_id, idx, round(sum(pv * (CASE WHEN c % 2 = 1 THEN tx ELSE 1 - tx END) * (CASE WHEN c // 2 % 2 = 1 THEN ty ELSE 1 - ty END)
           * (CASE WHEN c // 4 = 1 THEN tz ELSE 1 - tz END)), 6) AS v0, true AS valid FROM k GROUP BY sample_id, idx
    """
)
def turned_linear_values(spark, sf):
    cells, pts, values = mesh(spark, sf)
    at = rs.cell_to_point(cells, values)
    return rs.resample_linear(cells, pts, at, TARGET, cmap=TURN).withColumn("v0", F.round("v0", 6))


# ----------------------------------------------------------------- inspection

VALUES_SQL = """
    SELECT cast(l_suppkey % 20 AS varchar) AS sample_id, l_linenumber AS block_id, (['U', 'p', 'T'])[list_position(['A', 'N', 'R'], l_returnflag)] AS field,
           CASE l_linestatus WHEN 'O' THEN 'CELL' ELSE 'POINT' END AS association, l_discount > 0 AS fin,
           CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 1 ELSE CASE WHEN l_linenumber > 4 THEN 2 ELSE 1 END END AS n FROM lineitem
"""


def field_values(spark, sf):
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    value = F.when(F.col("l_discount") > 0, F.col("l_quantity")).otherwise(F.lit(float("nan")))
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 20).cast("string").alias("sample_id"),
        line.alias("block_id"),
        F.when(flag == "A", F.lit("U")).when(flag == "N", F.lit("p")).otherwise(F.lit("T")).alias("field"),
        F.when(F.col("l_linestatus") == "O", F.lit("CELL")).otherwise(F.lit("POINT")).alias("association"),
        F.when(flag == "A", F.array(value, value, value))
        .when((flag == "R") & (line > 4), F.array(value, value))
        .otherwise(F.array(value))
        .alias("values"),
    )


SPECS = [("U", 3, None, True, True), ("p", 1, "CELL", True, True), ("T", 1, "POINT", False, True), ("k", 1, None, True, True)]
SPEC_SCHEMA = "source_name string, expected_components int, association string, required boolean, volumetric boolean"


def blocks(spark, sf):
    return (
        field_values(spark, sf)
        .select("sample_id", "block_id")
        .distinct()
        .withColumn("is_volumetric", (F.col("block_id") + F.col("sample_id").cast("int")) % 3 != 0)
    )


INSPECT_SQL = f"""
    WITH v AS ({VALUES_SQL}),
    a AS (SELECT sample_id, block_id, field, association, count(*) AS entries, max(n) AS n_components, sum(CASE WHEN fin THEN n ELSE 0 END) / sum(n) AS finite_fraction FROM v GROUP BY ALL),
    w AS (SELECT *, count(*) OVER (PARTITION BY sample_id, block_id, field) AS na,
            row_number() OVER (PARTITION BY sample_id, block_id, field ORDER BY CASE WHEN field = 'p' AND association = 'CELL' THEN 0 WHEN association = 'POINT' THEN 1 ELSE 2 END) AS pick FROM a)
"""


@query(
    f"""
    {INSPECT_SQL}
    SELECT sample_id, block_id, field, association, entries, n_components, finite_fraction, (block_id + sample_id::int) % 3 <> 0 AS is_volumetric,
           CASE WHEN na > 1 AND field = 'U' THEN 'ambiguous association' WHEN n_components <> CASE field WHEN 'U' THEN 3 ELSE 1 END THEN 'wrong component count'
                WHEN finite_fraction = 0 THEN 'no finite values' END AS problem
    FROM w WHERE pick = 1
    """
)
def field_report(spark, sf):
    return rs.inspect_fields(blocks(spark, sf), field_values(spark, sf), small_table(spark, SPECS, SPEC_SCHEMA))


@query(
    f"""
    {INSPECT_SQL}, s AS (SELECT DISTINCT sample_id, unnest(['U', 'p', 'k']) AS field FROM v),
    f AS (SELECT sample_id, field, bool_or((block_id + sample_id::int) % 3 <> 0) AS vol FROM w GROUP BY ALL)
    SELECT s.sample_id, s.field, CASE WHEN vol IS NULL THEN 'required field is absent' ELSE 'only on non-volumetric blocks' END AS problem
    FROM s LEFT JOIN f USING (sample_id, field) WHERE vol IS NULL OR NOT vol
    """
)
def absent_fields(spark, sf):
    specs = small_table(spark, SPECS, SPEC_SCHEMA)
    found = blocks(spark, sf)
    return rs.missing_required(found.select("sample_id").distinct(), rs.inspect_fields(found, field_values(spark, sf), specs), specs)


@query(
    f"""
    {MESH_SQL}
    SELECT sample_id, 0 AS block_id, count(*) AS n_cells, true AS is_volumetric, 16 * 11 * 11::bigint AS n_points, 0.0::double AS xmin, 45.0::double AS xmax,
           0.0::double AS ymin, 20.0::double AS ymax, 0.0::double AS zmin, 25.0::double AS zmax, 'T,U' AS point_arrays, 'T,U,p' AS cell_arrays
    FROM cells GROUP BY sample_id
    """
)
def block_summaries(spark, sf):
    cells, pts, values = mesh(spark, sf)
    stored = values.select(
        "sample_id", "block_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("field"), F.lit(a).alias("association"))
                    for f, a in (("U", "CELL"), ("p", "CELL"), ("T", "CELL"), ("U", "POINT"), ("T", "POINT"))
                ]
            )
        ),
    )
    out = rs.block_summary(cells, pts, stored)
    return out.withColumns({c: F.array_join(c, ",") for c in ("point_arrays", "cell_arrays")})


@query(
    """
    SELECT cast(l_suppkey AS varchar) AS sample_id, l_linenumber AS block_id, bool_or(l_quantity > 45) AS is_volumetric FROM lineitem GROUP BY ALL
    """
)
def volumetric_blocks(spark, sf):
    cells = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("sample_id"), F.col("l_linenumber").alias("block_id"),
        F.when(F.col("l_quantity") > 45, F.lit(3)).otherwise(F.lit(2)).alias("cell_dim"),
    )
    return rs.is_volumetric(cells)


# ---------------------------------------------------------------------- masks

MASKS_SQL = f"""
    WITH c AS ({CELLS_SQL}),
    b AS (SELECT sample_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM c WHERE value > 490000 GROUP BY ALL),
    d AS (SELECT c.*, coalesce(x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1, false) AS domain_mask FROM c LEFT JOIN b USING (sample_id)),
    f AS (SELECT *, valid AND domain_mask AS fluid_mask, domain_mask AND NOT valid AS solid_mask, NOT domain_mask AS outside_mask,
            valid AND valid_u AND domain_mask AS target_valid_mask FROM d)
"""


def phase_cells(spark, sf):
    cells = field_cells(spark, sf)
    dense = grids.with_position(cells, GRID).filter("value > 490000")
    bounds = grids.bbox(dense, ["sample_id"])
    return m.phase_masks(m.domain_mask(cells, GRID, bounds), "valid")


@query(
    f"""
    {MASKS_SQL}
    SELECT sample_id, idx, domain_mask, fluid_mask, solid_mask, outside_mask, ix = 0 AS x_min_face_mask, ix = 14 AS x_max_face_mask,
           iy = 0 AS y_min_face_mask, iy = 9 AS y_max_face_mask, iz = 0 AS z_min_face_mask, iz = 9 AS z_max_face_mask,
           target_valid_mask, target_valid_mask AND fluid_mask AS loss_mask, target_valid_mask AND fluid_mask AS metric_mask FROM f
    """
)
def field_masks(spark, sf):
    masks = m.target_masks(grids.face_masks(phase_cells(spark, sf), GRID), ["valid", "valid_u"])
    return masks.drop("valid", "value", "wall", "wall_valid", "valid_u", "custkey")


BOUNDARY_SQL = """
    n AS (SELECT sample_id, idx, ix, iy, iz, unnest(range(0, 27)) AS o FROM f WHERE fluid_mask),
    k AS (SELECT n.sample_id, n.idx, count(*) AS c FROM n JOIN f ON f.sample_id = n.sample_id AND f.fluid_mask
            AND f.ix = n.ix + n.o % 3 - 1 AND f.iy = n.iy + n.o // 3 % 3 - 1 AND f.iz = n.iz + n.o // 9 - 1 GROUP BY ALL)
"""


@query(
    f"""
    {MASKS_SQL}, {BOUNDARY_SQL}
    SELECT f.sample_id, f.idx, f.fluid_mask AND coalesce(k.c, 0) < 27 AS fluid_boundary_mask,
           coalesce(f.fluid_mask AND wall_valid AND wall <= 1.5, false) AS near_wall_mask, f.fluid_mask AND coalesce(k.c, 0) < 27 AS near_boundary
    FROM f LEFT JOIN k USING (sample_id, idx)
    """
)
def near_walls(spark, sf):
    masks = m.fluid_boundary(phase_cells(spark, sf), GRID)
    walls = m.near_wall(masks, GRID, "wall", "wall_valid")
    plain = m.near_wall(walls.withColumnRenamed("near_wall_mask", "_w"), GRID, None, None)
    return plain.select(
        "sample_id", "idx", "fluid_boundary_mask", F.col("_w").alias("near_wall_mask"),
        F.col("near_wall_mask").alias("near_boundary"),
    )


@query(
    f"""
    {MASKS_SQL},
    fd AS (SELECT a.sample_id, a.idx, sqrt(min(((a.ix - b.ix) * 2.0)^2 + ((a.iy - b.iy) * 1.5)^2 + ((a.iz - b.iz) * 1.0)^2)) AS d
           FROM f a JOIN f b ON a.sample_id = b.sample_id WHERE a.fluid_mask AND NOT b.fluid_mask GROUP BY ALL),
    sd AS (SELECT a.sample_id, a.idx, sqrt(min(((a.ix - b.ix) * 2.0)^2 + ((a.iy - b.iy) * 1.5)^2 + ((a.iz - b.iz) * 1.0)^2)) AS d
           FROM f a JOIN f b ON a.sample_id = b.sample_id WHERE a.solid_mask AND NOT b.solid_mask GROUP BY ALL)
    SELECT f.sample_id, f.idx, round(CASE WHEN fluid_mask THEN fd.d WHEN solid_mask THEN -sd.d ELSE 0.0 END, 9) AS signed_distance,
           round(CASE WHEN fluid_mask AND wall_valid THEN greatest(wall - 1, 0.0) WHEN fluid_mask THEN fd.d WHEN solid_mask THEN -sd.d ELSE 0.0 END, 9) AS with_wall
    FROM f LEFT JOIN fd USING (sample_id, idx) LEFT JOIN sd USING (sample_id, idx)
    """
)
def signed_distances(spark, sf):
    cells = phase_cells(spark, sf).withColumn("wall", F.col("wall") - 1)
    both = m.signed_distance(cells, GRID).withColumnRenamed("signed_distance", "_plain")
    fluid = F.when(F.col("fluid_mask") & F.col("wall_valid"), F.greatest("wall", F.lit(0.0))).otherwise(F.col("_plain"))
    return both.select(
        "sample_id", "idx", F.round("_plain", 9).alias("signed_distance"), F.round(fluid, 9).alias("with_wall")
    )


@query(
    f"""
    {MASKS_SQL}, g AS (SELECT sample_id, max(custkey) % 360 AS deg FROM c GROUP BY ALL),
    w AS (SELECT f.*, deg, -cos(pi() / 2 - radians(deg)) AS wx, -sin(pi() / 2 - radians(deg)) AS wy FROM f JOIN g USING (sample_id)),
    t AS (SELECT *, least(-wx, wx, -wy, wy) AS lo FROM w)
    SELECT sample_id, idx,
       fluid_mask AND CASE WHEN -wx = lo THEN ix = 0 WHEN wx = lo THEN ix = 14 WHEN -wy = lo THEN iy = 0 ELSE iy = 9 END AS wind_inlet_mask,
       fluid_mask AND CASE WHEN -wx = -lo THEN ix = 0 WHEN wx = -lo THEN ix = 14 WHEN -wy = -lo THEN iy = 0 ELSE iy = 9 END AS wind_outlet_mask
    FROM t
    """
)
def wind_face_masks(spark, sf):
    cells = phase_cells(spark, sf)
    wind = field_cells(spark, sf).groupBy("sample_id").agg((F.max("custkey") % 360).cast("double").alias("deg"))
    return m.wind_masks(cells.join(wind, "sample_id"), GRID, "deg").select(
        "sample_id", "idx", "wind_inlet_mask", "wind_outlet_mask"
    )


NAMES = ["domain_mask", "fluid_mask", "solid_mask", "outside_mask", "target_valid_mask", "loss_mask"]


@query(
    f"""
    {MASKS_SQL}
    SELECT sample_id, avg(domain_mask::int) AS domain_mask, avg(fluid_mask::int) AS fluid_mask, avg(solid_mask::int) AS solid_mask,
           avg(outside_mask::int) AS outside_mask, avg(target_valid_mask::int) AS target_valid_mask, avg((target_valid_mask AND fluid_mask)::int) AS loss_mask
    FROM f GROUP BY sample_id
    """
)
def mask_fractions(spark, sf):
    return m.mask_fractions(m.target_masks(phase_cells(spark, sf), ["valid", "valid_u"]), NAMES)


@query(
    f"""
    {MASKS_SQL}
    SELECT sample_id, count(*) FILTER (fluid_mask AND NOT valid_u) AS fluid_and_solid, count(*) FILTER ((fluid_mask OR NOT valid_u) AND NOT domain_mask) AS outside_domain,
           count(*) FILTER (target_valid_mask AND NOT valid_u) AS loss_without_target FROM f GROUP BY sample_id
    """
)
def mask_checks(spark, sf):
    """Counts of broken invariants, on masks that are broken on purpose."""
    masks = m.target_masks(phase_cells(spark, sf), ["valid", "valid_u"])
    return m.check_masks(masks.withColumn("solid_mask", ~F.col("valid_u")))


@query(
    f"""
    {MASKS_SQL}, u AS (SELECT sample_id, idx, unnest([{{'o': 0, 'c': 'loss', 'v': target_valid_mask AND fluid_mask}}, {{'o': 1, 'c': 'solid_channel', 'v': solid_mask}},
        {{'o': 2, 'c': 'solid_again', 'v': solid_mask}}]) AS e FROM f)
    SELECT sample_id, e.c AS channel, idx, e.v::int::double AS value, true AS valid FROM u
    """
)
def mask_channels(spark, sf):
    masks = m.target_masks(phase_cells(spark, sf), ["valid", "valid_u"])
    chosen = m.select_masks(masks, {"loss": "loss_mask", "solid_channel": "solid_mask", "solid_again": "solid_mask"})
    return m.mask_channels(chosen)


@query(f"WITH c AS ({CELLS_SQL}) SELECT sample_id, idx, valid AND valid_u AS target_valid FROM c")
def target_validity(spark, sf):
    long = field_cells(spark, sf).select(
        "sample_id", "idx",
        F.inline(
            F.array(
                F.struct(F.lit("Ux").alias("channel"), F.col("valid").alias("valid")),
                F.struct(F.lit("p").alias("channel"), F.col("valid_u").alias("valid")),
                F.struct(F.lit("T").alias("channel"), F.lit(False).alias("valid")),
            )
        ),
    )
    return m.target_validity(long, ["Ux", "p"])


BC = [m.BoundaryValue("Ux", "x_min", 3.5), m.BoundaryValue("Ux", "z_max", -1.0), m.BoundaryValue("p", "y_min", 0.0)]


@query(
    f"""
    {MASKS_SQL}, u AS (SELECT f.*, unnest([{{'c': 'Ux', 'v': value}}, {{'c': 'p', 'v': wall}}]) AS e FROM f)
    SELECT sample_id, idx, e.c AS channel, CASE WHEN e.c = 'Ux' AND fluid_mask AND iz = 9 THEN -1.0 WHEN e.c = 'Ux' AND fluid_mask AND ix = 0 THEN 3.5
           WHEN e.c = 'p' AND fluid_mask AND iy = 0 THEN 0.0 ELSE e.v END AS value FROM u
    """
)
def boundary_overrides(spark, sf):
    long = phase_cells(spark, sf).select(
        "sample_id", "idx", "fluid_mask",
        F.inline(
            F.array(
                F.struct(F.lit("Ux").alias("channel"), F.col("value").alias("value")),
                F.struct(F.lit("p").alias("channel"), F.col("wall").alias("value")),
            )
        ),
    )
    return m.apply_boundary_values(long, GRID, BC).drop("fluid_mask")


@query(
    f"""
    {MASKS_SQL} SELECT sample_id, count(*) FILTER (fluid_mask AND ix = 0) AS bc_00, count(*) FILTER (fluid_mask AND iz = 9) AS bc_01,
           count(*) FILTER (fluid_mask AND iy = 0) AS bc_02 FROM f GROUP BY sample_id
    """
)
def boundary_cell_counts(spark, sf):
    return m.boundary_cells(phase_cells(spark, sf), GRID, BC)


assert math.prod(GRID.dims) == 1500
