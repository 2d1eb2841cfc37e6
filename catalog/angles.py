"""Wind directions, rotations and domain boxes."""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.functions import angles
from gridloom.operators import cases

WRAP = "({x} - 360 * floor({x} / 360))"


def wrap(x: str) -> str:
    return WRAP.replace("{x}", x)


@query(
    f"""
    SELECT c_custkey, {wrap('c_acctbal')} AS direction, printf('%.3f', {wrap('c_acctbal')}) AS direction_text,
           {wrap('(c_acctbal + 25)')} AS rotation
    FROM customer
    """
)
def wind_directions(spark, sf):
    a = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        angles.wind_direction(a).alias("direction"),
        angles.wind_direction_text(a).alias("direction_text"),
        angles.geometry_rotation(a).alias("rotation"),
    )


@query(
    """
    WITH t AS (SELECT c_custkey, c_nationkey AS ux, c_nationkey - 12 AS uy,
                      round(sin(radians(c_acctbal)), 9) AS s, round(cos(radians(c_acctbal)), 9) AS c FROM customer)
    SELECT c_custkey, round(c * ux - s * uy, 9) + 0.0 AS x, round(s * ux + c * uy, 9) + 0.0 AS y FROM t
    """
)
def rotated_vectors(spark, sf):
    n = F.col("c_nationkey")
    v = angles.rotate_xy(n, n - 12, F.col("c_acctbal"))
    rows = table(spark, sf, "customer").select("c_custkey", v.alias("v"))
    return rows.select(
        "c_custkey", (F.col("v.x") + 0.0).alias("x"), (F.col("v.y") + 0.0).alias("y")
    )


@query(
    f"""
    WITH d AS (SELECT * FROM (VALUES ('f18p1','a',0.0::double,-5.0::double), ('f18p1','b',0.0,5.0), ('f18p2','a',5.0,0.0),
                 ('f18p2','b',-5.0,0.0), ('f18p3','a',5.0,0.0), ('f18p3','b',-5.0,0.0)) v(plant, side, x, y)),
    s AS (SELECT s_suppkey, round(sin(radians({wrap('(s_acctbal + 25)')})), 9) AS s,
                 round(cos(radians({wrap('(s_acctbal + 25)')})), 9) AS c FROM supplier)
    SELECT s_suppkey, plant, side, round(cast(c * x - s * y AS double), 9) + 0.0::double AS ux,
           round(cast(s * x + c * y AS double), 9) + 0.0::double AS uy FROM s, d
    """
)
def intake_vectors(spark, sf):
    rows = cases.intake_vectors(
        table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), angles.geometry_rotation(F.col("s_acctbal"))
    )
    return rows.select(
        "s_suppkey", "plant", "side", (F.col("ux") + 0.0).alias("ux"), (F.col("uy") + 0.0).alias("uy")
    )


@query(
    """
    WITH t AS (SELECT c_custkey, -cos(pi() / 2 - radians(c_acctbal)) AS x, -sin(pi() / 2 - radians(c_acctbal)) AS y,
                      cos(pi() + radians(c_acctbal)) AS tx, sin(pi() + radians(c_acctbal)) AS ty FROM customer),
    s AS (SELECT c_custkey, x, y, tx, ty, unnest([{'n': 'x_min_face_mask', 's': -x, 'o': 0}, {'n': 'x_max_face_mask', 's': x, 'o': 1},
             {'n': 'y_min_face_mask', 's': -y, 'o': 2}, {'n': 'y_max_face_mask', 's': y, 'o': 3}]) AS f FROM t)
    SELECT c_custkey, round(any_value(x), 9) + 0.0 AS x, round(any_value(y), 9) + 0.0 AS y, round(any_value(tx), 9) + 0.0 AS toward_x,
           round(any_value(ty), 9) + 0.0 AS toward_y,
           first(f.n ORDER BY f.s, f.o) AS inlet, first(f.n ORDER BY f.s DESC, f.o) AS outlet
    FROM s GROUP BY c_custkey
    """
)
def flow_directions(spark, sf):
    a = F.col("c_acctbal")
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        angles.toward_unit(a).alias("u"),
        angles.toward_unit(a, "negative_x", "counterclockwise", "toward").alias("t"),
    )
    return rows.select(
        "c_custkey",
        (F.round("u.x", 9) + 0.0).alias("x"), (F.round("u.y", 9) + 0.0).alias("y"),
        (F.round("t.x", 9) + 0.0).alias("toward_x"), (F.round("t.y", 9) + 0.0).alias("toward_y"),
        angles.wind_faces(F.col("u"))["inlet"].alias("inlet"),
        angles.wind_faces(F.col("u"))["outlet"].alias("outlet"),
    )


@query(
    r"""
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'calm' ELSE printf('%.2f', c_acctbal) END AS ws,
                      c_acctbal AS x FROM customer),
    m AS (SELECT c.*, unnest(['skip', 'epsilon', 'keep', 'error']) AS mode FROM c)
    SELECT c_custkey, mode,
        CASE WHEN ws = 'calm' THEN '' WHEN x > 0 OR mode = 'keep' THEN ws WHEN mode = 'epsilon' THEN '0.001' ELSE '' END AS ws_for_setup,
        CASE WHEN ws = 'calm' THEN 'failed' WHEN x > 0 OR mode IN ('keep', 'epsilon') THEN NULL
             WHEN mode = 'skip' THEN 'skipped' ELSE 'failed' END AS status,
        CASE WHEN ws = 'calm' THEN 'invalid WS' WHEN x > 0 OR mode IN ('keep', 'epsilon') THEN NULL
             WHEN mode = 'skip' THEN 'WS<=0 and ZERO_WS_MODE=skip' ELSE 'invalid WS for setup' END AS message
    FROM m
    """
)
def zero_wind_policy(spark, sf):
    ws = F.when(F.col("c_custkey") % 7 == 0, F.lit("calm")).otherwise(F.format_string("%.2f", "c_acctbal"))
    modes = F.array(
        *[
            F.struct(F.lit(m).alias("mode"), cases.resolve_ws(F.col("ws"), m).alias("r"))
            for m in ("skip", "epsilon", "keep", "error")
        ]
    )
    rows = table(spark, sf, "customer").select("c_custkey", ws.alias("ws"))
    return rows.select("c_custkey", F.inline(modes)).select("c_custkey", "mode", "r.*")


@query(
    """
    WITH b AS (SELECT c_custkey, round(c_acctbal - 300.0 - 400.0, 3) AS x_min, round(c_acctbal + 300.0 + 800.0, 3) AS x_max,
                      round(-c_acctbal - 300.0 - 200.0, 3) AS y_min, round(-c_acctbal + 300.0 + 200.0, 3) AS y_max,
                      c_nationkey::double AS z_min, round(c_nationkey::double + 50 + 320, 3) AS z_max FROM customer)
    SELECT c_custkey, x_min, x_max, y_min, y_max, z_min, z_max,
           greatest(1, floor((x_max - x_min) / 40.0 + 0.999999))::int AS nx,
           greatest(1, floor((y_max - y_min) / 40.0 + 0.999999))::int AS ny,
           greatest(1, floor((z_max - z_min) / 40.0 + 0.999999))::int AS nz
    FROM b
    """
)
def domain_boxes(spark, sf):
    n = F.col("c_nationkey").cast("double")
    box = angles.domain_box(F.col("c_acctbal"), -F.col("c_acctbal"), n, n + 50.0)
    rows = table(spark, sf, "customer").select("c_custkey", box.alias("b"))
    return rows.select("c_custkey", *[f"b.{c}" for c in ("x_min", "x_max", "y_min", "y_max", "z_min", "z_max", "nx", "ny", "nz")])
