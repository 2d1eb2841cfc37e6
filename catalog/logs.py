"""Log lines, geometry text, convergence and mean speed.

Log lines are derived from ``events``: 200 events make one log.
"""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.operators import convergence as conv
from gridloom.operators.order import carry_forward
from gridloom.sources import logs

LINES_SQL = """
    SELECT 'log_' || event_id // 200 AS path, event_id % 200 + 1 AS line_no, event_type, event_id, user_id, value,
       CASE event_type WHEN 'click' THEN 'Time = ' || event_id % 200
         WHEN 'view' THEN 'smoothSolver:  Solving for ' || (['Ux', 'Uy', 'k'])[event_id % 3 + 1] || ', Initial residual = ' || user_id || 'e-05, Final residual = ' || user_id || 'e-06, No Iterations ' || event_id % 7
         WHEN 'error' THEN 'GAMG:  Solving for p, Initial residual = 0.0' || user_id % 10 || ', Final residual = 1e-0' || user_id % 8 + 1 || ', No Iterations 3'
         WHEN 'signup' THEN 'time step continuity errors : sum local = ' || user_id || 'e-09, global = -' || event_id % 5 || 'e-12, cumulative = 3.5e-07'
         ELSE CASE WHEN event_id % 9 = 0 THEN 'SIMPLE solution converged in ' || event_id % 200 || ' iterations' ELSE 'ExecutionTime = ' || event_id || ' s' END END AS line
    FROM events
"""


def log_lines(spark, sf):
    e, u = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")

    def s(c):
        return c.cast("string")

    field = F.get(F.array(F.lit("Ux"), F.lit("Uy"), F.lit("k")), (e % 3).cast("int"))
    line = (
        F.when(kind == "click", F.concat(F.lit("Time = "), s(e % 200)))
        .when(
            kind == "view",
            F.concat(
                F.lit("smoothSolver:  Solving for "), field, F.lit(", Initial residual = "), s(u), F.lit("e-05, Final residual = "),
                s(u), F.lit("e-06, No Iterations "), s(e % 7),
            ),
        )
        .when(
            kind == "error",
            F.concat(
                F.lit("GAMG:  Solving for p, Initial residual = 0.0"), s(u % 10), F.lit(", Final residual = 1e-0"),
                s(u % 8 + 1), F.lit(", No Iterations 3"),
            ),
        )
        .when(
            kind == "signup",
            F.concat(
                F.lit("time step continuity errors : sum local = "), s(u), F.lit("e-09, global = -"), s(e % 5),
                F.lit("e-12, cumulative = 3.5e-07"),
            ),
        )
        .when(e % 9 == 0, F.concat(F.lit("SIMPLE solution converged in "), s(e % 200), F.lit(" iterations")))
        .otherwise(F.concat(F.lit("ExecutionTime = "), s(e), F.lit(" s")))
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("log_"), s(F.floor(e / 200))).alias("path"), (e % 200 + 1).alias("line_no"), line.alias("line")
    )


PARSED_SQL = f"""
    WITH l AS ({LINES_SQL}),
    t AS (SELECT *, last(CASE WHEN event_type = 'click' THEN event_id % 200 END IGNORE NULLS) OVER (PARTITION BY path ORDER BY line_no) AS t FROM l),
    k AS (SELECT path, line_no, t::varchar AS time_name, t::double AS time, CASE event_type WHEN 'view' THEN 'residual' WHEN 'error' THEN 'residual' WHEN 'signup' THEN 'continuity' ELSE 'converged' END AS kind,
        CASE event_type WHEN 'view' THEN (['Ux', 'Uy', 'k'])[event_id % 3 + 1] WHEN 'error' THEN 'p' END AS field,
        CASE event_type WHEN 'view' THEN (user_id || 'e-05')::double WHEN 'error' THEN ('0.0' || user_id % 10)::double END AS initial_residual,
        CASE event_type WHEN 'view' THEN (user_id || 'e-06')::double WHEN 'error' THEN ('1e-0' || user_id % 8 + 1)::double END AS final_residual,
        CASE event_type WHEN 'view' THEN (event_id % 7)::int WHEN 'error' THEN 3 END AS iterations,
        CASE event_type WHEN 'signup' THEN (user_id || 'e-09')::double END AS sum_local, CASE event_type WHEN 'signup' THEN ('-' || event_id % 5 || 'e-12')::double END AS global_error,
        CASE event_type WHEN 'signup' THEN 3.5e-07::double END AS cumulative, CASE event_type WHEN 'purchase' THEN (event_id % 200)::int END AS converged_in
      FROM t WHERE event_type <> 'click' AND (event_type <> 'purchase' OR event_id % 9 = 0)),
    p AS (SELECT *, row_number() OVER (PARTITION BY path, kind, time_name, field ORDER BY line_no) AS solve_no FROM k)
"""


@query(f"{PARSED_SQL} SELECT * FROM p")
def solver_log(spark, sf):
    # A small block makes every log span several of them.
    return logs.parse_solver_log(log_lines(spark, sf), block=64)


LAST_SQL = f"""
    {PARSED_SQL}, r AS (SELECT * FROM p WHERE kind = 'residual' AND time IS NOT NULL),
    e AS (SELECT path, max(time) AS time FROM r GROUP BY path),
    a AS (SELECT r.path, r.time, field, solve_no, initial_residual, 1e-4::double AS residual_limit, initial_residual <= 1e-4 AS within FROM r JOIN e USING (path, time))
"""


@query(f"{LAST_SQL} SELECT * FROM a")
def residual_audit(spark, sf):
    return conv.residual_audit(solver_log(spark, sf))


@query(
    f"""
    {LAST_SQL}, g AS (SELECT path, max(time) AS final_time, count(*) AS residuals, count(*) FILTER (NOT within) AS above_limit, max(initial_residual) AS worst_residual FROM a GROUP BY path),
    o AS (SELECT path, count(*) FILTER (kind = 'converged') AS markers, arg_max(sum_local, line_no) FILTER (kind = 'continuity') AS sum_local,
            arg_max(global_error, line_no) FILTER (kind = 'continuity') AS global_error, arg_max(cumulative, line_no) FILTER (kind = 'continuity') AS cumulative FROM p GROUP BY path)
    SELECT o.path, final_time, residuals, above_limit, worst_residual, markers, sum_local, global_error, cumulative, markers > 0 AND coalesce(above_limit, 1) = 0 AS converged
    FROM o LEFT JOIN g USING (path)
    """
)
def log_convergence(spark, sf):
    return conv.convergence(solver_log(spark, sf))


@query(
    """
    WITH e AS (SELECT event_id, user_id % 3 AS log, CASE WHEN event_type = 'click' THEN value END AS v FROM events)
    SELECT event_id, log, v, last(v IGNORE NULLS) OVER (PARTITION BY log ORDER BY event_id) AS carried FROM e
    """
)
def carried_values(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 3).alias("log"), F.when(F.col("event_type") == "click", F.col("value")).alias("v")
    )
    return carry_forward(rows, ["log"], "event_id", "v", "carried", block=500)


@query(
    """
    WITH s AS (SELECT s_suppkey, s_acctbal AS b, s_nationkey AS n FROM supplier)
    SELECT 'log_' || s_suppkey AS path, CASE WHEN s_suppkey % 5 <> 0 THEN b::varchar || ';' || (-n)::double::varchar || ';' || (n + 0.5)::double::varchar END AS centre,
           CASE WHEN s_suppkey % 7 <> 0 THEN (-n)::double::varchar || ';0.0;1.0;' || n::double::varchar || ';2.5;3.0' END AS bounds FROM s
    """
)
def tool_logs(spark, sf):
    n = F.col("s_nationkey")
    s = lambda c: c.cast("string")
    centre = F.when(
        F.col("s_suppkey") % 5 != 0,
        F.concat(F.lit("Set centre of rotation to ("), s(F.col("s_acctbal")), F.lit(" "), s(-n), F.lit(" "), s((n + 0.5).cast("double")), F.lit(")")),
    )
    bounds = F.when(
        F.col("s_suppkey") % 7 != 0,
        F.concat(F.lit("    Overall Bounds : ("), s(-n), F.lit(" 0 1) ("), s(n), F.lit(" 2.5 3)")),
    )
    lines = table(spark, sf, "supplier").select(
        F.concat(F.lit("log_"), s(F.col("s_suppkey"))).alias("path"),
        F.posexplode(
            F.array(F.lit("Reading"), centre, F.lit("Set centre"), bounds, F.lit("Set centre of rotation to (9 9 9)"), F.lit("bounding box 9 9 9 9 9 9"))
        ).alias("line_no", "line"),
    )
    # The later lines of the same kind must lose against the first ones.
    kept = lines.filter(
        "line is not null and not (line_no = 4 and cast(substr(path, 5) as int) % 5 = 0) "
        "and not (line_no = 5 and cast(substr(path, 5) as int) % 7 = 0)"
    )
    parsed = logs.parse_tool_log(kept)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ";")
    return parsed.select("path", text("centre").alias("centre"), text("bounds").alias("bounds"))


@query(
    """
    SELECT 's' || label AS surface, 's' || label || '.stl' AS path, ((row_number() OVER (PARTITION BY label, v ORDER BY vec_id) - 1))::bigint AS facet_id, v::int AS vertex_no,
           embedding[v * 3 + 1]::double AS x, embedding[v * 3 + 2]::double AS y, embedding[v * 3 + 3]::double AS z
    FROM embeddings, (SELECT unnest([0, 1, 2]) AS v)
    """
)
def surface_facets(spark, sf):
    e = F.col("embedding")

    def vertex(i):
        return F.concat_ws(" ", F.lit("      vertex"), *[e[3 * i + a].cast("double").cast("string") for a in range(3)])

    facet = F.array(
        F.lit("  facet normal 0 0 1"), F.lit("    outer loop"), vertex(0), vertex(1), vertex(2), F.lit("    endloop"), F.lit("  endfacet")
    )
    lines = table(spark, sf, "embeddings").select(
        F.concat(F.lit("s"), F.col("label").cast("string"), F.lit(".stl")).alias("file_name"), "vec_id",
        F.posexplode(facet).alias("_i", "line"),
    )
    lines = lines.select(
        "file_name", F.col("file_name").alias("path"), (F.col("vec_id") * 7 + F.col("_i") + 2).alias("line_no"), "line"
    )
    return logs.parse_stl(lines, block=512)


@query(
    """
    WITH c AS (SELECT l_suppkey AS case_id, l_linenumber AS time, l_quantity AS v, l_extendedprice / 10000 AS ux, l_discount * 10 AS uy, l_tax * 10 AS uz FROM lineitem)
    SELECT case_id, count(*) AS cells, max(time)::double AS time, sum(v) AS total_volume, round(sum(v * sqrt(ux * ux + uy * uy + uz * uz)) / sum(v), 6) AS mean_speed FROM c GROUP BY case_id
    """
)
def mean_speeds(spark, sf):
    cells = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("case_id"), F.col("l_linenumber").cast("double").alias("time"), F.col("l_quantity").alias("volume"),
        (F.col("l_extendedprice") / 10000).alias("ux"), (F.col("l_discount") * 10).alias("uy"), (F.col("l_tax") * 10).alias("uz"),
    )
    return conv.mean_speed(cells, ["case_id"]).withColumn("mean_speed", F.round("mean_speed", 6))
