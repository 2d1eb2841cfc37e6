"""File inventories: states, modes, signatures, decisions and pairs.

The inventory is derived from ``events``: eight events make one case, and each
event is one file path of that case.
"""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.operators import inventory as ops
from gridloom.operators import manifest

PATH_SQL = """
    SELECT event_id, event_id // 8 AS c, '/ws/batch_' || (event_id // 8) % 5 || '/case_' || event_id // 8 || '/' ||
      CASE event_type
        WHEN 'click' THEN 'flow/' || (['0', '60', '120', '.5', '600'])[event_id % 5 + 1] || '/U'
        WHEN 'view' THEN 'trd/' || (['0', '120.5', '.5', '60'])[event_id % 4 + 1] || '/T'
        WHEN 'error' THEN (['flow/constant/polyMesh/points', 'flow/constant/polyMesh/boundary', 'trd/constant/polyMesh/points'])[event_id % 3 + 1]
        WHEN 'signup' THEN (['flow/restart.marker', 'flow/flow.marker', 'trd/transport.marker', 'flow/0/wallDistance', 'flow/0/wallDistance.gz'])[event_id % 5 + 1]
        ELSE (['vtk/flow_0.vtu', 'vtk/flow_latest_600.vtu', 'vtk/trd_0.vtu', 'vtk/post_processing.complete', 'vtk/trd_60.vtu', 'vtk/flow_latest_60.vtu'])[event_id % 6 + 1]
      END AS path
    FROM events
"""
INV_SQL = rf"""
    WITH raw AS ({PATH_SQL}),
    cut AS (SELECT path, split_part(path, '/', 3) AS b, split_part(path, '/', 4) AS case_id, split_part(path, '/', 5) AS domain,
              regexp_replace(path, '^(/[^/]*){{4}}/', '') AS inner_path FROM raw)
    SELECT path, substr(b, 7) AS batch_id, case_id, domain, inner_path, regexp_extract(path, '([^/]*)$', 1) AS file_name,
           CASE WHEN regexp_matches(inner_path, '^(\d+(\.\d+)?|\.\d+)/') THEN split_part(inner_path, '/', 1) END AS time_name
    FROM cut
"""


def paths(spark, sf):
    e = F.col("event_id")

    def choose(options):
        return F.get(F.array(*[F.lit(o) for o in options]), (e % len(options)).cast("int"))

    kind = F.col("event_type")
    inner = (
        F.when(kind == "click", F.concat(F.lit("flow/"), choose(["0", "60", "120", ".5", "600"]), F.lit("/U")))
        .when(kind == "view", F.concat(F.lit("trd/"), choose(["0", "120.5", ".5", "60"]), F.lit("/T")))
        .when(
            kind == "error",
            choose(["flow/constant/polyMesh/points", "flow/constant/polyMesh/boundary", "trd/constant/polyMesh/points"]),
        )
        .when(
            kind == "signup",
            choose(
                ["flow/restart.marker", "flow/flow.marker", "trd/transport.marker", "flow/0/wallDistance",
                 "flow/0/wallDistance.gz"]
            ),
        )
        .otherwise(
            choose(
                ["vtk/flow_0.vtu", "vtk/flow_latest_600.vtu", "vtk/trd_0.vtu", "vtk/post_processing.complete",
                 "vtk/trd_60.vtu", "vtk/flow_latest_60.vtu"]
            )
        )
    )
    case = F.floor(e / 8)
    path = F.concat(
        F.lit("/ws/batch_"), (case % 5).cast("string"), F.lit("/case_"), case.cast("string"), F.lit("/"), inner
    )
    return table(spark, sf, "events").select("event_id", case.alias("c"), path.alias("path"))


def inventory(spark, sf):
    return ops.parse_inventory(paths(spark, sf))


@query(INV_SQL)
def inventory_paths(spark, sf):
    return inventory(spark, sf)


STATE_SQL = """
    SELECT batch_id, case_id, domain,
           bool_or(inner_path = 'constant/polyMesh/points') AND bool_or(inner_path = 'constant/polyMesh/boundary') AS has_mesh,
           bool_or(starts_with(inner_path, 'constant/polyMesh/')) AS ready,
           bool_or(inner_path = 'restart.marker') AS has_restart_marker,
           bool_or(inner_path = 'flow.marker') AS has_flow_marker,
           bool_or(inner_path = 'transport.marker') AS has_transport_marker,
           coalesce(bool_or(time_name <> '0'), false) AS has_nonzero_time,
           bool_or(inner_path IN ('0/wallDistance', '0/wallDistance.gz')) AS has_wall_distance
    FROM inv GROUP BY ALL
"""


@query(f"WITH inv AS ({INV_SQL}) {STATE_SQL}")
def case_states(spark, sf):
    return ops.case_state(inventory(spark, sf))


@query(
    f"""
    WITH inv AS ({INV_SQL}), s AS ({STATE_SQL})
    SELECT batch_id, case_id, 'mesh' AS stage, CASE WHEN has_mesh AND (has_restart_marker OR has_nonzero_time) THEN 'continue' ELSE 'fresh' END AS mode
    FROM s WHERE domain = 'flow'
    UNION ALL SELECT batch_id, case_id, 'flow', CASE WHEN has_flow_marker OR has_nonzero_time THEN 'continue' ELSE 'fresh' END FROM s WHERE domain = 'flow'
    UNION ALL SELECT batch_id, case_id, 'transport', CASE WHEN has_transport_marker OR has_nonzero_time THEN 'continue' ELSE 'fresh' END FROM s WHERE domain = 'trd'
    UNION ALL SELECT batch_id, case_id, 'forced flow', 'fresh' FROM s WHERE domain = 'flow'
    """
)
def run_modes(spark, sf):
    state = ops.case_state(inventory(spark, sf))
    modes = [
        ("mesh", ops.mesh_mode(state)),
        ("flow", ops.flow_mode(state)),
        ("transport", ops.transport_mode(state)),
        ("forced flow", ops.flow_mode(state, force=True)),
    ]
    out = None
    for name, df in modes:
        df = df.withColumn("stage", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


@query(
    f"""
    WITH inv AS ({INV_SQL}), s AS ({STATE_SQL})
    SELECT batch_id, case_id, CASE WHEN has_wall_distance THEN 'existing' ELSE 'todo' END AS status FROM s WHERE domain = 'flow'
    """
)
def wall_distance_todo(spark, sf):
    return ops.wall_distance_status(ops.case_state(inventory(spark, sf)))


@query(
    f"""
    WITH inv AS ({INV_SQL}), s AS ({STATE_SQL}),
    late AS (SELECT * FROM inv WHERE NOT inner_path = '0/wallDistance'),
    b AS (SELECT batch_id, case_id, bool_or(inner_path = '0/wallDistance.gz') AS had FROM late WHERE domain = 'flow' GROUP BY ALL)
    SELECT b.batch_id, b.case_id, CASE WHEN had THEN 'existing' WHEN has_wall_distance THEN 'generated' ELSE 'failed' END AS status
    FROM b JOIN s ON s.batch_id = b.batch_id AND s.case_id = b.case_id AND s.domain = 'flow'
    """
)
def wall_distance_check(spark, sf):
    """Before: only packed fields were there; after: both kinds."""
    after = inventory(spark, sf)
    before = after.filter("inner_path <> '0/wallDistance'")
    return ops.wall_distance_status(ops.case_state(before), ops.case_state(after))


TIMES_SQL = """
    SELECT batch_id, case_id, domain, time_name, try_cast(time_name AS double) AS t FROM inv WHERE time_name IS NOT NULL GROUP BY ALL
"""


@query(
    f"""
    WITH inv AS ({INV_SQL}), times AS ({TIMES_SQL})
    SELECT batch_id, case_id, domain, last(time_name ORDER BY t, time_name) AS latest_time,
           string_agg(time_name, ',' ORDER BY t, time_name) AS times
    FROM times GROUP BY ALL
    """
)
def time_folders(spark, sf):
    inv = inventory(spark, sf)
    out = None
    for d in ("flow", "trd"):
        both = ops.latest_time(inv, d).join(ops.time_list(inv, d), ["batch_id", "case_id"])
        both = both.withColumn("domain", F.lit(d))
        out = both if out is None else out.unionByName(both)
    return out


SIGNATURE_SQL = f"""
    WITH inv AS ({INV_SQL}), times AS ({TIMES_SQL}),
    r AS (SELECT batch_id, case_id, coalesce(bool_or(domain = 'trd' AND starts_with(inner_path, 'constant/polyMesh/')), false) AS ready
          FROM inv GROUP BY ALL HAVING bool_or(domain = 'flow')),
    f AS (SELECT batch_id, case_id, last(time_name ORDER BY t, time_name) AS latest_time FROM times WHERE domain = 'flow' GROUP BY ALL),
    t AS (SELECT batch_id, case_id, string_agg(time_name, ',' ORDER BY t, time_name) AS times FROM times WHERE domain = 'trd' GROUP BY ALL),
    sig AS (SELECT r.batch_id, r.case_id, ready, latest_time,
        'flow_latest=' || coalesce(latest_time, '') || chr(10) || 'transport_ready=' || ready::int || chr(10) ||
        'transport_times=' || CASE WHEN ready THEN coalesce(times, '') ELSE '' END || chr(10) || 'scalar_field=T' || chr(10) ||
        'flow_zero_fields=U p wallDistance' || chr(10) || 'flow_result_fields=U p' || chr(10) || 'vtu_point_data=included' AS signature
      FROM r LEFT JOIN f USING (batch_id, case_id) LEFT JOIN t USING (batch_id, case_id)),
    expected AS (
        SELECT batch_id, case_id, unnest(['flow_0.vtu', 'flow_latest_' || latest_time || '.vtu']) AS file_name FROM f
        UNION SELECT batch_id, case_id, 'trd_0.vtu' FROM inv WHERE domain = 'trd' AND starts_with(inner_path, 'constant/polyMesh/')
        UNION SELECT x.batch_id, x.case_id, 'trd_' || time_name || '.vtu' FROM times x JOIN r USING (batch_id, case_id)
              WHERE x.domain = 'trd' AND ready AND time_name <> '0'
        UNION SELECT x.batch_id, x.case_id, 'trd_' || time_name || '.vtu' FROM times x
              JOIN (SELECT DISTINCT batch_id, case_id FROM inv WHERE domain = 'trd' AND starts_with(inner_path, 'constant/polyMesh/')) y USING (batch_id, case_id)
              WHERE x.domain = 'trd' AND time_name <> '0'),
    missing AS (SELECT * FROM expected EXCEPT SELECT batch_id, case_id, file_name FROM inv WHERE domain = 'vtk')
"""


@query(f"{SIGNATURE_SQL} SELECT * FROM sig")
def post_signatures(spark, sf):
    return ops.post_signature(inventory(spark, sf))


@query(f"{SIGNATURE_SQL} SELECT * FROM missing")
def missing_outputs(spark, sf):
    return ops.missing_outputs(inventory(spark, sf))


@query(
    f"""
    {SIGNATURE_SQL},
    mk AS (SELECT DISTINCT batch_id, case_id FROM inv WHERE inner_path = 'post_processing.complete'),
    st AS (SELECT batch_id, case_id, signature FROM sig WHERE try_cast(substr(case_id, 6) AS bigint) % 4 <> 0),
    g AS (SELECT batch_id, case_id, count(*) AS n FROM missing WHERE file_name LIKE 'trd%' GROUP BY ALL),
    j AS (SELECT sig.*, mk.case_id IS NOT NULL AND st.signature IS NOT NULL AND coalesce(g.n, 0) = 0 AND latest_time IS NOT NULL AS cur
          FROM sig LEFT JOIN mk USING (batch_id, case_id) LEFT JOIN st USING (batch_id, case_id) LEFT JOIN g USING (batch_id, case_id))
    SELECT batch_id, case_id, ready, CASE WHEN cur THEN 'skip' ELSE 'rebuild' END AS decision,
           CASE WHEN cur THEN 'skipped' ELSE 'completed' END AS status,
           CASE WHEN cur AND ready THEN 'source results unchanged; existing VTU outputs reused'
                WHEN cur THEN 'flow VTU files reused; transport conversion skipped because the transport subcase is not prepared'
                WHEN ready THEN 'flow and transport VTU files created'
                ELSE 'flow VTU files created; transport conversion skipped because the transport subcase is not prepared' END AS message
    FROM j
    """
)
def post_decisions(spark, sf):
    """Three of four cases keep their stored signature; all flow files are there."""
    inv = inventory(spark, sf)
    flow_files = (
        ops.expected_outputs(inv)
        .filter("file_name like 'flow%'")
        .select(
            F.concat(F.lit("/ws/batch_"), "batch_id", F.lit("/"), "case_id", F.lit("/vtk/"), "file_name").alias("path")
        )
    )
    whole = inv.unionByName(ops.parse_inventory(flow_files))
    stored = (
        ops.post_signature(inv)
        .filter(F.expr("try_cast(substr(case_id, 6) AS bigint) % 4 <> 0"))
        .select("batch_id", "case_id", F.col("signature").alias("stored_signature"))
    )
    return ops.post_decision(whole, stored)


@query(
    f"""
    WITH inv AS ({INV_SQL}), c AS (SELECT DISTINCT cast((event_id // 4) % 5 AS varchar) AS batch_id, 'case_' || event_id // 4 AS case_id FROM events),
    s AS (SELECT batch_id, case_id, bool_or(domain = 'flow' AND inner_path = 'restart.marker') AS a, bool_or(domain = 'flow' AND inner_path = 'flow.marker') AS b,
                 bool_or(domain = 'trd' AND inner_path = 'transport.marker') AS d, bool_or(domain = 'vtk' AND inner_path = 'post_processing.complete') AS e
          FROM inv GROUP BY ALL)
    SELECT c.batch_id, c.case_id, CASE WHEN s.case_id IS NULL THEN 'absent' ELSE 'present' END AS case_dir,
           CASE WHEN a THEN 'present' ELSE 'absent' END AS mesh_restart_marker, CASE WHEN b THEN 'present' ELSE 'absent' END AS flow_marker,
           CASE WHEN d THEN 'present' ELSE 'absent' END AS transport_marker, CASE WHEN e THEN 'present' ELSE 'absent' END AS post_signature
    FROM c LEFT JOIN s USING (batch_id, case_id)
    """
)
def status_report(spark, sf):
    case = F.floor(F.col("event_id") / 4)
    listed = table(spark, sf, "events").select(
        (case % 5).cast("string").alias("batch_id"), F.concat(F.lit("case_"), case.cast("string")).alias("case_id")
    )
    return ops.status_report(listed, inventory(spark, sf))


@query(
    """
    WITH a AS (SELECT l_suppkey AS case_id, l_orderkey * 10 + l_linenumber AS list_ord,
                 CASE l_linenumber % 3 WHEN 0 THEN cast(l_orderkey % 500 AS varchar) WHEN 1 THEN (l_orderkey % 500) || '.0' ELSE (l_orderkey % 500) || '.00000000001' END AS time_name
               FROM lineitem),
    q AS (SELECT DISTINCT s_suppkey AS case_id, cast(unnest(range(0, 600, 7)) AS varchar) AS req_name FROM supplier),
    m AS (SELECT q.case_id, req_name, first(time_name ORDER BY list_ord, time_name) AS matched_time
          FROM q JOIN a ON a.case_id = q.case_id
           AND round(time_name::double) = req_name::double AND abs(time_name::double - req_name::double) <= 1e-10 * (1 + req_name::double)
          GROUP BY ALL)
    SELECT case_id, req_name, matched_time FROM q LEFT JOIN m USING (case_id, req_name)
    """
)
def matched_times(spark, sf):
    line, key = F.col("l_linenumber"), (F.col("l_orderkey") % 500).cast("string")
    name = F.when(line % 3 == 0, key).when(line % 3 == 1, F.concat(key, F.lit(".0"))).otherwise(
        F.concat(key, F.lit(".00000000001"))
    )
    available = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("case_id"), name.alias("time_name"),
        F.struct((F.col("l_orderkey") * 10 + line).alias("o"), name.alias("n")).alias("list_ord"),
    )
    requested = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("case_id"),
        F.explode(F.sequence(F.lit(0), F.lit(599), F.lit(7)).cast("array<string>")).alias("req_name"),
    )
    return ops.match_times(requested, available, ["case_id"])


# Field files of a campaign: nested and flat layouts, several folders for some.
FILE_SQL = """
    SELECT o_orderkey, '/data/' ||
       CASE o_orderkey % 7 WHEN 0 THEN 'case_' || o_custkey || '/vtk/' WHEN 1 THEN 'case_' || o_custkey || '/flow/vtk/'
         WHEN 2 THEN 'cases/case_' || o_custkey || '/vtk/' WHEN 3 THEN 'old/case_' || o_custkey || '/export/'
         ELSE 'case_' || o_custkey || '/vtk/' END ||
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'flow_0.vtu' WHEN o_orderpriority = '2-HIGH' THEN 'flow_latest_x.vtu'
         ELSE 'flow_latest_' || (o_orderkey % 1000) || '.vtu' END AS path
    FROM orders
"""


def field_files(spark, sf):
    k = F.col("o_orderkey") % 7
    case = F.concat(F.lit("case_"), F.col("o_custkey").cast("string"))
    folder = (
        F.when(k == 1, F.concat(case, F.lit("/flow/vtk/")))
        .when(k == 2, F.concat(F.lit("cases/"), case, F.lit("/vtk/")))
        .when(k == 3, F.concat(F.lit("old/"), case, F.lit("/export/")))
        .otherwise(F.concat(case, F.lit("/vtk/")))
    )
    p = F.col("o_orderpriority")
    name = (
        F.when(p == "1-URGENT", F.lit("flow_0.vtu"))
        .when(p == "2-HIGH", F.lit("flow_latest_x.vtu"))
        .otherwise(F.concat(F.lit("flow_latest_"), (F.col("o_orderkey") % 1000).cast("string"), F.lit(".vtu")))
    )
    return table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("/data/"), folder, name).alias("path"))


PAIR_SQL = rf"""
    WITH files AS ({FILE_SQL}),
    dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '/(case_\d+)/', 1) AS case_id
             FROM files WHERE path LIKE '%/flow_0.vtu'),
    pick AS (SELECT case_id, dir FROM dirs WHERE dir LIKE '%/vtk' UNION ALL
             SELECT case_id, dir FROM dirs WHERE case_id NOT IN (SELECT case_id FROM dirs WHERE dir LIKE '%/vtk')),
    found AS (SELECT case_id, list_sort(list(dir)) AS dirs, len(list(dir)) AS n_dirs FROM pick GROUP BY case_id),
    latest AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS vtk_dir,
                 last(path ORDER BY cast(regexp_extract(path, 'flow_latest_(\d+)\.vtu$', 1) AS int)) AS output_vtu
               FROM files WHERE regexp_matches(path, '/flow_latest_\d+\.vtu$') GROUP BY ALL)
"""


@query(f"{PAIR_SQL} SELECT * FROM latest")
def latest_outputs(spark, sf):
    return ops.latest_vtu(field_files(spark, sf))


@query(
    f"""
    {PAIR_SQL}
    SELECT 'case_' || c_custkey AS case_id, coalesce(n_dirs, 0)::int AS n_dirs, CASE WHEN n_dirs = 1 THEN dirs[1] END AS vtk_dir,
           array_to_string(dirs, ', ') AS dirs
    FROM customer LEFT JOIN found ON found.case_id = 'case_' || c_custkey
    """
)
def vtk_folders(spark, sf):
    listed = table(spark, sf, "customer").select(F.concat(F.lit("case_"), F.col("c_custkey").cast("string")).alias("case_id"))
    return ops.discover_vtk(listed, field_files(spark, sf), "/data").withColumn("dirs", F.array_join("dirs", ", "))


# Rows of the batch table: each customer twice when its key is divisible by ten.
PAIRS_SQL = f"""
    {PAIR_SQL},
    rows AS (SELECT c_custkey * 2 + 2 AS row_number, CASE WHEN c_custkey % 50 = 0 THEN '' ELSE cast(c_custkey AS varchar) END AS raw FROM customer
             UNION ALL SELECT c_custkey * 2 + 3, 'case_' || c_custkey FROM customer WHERE c_custkey % 10 = 0),
    ids AS (SELECT *, CASE WHEN raw = '' THEN NULL WHEN starts_with(raw, 'case_') THEN raw ELSE 'case_' || raw END AS id FROM rows),
    seen AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_number) AS n FROM ids),
    p AS (SELECT seen.*, f.dirs, f.n_dirs, l.output_vtu FROM seen LEFT JOIN found f ON f.case_id = seen.id
          LEFT JOIN latest l ON f.n_dirs = 1 AND l.vtk_dir = f.dirs[1]),
    pairs AS (SELECT row_number, id, raw, dirs, output_vtu, CASE WHEN id IS NULL THEN 'Empty Case value' WHEN n > 1 THEN 'Duplicate case in CSV: ' || id
        WHEN n_dirs IS NULL THEN 'Cannot find flow_0.vtu for ''' || id || ''' below /data. Supported layouts are ''' || id || '/vtk'' and ''' || id || '/flow/vtk''.'
        WHEN n_dirs > 1 THEN 'Multiple VTK directories found for ' || id || ': ' || array_to_string(dirs, ', ')
        WHEN output_vtu IS NULL THEN 'No flow_latest_#.vtu found in ' || dirs[1] END AS problem FROM p)
"""


def pairs(spark, sf):
    key = F.col("c_custkey")
    customers = table(spark, sf, "customer")
    rows = customers.select(
        (key * 2 + 2).alias("row_number"),
        F.when(key % 50 == 0, F.lit(" ")).otherwise(key.cast("string")).alias("raw_case"),
    ).unionByName(
        customers.filter(key % 10 == 0).select(
            (key * 2 + 3).alias("row_number"), F.concat(F.lit(" case_"), key.cast("string")).alias("raw_case")
        )
    )
    return manifest.pair_samples(rows, field_files(spark, sf), "/data")


@query(
    f"""
    {PAIRS_SQL}
    SELECT row_number, CASE WHEN problem IS NULL THEN id ELSE coalesce(nullif(raw, ''), 'row_' || row_number) END AS case_id,
           CASE WHEN problem IS NULL THEN dirs[1] || '/flow_0.vtu' END AS input_vtu,
           CASE WHEN problem IS NULL THEN output_vtu END AS output_vtu, problem
    FROM pairs
    """
)
def sample_pairs(spark, sf):
    return pairs(spark, sf)


MANIFEST_SQL = f"""
    {PAIRS_SQL},
    m AS (SELECT row_number, '' AS input_pt, '' AS output_pt,
           CASE WHEN problem IS NULL THEN id ELSE coalesce(nullif(raw, ''), 'row_' || row_number) END AS case_id,
           CASE WHEN problem IS NULL THEN dirs[1] || '/flow_0.vtu' ELSE '' END AS input_vtu,
           CASE WHEN problem IS NULL THEN output_vtu ELSE '' END AS output_vtu,
           CASE WHEN problem IS NULL THEN '/in/' || id || '.vti' ELSE '' END AS input_vti,
           CASE WHEN problem IS NULL THEN '/out/' || id || '.vti' ELSE '' END AS output_vti,
           CASE WHEN problem IS NOT NULL THEN 'discovery_failed' WHEN row_number % 3 = 0 THEN 'transform_failed' ELSE 'ok' END AS status,
           CASE WHEN problem IS NOT NULL THEN problem WHEN row_number % 3 = 0 THEN 'transform failed'
                ELSE 'input=created: created: a; output=skipped: output exists' END AS message
          FROM pairs)
"""


def manifest_table(spark, sf):
    found = pairs(spark, sf)
    outcomes = found.filter("problem is null").select(
        "case_id",
        F.when(F.col("row_number") % 3 == 0, F.lit("transform failed")).alias("error"),
        F.lit("created").alias("input_status"), F.lit("created: a").alias("input_message"),
        F.lit("skipped").alias("output_status"), F.lit("output exists").alias("output_message"),
    )
    return manifest.build_manifest(found, outcomes, "/in", "/out")


@query(f"{MANIFEST_SQL} SELECT * FROM m")
def pair_manifest(spark, sf):
    return manifest_table(spark, sf)


@query(
    f"""
    {MANIFEST_SQL}
    SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS successful, count(*) FILTER (status <> 'ok') AS failed,
           CASE WHEN bool_and(status = 'ok') THEN 'ok' ELSE 'partial_failure' END AS status FROM m
    """
)
def manifest_totals(spark, sf):
    return manifest.prep_totals(manifest_table(spark, sf))


@query(
    rf"""
    WITH files AS ({FILE_SQL}), have AS (SELECT DISTINCT path FROM files),
    q AS (SELECT c_custkey AS case_id, unnest(['/data/case_' || c_custkey || '/vtk/flow_0.vtu', '/data/case_' || c_custkey || '/vtk/flow_latest_x.vtu']) AS path FROM customer)
    SELECT case_id, CASE WHEN bool_and(have.path IS NOT NULL) THEN 'skipped' ELSE 'created' END AS status
    FROM q LEFT JOIN have USING (path) GROUP BY case_id
    """
)
def output_sets(spark, sf):
    key = F.col("c_custkey").cast("string")
    folder = F.concat(F.lit("/data/case_"), key, F.lit("/vtk/"))
    wanted = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("case_id"),
        F.explode(
            F.array(F.concat(folder, F.lit("flow_0.vtu")), F.concat(folder, F.lit("flow_latest_x.vtu")))
        ).alias("output"),
    )
    return ops.output_status(wanted, field_files(spark, sf), ["case_id"])


@query(
    r"""
    WITH g AS (SELECT p_type AS case_id, '/vtk/' || p_brand || '/' || p_name || '/internal.vtu' AS path FROM part)
    SELECT case_id, max(path) AS latest_file FROM g GROUP BY case_id
    """
)
def latest_generated(spark, sf):
    """The generated file that counts is the last one by path."""
    path = F.concat(F.lit("/vtk/"), "p_brand", F.lit("/"), "p_name", F.lit("/internal.vtu"))
    files = table(spark, sf, "part").select(F.col("p_type").alias("case_id"), path.alias("path"))
    return ops.latest_generated(files, ["case_id"])
