"""Decisions about the rows of a batch table."""

from pyspark.sql import functions as F

from catalog import query, table
from catalog.workspace import INV_SQL, inventory
from gridloom.operators import cases
from gridloom.operators.inventory import case_dirs
from gridloom.operators.order import first_of_group

# Rows of a run: four rows per case, some without a case, over five batch files.
ROWS_SQL = """
    SELECT cast((event_id // 4) % 5 AS varchar) AS batch_id, user_id % 5 AS file_ord, event_id AS row_number,
           CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN ' case_' || event_id // 4
                ELSE cast(event_id // 4 AS varchar) END AS raw_case,
           CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'case_' || event_id // 4 END AS id
    FROM events
"""


def case_rows(spark, sf):
    case = F.floor(F.col("event_id") / 4)
    text = case.cast("string")
    raw = (
        F.when(F.col("event_id") % 11 == 0, F.lit(""))
        .when(F.col("event_id") % 13 == 0, F.concat(F.lit(" case_"), text))
        .otherwise(text)
    )
    return table(spark, sf, "events").select(
        (case % 5).cast("string").alias("batch_id"),
        (F.col("user_id") % 5).alias("file_ord"),
        F.col("event_id").alias("row_number"),
        raw.alias("raw_case"),
    )


JUDGED_SQL = f"""
    WITH inv AS ({INV_SQL}), r AS ({ROWS_SQL}),
    f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_ord, row_number) AS n FROM r),
    have AS (SELECT batch_id, case_id, bool_or(domain = 'flow') AS has_flow, bool_or(domain = 'trd') AS has_trd FROM inv GROUP BY ALL),
    j AS (SELECT f.*, coalesce(has_flow, false) AS has_flow, coalesce(has_trd, false) AS has_trd, h.case_id IS NOT NULL AS has_any
          FROM f LEFT JOIN have h ON h.batch_id = f.batch_id AND h.case_id = f.id)
"""
ROOT = "'/ws/batch_' || batch_id || '/' || id"


@query(
    f"""
    {JUDGED_SQL}
    SELECT batch_id, file_ord, row_number, raw_case, coalesce(id, '') AS case_id, coalesce(id || '/flow', '') AS case_name,
           coalesce({ROOT} || '/flow', '') AS case_dir,
           CASE WHEN id IS NULL OR n > 1 OR NOT has_flow THEN 'skipped' END AS status,
           CASE WHEN id IS NULL THEN 'missing Case' WHEN n > 1 THEN 'duplicate case id'
                WHEN NOT has_flow THEN 'case directory not found' END AS message
    FROM j
    """
)
def mesh_row_decisions(spark, sf):
    return cases.classify_rows(case_rows(spark, sf), case_dirs(inventory(spark, sf)), "mesh", "/ws")


@query(
    f"""
    {JUDGED_SQL}
    SELECT batch_id, file_ord, row_number, raw_case, coalesce(id, '') AS case_id,
           coalesce(id || '/flow|' || id || '/trd', '') AS case_name, coalesce({ROOT} || '/trd', '') AS case_dir,
           CASE WHEN id IS NULL OR n > 1 THEN 'skipped' WHEN NOT has_flow OR NOT has_trd THEN 'failed' END AS status,
           CASE WHEN id IS NULL THEN 'missing Case' WHEN n > 1 THEN 'duplicate case id'
                WHEN NOT has_flow THEN 'flow case directory not found: ' || {ROOT} || '/flow'
                WHEN NOT has_trd THEN 'transport case directory not found: ' || {ROOT} || '/trd' END AS message
    FROM j
    """
)
def transport_row_decisions(spark, sf):
    return cases.classify_rows(case_rows(spark, sf), case_dirs(inventory(spark, sf)), "transport", "/ws")


@query(
    f"""
    {JUDGED_SQL}
    SELECT batch_id, file_ord, row_number, raw_case, id AS case_id, id AS case_name, {ROOT} AS case_dir,
           CASE WHEN NOT has_any THEN 'failed' END AS status,
           CASE WHEN NOT has_any THEN 'case directory not found' END AS message
    FROM j WHERE id IS NOT NULL AND n = 1
    """
)
def post_row_decisions(spark, sf):
    return cases.classify_rows(case_rows(spark, sf), case_dirs(inventory(spark, sf)), "post-processing", "/ws")


@query(
    """
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS is_first FROM events
    """
)
def first_rows(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id")
    return first_of_group(rows, ["user_id"], ["event_id"], "is_first")


SETUP_SQL = """
    WITH r AS (SELECT c_custkey AS row_number, cast(c_nationkey % 4 AS varchar) AS batch_id,
                 CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS raw_case,
                 CASE WHEN c_custkey % 13 = 0 THEN 'calm' ELSE printf('%.2f', c_acctbal) END AS ws,
                 CASE WHEN c_custkey % 19 = 0 THEN 'north' ELSE printf('%.2f', c_acctbal * 3) END AS wd, c_acctbal FROM customer),
    c AS (SELECT *, CASE WHEN raw_case = '' THEN 'NA' ELSE 'case_' || replace(raw_case, '#', '_') END AS case_id FROM r),
    e AS (SELECT DISTINCT cast(c_nationkey % 4 AS varchar) AS batch_id, 'case_' || replace(c_name, '#', '_') AS case_id,
             CASE o_orderstatus WHEN 'F' THEN 'flow' ELSE 'trd' END AS domain
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O' AND o_totalprice > 400000),
    j AS (SELECT c.*, CASE WHEN ws = 'calm' THEN 'invalid WS' WHEN wd = 'north' THEN 'invalid WD' WHEN c_acctbal <= 0 {zero} END AS early FROM c),
    x AS (SELECT j.*, unnest(CASE WHEN early IS NULL THEN ['flow', 'trd'] ELSE [NULL] END) AS domain FROM j)
    SELECT x.row_number, x.batch_id, x.raw_case, x.ws AS raw_ws, x.wd AS raw_wd, x.case_id,
           CASE WHEN x.domain IS NULL THEN '' ELSE x.case_id || '/' || x.domain END AS case_name,
           CASE WHEN early IN ('invalid WS', 'invalid WD') THEN x.wd ELSE
             printf('%.3f', x.wd::double - 360 * floor(x.wd::double / 360)) END AS wd, x.ws,
           CASE WHEN x.domain IS NULL THEN '' ELSE x.ws END AS ws_for_setup,
           CASE WHEN x.domain IS NULL THEN '' ELSE '/ws/batch_' || x.batch_id || '/' || x.case_id || '/' || x.domain END AS case_dir,
           CASE WHEN early LIKE 'WS<=0%' THEN 'skipped' WHEN early IS NOT NULL THEN 'failed' {valid_status} END AS status,
           CASE WHEN early IS NOT NULL THEN early {valid_message} END AS message
    FROM x LEFT JOIN e ON e.batch_id = x.batch_id AND e.case_id = x.case_id AND e.domain = x.domain
"""
THERE = (
    "(e.domain IS NOT NULL OR row_number() OVER (PARTITION BY x.batch_id, x.case_id, x.domain ORDER BY x.row_number) > 1)"
)
KIND = "CASE x.domain WHEN 'flow' THEN 'flow' ELSE 'transport' END"


def setup_rows(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        k.alias("row_number"),
        (F.col("c_nationkey") % 4).cast("string").alias("batch_id"),
        F.when(k % 17 == 0, F.lit("")).otherwise(F.col("c_name")).alias("raw_case"),
        F.when(k % 13 == 0, F.lit("calm")).otherwise(F.format_string("%.2f", "c_acctbal")).alias("raw_ws"),
        F.when(k % 19 == 0, F.lit("north")).otherwise(F.format_string("%.2f", F.col("c_acctbal") * 3)).alias("raw_wd"),
    )
    late = table(spark, sf, "orders").filter("o_orderstatus <> 'O' and o_totalprice > 400000")
    existing = late.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        (F.col("c_nationkey") % 4).cast("string").alias("batch_id"),
        F.concat(F.lit("case_"), F.translate("c_name", "#", "_")).alias("case_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("flow")).otherwise(F.lit("trd")).alias("domain"),
    )
    return rows, existing


@query(
    SETUP_SQL.format(
        zero="AND false THEN ''",
        valid_status=f"WHEN {THERE} THEN 'skipped' ELSE 'created'",
        valid_message=f"WHEN {THERE} THEN {KIND} || ' case already exists' ELSE {KIND} || ' case created'",
    )
)
def setup_decisions(spark, sf):
    rows, existing = setup_rows(spark, sf)
    return cases.setup_status(rows, existing, "/ws", mode="keep")


@query(
    SETUP_SQL.format(
        zero="THEN 'WS<=0 and ZERO_WS_MODE=skip'",
        valid_status="ELSE 'dry_run'",
        valid_message=f"ELSE 'would create ' || {KIND} || ' case'",
    )
)
def setup_dry_run(spark, sf):
    rows, existing = setup_rows(spark, sf)
    return cases.setup_status(rows, existing, "/ws", mode="skip", dry_run=True)


PATCHES = [
    ("f18p1_seb_a", "P1_SEB_A__Uexit_mps", "P1_SEB_A_U"),
    ("f18p1_aex_b", "P1_AEX_B__Uexit_mps", "P1_AEX_B_U"),
    ("f18p2_voc_a", "P2_VOC_A__Uexit_mps", "P2_VOC_A_U"),
    ("f18p3_sex_b", "P3_SEX_B__Uexit_mps", "P3_SEX_B_U"),
]


@query(
    """
    WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest([
        {'patch': 'f18p1_seb_a', 'col': 'P1_SEB_A__Uexit_mps', 'old': 'P1_SEB_A_U', 'v': cast(cast(l_quantity AS int) AS varchar), 'o': '99'},
        {'patch': 'f18p1_aex_b', 'col': 'P1_AEX_B__Uexit_mps', 'old': 'P1_AEX_B_U', 'v': CASE WHEN l_linenumber > 3 THEN '' ELSE '7' END, 'o': '(1 0 0)'},
        {'patch': 'f18p2_voc_a', 'col': 'P2_VOC_A__Uexit_mps', 'old': 'P2_VOC_A_U', 'v': l_returnflag, 'o': ''},
        {'patch': 'f18p3_sex_b', 'col': 'P3_SEX_B__Uexit_mps', 'old': 'P3_SEX_B_U', 'v': '', 'o': ''}]) AS d FROM lineitem),
    p AS (SELECT *, coalesce(nullif(d.v, ''), nullif(d.o, '')) AS raw, d.v <> '' AS is_new FROM c)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, d.patch AS patch, raw AS raw_value,
           CASE WHEN raw LIKE '(%' THEN 'uniform ' || raw WHEN raw SIMILAR TO '[0-9]+' THEN 'uniform (0 0 ' || raw || ')' END AS boundary,
           CASE WHEN raw IS NULL THEN 'CSV velocity column missing or empty: ' || d.col || '; skip ' || d.patch
                WHEN NOT (raw LIKE '(%' OR raw SIMILAR TO '[0-9]+') THEN 'Invalid velocity value ''' || raw || ''' for ' ||
                     CASE WHEN is_new THEN d.col ELSE d.old END || '; skip ' || d.patch END AS warning
    FROM p
    """
)
def stack_boundaries(spark, sf):
    params = F.create_map(
        F.lit("p1_seb_a__uexit_mps"), F.col("l_quantity").cast("int").cast("string"),
        F.lit("p1_seb_a_u"), F.lit("99"),
        F.lit("p1_aex_b__uexit_mps"), F.when(F.col("l_linenumber") > 3, F.lit(" ")).otherwise(F.lit("7")),
        F.lit("p1_aex_b_u"), F.lit("(1 0 0)"),
        F.lit("p2_voc_a__uexit_mps"), F.col("l_returnflag"),
    )
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", params.alias("params")
    )
    return cases.stack_boundaries(rows, "params", "Uexit_mps", PATCHES)


FIELDS_SQL = """
    WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'LES' ELSE 'RAS' END AS sim,
                 (['kOmega', 'kOmegaSST', 'kEpsilon', 'realizableKE', 'other'])[p_size % 5 + 1] AS model FROM part),
    q AS (SELECT *, CASE WHEN sim = 'LES' THEN ['U', 'p', 'nut'] WHEN model IN ('kOmega', 'kOmegaSST') THEN ['U', 'p', 'k', 'nut', 'omega']
                 WHEN model <> 'other' THEN ['U', 'p', 'k', 'nut', 'epsilon'] END AS required FROM c),
    h AS (SELECT DISTINCT l_partkey AS p_partkey, (['U', 'p', 'k', 'nut', 'omega', 'epsilon', 'T'])[l_linenumber % 7 + 1] AS field FROM lineitem)
"""


def turbulence_cases(spark, sf):
    sim = F.when(F.col("p_partkey") % 3 == 0, F.lit("LES")).otherwise(F.lit("RAS"))
    model = F.get(
        F.array(*[F.lit(m) for m in ("kOmega", "kOmegaSST", "kEpsilon", "realizableKE", "other")]), F.col("p_size") % 5
    )
    settings = table(spark, sf, "part").select("p_partkey", cases.required_fields(sim, model).alias("required"))
    names = F.array(*[F.lit(f) for f in ("U", "p", "k", "nut", "omega", "epsilon", "T")])
    present = (
        table(spark, sf, "lineitem")
        .select(F.col("l_partkey").alias("p_partkey"), F.get(names, F.col("l_linenumber") % 7).alias("field"))
        .distinct()
    )
    return settings, present


@query(
    f"""
    {FIELDS_SQL}
    SELECT p_partkey, field FROM (SELECT p_partkey, unnest(required) AS field FROM q)
    EXCEPT SELECT p_partkey, field FROM h
    """
)
def missing_fields(spark, sf):
    settings, present = turbulence_cases(spark, sf)
    return cases.missing_fields(settings, present, ["p_partkey"])


@query(
    f"""
    {FIELDS_SQL}
    SELECT h.p_partkey, h.field FROM h JOIN q USING (p_partkey)
    WHERE h.field <> 'T' AND required IS NOT NULL AND NOT list_contains(required, h.field)
    """
)
def extra_fields(spark, sf):
    settings, present = turbulence_cases(spark, sf)
    return cases.extra_fields(settings, present, ["p_partkey"])


@query(
    """
    WITH a AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders),
    b AS (SELECT o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders)
    SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)
    """
)
def table_differences(spark, sf):
    orders = table(spark, sf, "orders")
    changed = F.when(F.col("o_orderkey") % 97 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    a = orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    b = orders.select("o_custkey", changed.alias("o_orderstatus"), "o_orderpriority")
    return cases.same_table(a, b)
