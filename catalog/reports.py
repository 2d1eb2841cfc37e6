"""Roll-ups of stage results, read from ``events`` as result rows."""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.operators import report

STAGE_NAMES = ["setup", "mesh", "flow", "transport", "post-processing"]
STATUS = {
    "setup": ["created", "dry_run", "skipped", "failed", "odd"],
    "mesh": ["meshed", "continued", "skipped", "failed", "odd"],
    "flow": ["solved", "continued", "skipped", "failed", "odd"],
    "transport": ["solved", "continued", "skipped", "failed", "odd"],
    "post-processing": ["completed", "skipped", "skipped", "failed", "odd"],
}

RESULTS_SQL = """
    SELECT cast(user_id % 40 AS varchar) AS batch_id, (['setup', 'mesh', 'flow', 'transport', 'post-processing'])[event_id % 5 + 1] AS stage,
      event_id, ts,
      CASE event_type WHEN 'click' THEN (['created', 'meshed', 'solved', 'solved', 'completed'])[event_id % 5 + 1]
        WHEN 'view' THEN (['dry_run', 'continued', 'continued', 'continued', 'skipped'])[event_id % 5 + 1]
        WHEN 'signup' THEN 'skipped' WHEN 'error' THEN ' "failed" ' ELSE 'odd' END AS status,
      CASE WHEN event_id % 3 = 0 THEN cast(event_id // 40 AS varchar) ELSE 'n/a' END AS row_number,
      CASE WHEN event_id % 50 = 7 THEN '' ELSE 'case_' || event_id // 5 END AS case_id,
      CASE WHEN event_id % 4 = 0 THEN 'mesh precondition not satisfied' ELSE 'see log: /w/logs/case_' || event_id || '.log' END AS message
    FROM events
"""


def results(spark, sf):
    e = F.col("event_id")

    def by_stage(options):
        return F.get(F.array(*[F.lit(o) for o in options]), (e % 5).cast("int"))

    kinds = [[STATUS[s][i] for s in STAGE_NAMES] for i in range(2)]
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", by_stage(kinds[0]))
        .when(kind == "view", by_stage(kinds[1]))
        .when(kind == "signup", F.lit("skipped"))
        .when(kind == "error", F.lit(' "failed" '))
        .otherwise(F.lit("odd"))
    )
    return table(spark, sf, "events").select(
        (F.col("user_id") % 40).cast("string").alias("batch_id"),
        by_stage(STAGE_NAMES).alias("stage"),
        e,
        "ts",
        status.alias("status"),
        F.when(e % 3 == 0, F.floor(e / 40).cast("string")).otherwise(F.lit("n/a")).alias("row_number"),
        F.when(e % 50 == 7, F.lit("")).otherwise(F.concat(F.lit("case_"), F.floor(e / 5).cast("string"))).alias("case_id"),
        F.when(e % 4 == 0, F.lit("mesh precondition not satisfied"))
        .otherwise(F.concat(F.lit("see log: /w/logs/case_"), e.cast("string"), F.lit(".log")))
        .alias("message"),
    )


COUNTS_SQL = f"""
    WITH r AS ({RESULTS_SQL}),
    c AS (SELECT batch_id, list_position(['setup', 'mesh', 'flow', 'transport', 'post-processing'], stage)::int AS stage_ordinal, stage,
            trim(replace(status, '"', '')) AS status FROM r),
    counts AS (SELECT batch_id, stage_ordinal, stage, count(*) AS total,
      count(*) FILTER (status IN ('created', 'dry_run', 'meshed', 'continued', 'solved', 'completed')) AS succeeded,
      count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'odd') AS other
      FROM c GROUP BY ALL)
"""


@query(f"{COUNTS_SQL} SELECT * FROM counts")
def stage_counts(spark, sf):
    return report.stage_counts(results(spark, sf))


@query(
    rf"""
    WITH r AS ({RESULTS_SQL})
    SELECT batch_id, list_position(['setup', 'mesh', 'flow', 'transport', 'post-processing'], stage)::int AS stage_ordinal, stage,
           CASE WHEN regexp_full_match(row_number, '\d+') THEN row_number::bigint ELSE 0 END AS row_number,
           CASE WHEN case_id = '' THEN 'unavailable' ELSE case_id END AS case_id,
           CASE WHEN event_id % 4 = 0 THEN 'unavailable' ELSE '/w/logs/case_' || event_id || '.log' END AS log_path
    FROM r WHERE status LIKE '%failed%'
    """
)
def failed_rows(spark, sf):
    return report.in_report_order(report.failed_rows(results(spark, sf)))


def run_tables(spark, sf):
    """Plan from all batches, execution records from some of them."""
    found = results(spark, sf)
    number = F.col("batch_id").cast("int")
    plan = found.select("batch_id").distinct().select(number.alias("ordinal"), "batch_id")
    batches = plan.filter("ordinal < 36").select(
        "batch_id", F.when(number % 4 == 0, F.lit("succeeded")).otherwise(F.lit("failed")).alias("batch_result")
    )
    stages = (
        found.select("batch_id", "stage")
        .distinct()
        .filter(~((number % 4 == 1) & F.col("stage").isin("flow", "transport")))
        .withColumn("stage_result", F.when(number % 4 == 0, F.lit("succeeded")).otherwise(F.lit("failed")))
    )
    return plan, batches, stages, found


@query(
    f"""
    {COUNTS_SQL}, p AS (SELECT DISTINCT batch_id, batch_id::int AS ordinal FROM r),
    g AS (SELECT p.*, unnest(['mesh', 'flow', 'transport']) AS stage, CASE WHEN ordinal % 4 = 0 THEN 'succeeded' ELSE 'failed' END AS batch_result
          FROM p WHERE ordinal < 36),
    j AS (SELECT g.*, c.* EXCLUDE (batch_id, stage, stage_ordinal),
            c.total IS NOT NULL AND NOT (ordinal % 4 = 1 AND g.stage IN ('flow', 'transport')) AS ran FROM g
          LEFT JOIN counts c ON c.batch_id = g.batch_id AND c.stage = g.stage)
    SELECT ordinal, batch_id, batch_result, list_position(['setup', 'mesh', 'flow', 'transport', 'post-processing'], stage)::int AS stage_ordinal, stage,
           CASE WHEN ran THEN batch_result ELSE 'not_attempted' END AS stage_result, CASE WHEN ran THEN 'available' ELSE 'unavailable' END AS summary,
           CASE WHEN ran THEN total::varchar ELSE 'unknown' END AS total, CASE WHEN ran THEN succeeded::varchar ELSE 'unknown' END AS succeeded,
           CASE WHEN ran THEN skipped::varchar ELSE 'unknown' END AS skipped, CASE WHEN ran THEN failed::varchar ELSE 'unknown' END AS failed,
           CASE WHEN ran THEN other::varchar ELSE 'unknown' END AS other
    FROM j
    """
)
def run_report(spark, sf):
    plan, batches, stages, found = run_tables(spark, sf)
    return report.run_report(plan, batches, stages, found, ["flow", "mesh", "transport"])


@query(
    f"""
    WITH r AS ({RESULTS_SQL}), p AS (SELECT DISTINCT batch_id::int AS o FROM r)
    SELECT count(*) AS requested, count(*) FILTER (o < 36) AS attempted, count(*) FILTER (o < 36 AND o % 4 = 0) AS succeeded,
           count(*) FILTER (o < 36 AND o % 4 <> 0) AS failed, count(*) FILTER (o >= 36) AS not_started FROM p
    """
)
def run_totals(spark, sf):
    plan, batches, _, _ = run_tables(spark, sf)
    return report.run_totals(plan, batches)


@query(
    f"""
    WITH r AS ({RESULTS_SQL}), c AS (SELECT batch_id, stage, trim(replace(status, '"', '')) AS s FROM r),
    n AS (SELECT batch_id, stage, count(*) AS processed, count(*) FILTER (s = 'created') AS created, count(*) FILTER (s = 'dry_run') AS dry_run,
            count(*) FILTER (s = 'meshed') AS meshed, count(*) FILTER (s = 'solved') AS solved, count(*) FILTER (s = 'continued') AS continued,
            count(*) FILTER (s = 'completed') AS completed, count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'failed') AS failed
          FROM c GROUP BY ALL),
    t AS (SELECT *, processed + 3 AS total, 5::bigint AS running, processed - 2 AS started FROM n)
    SELECT *, CASE stage WHEN 'mesh' THEN meshed + continued + skipped + failed WHEN 'flow' THEN solved + continued + failed ELSE processed END AS done,
           CASE stage WHEN 'mesh' THEN greatest(0, total - (meshed + continued + skipped + failed) - running)
                WHEN 'transport' THEN greatest(0, total - started) END AS pending
    FROM t
    """
)
def stage_progress(spark, sf):
    found = results(spark, sf)
    totals = found.groupBy("batch_id", "stage").agg(F.count(F.lit(1)).alias("n")).select(
        "batch_id", "stage", (F.col("n") + 3).alias("total"), F.lit(5).cast("bigint").alias("running"),
        (F.col("n") - 2).alias("started"),
    )
    return report.progress(found, totals)


@query(
    f"""
    WITH r AS ({RESULTS_SQL})
    SELECT batch_id, count(DISTINCT CASE WHEN case_id <> '' THEN case_id END) AS cases, count(*) AS rows FROM r GROUP BY batch_id
    """
)
def total_cases(spark, sf):
    rows = results(spark, sf).withColumn("raw_case", F.col("case_id"))
    return report.total_cases(rows, ["batch_id"])


STATE_SQL = """
    SELECT cast(user_id % 7 AS varchar) AS batch_id, 'case_' || user_id || '/flow' AS case_name, ts AS updated, event_type AS stage,
           'event ' || event_id AS message FROM events
"""


def state_events(spark, sf):
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        (user % 7).cast("string").alias("batch_id"),
        F.concat(F.lit("case_"), user.cast("string"), F.lit("/flow")).alias("case_name"),
        F.col("ts").alias("updated"),
        F.col("event_type").alias("stage"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
    )


@query(
    f"""
    WITH e AS ({STATE_SQL})
    SELECT batch_id, case_name, max(updated) AS updated, arg_max(stage, updated) AS stage, arg_max(message, updated) AS message
    FROM e GROUP BY batch_id, case_name
    """
)
def latest_case_states(spark, sf):
    return report.latest_state(state_events(spark, sf))


@query(
    f"""
    WITH e AS ({STATE_SQL}),
    l AS (SELECT batch_id, case_name, max(updated) AS updated, arg_max(stage, updated) AS stage, arg_max(message, updated) AS message FROM e GROUP BY ALL),
    a AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY case_name)::int AS rank, greatest(count(*) OVER (PARTITION BY batch_id) - 5, 0) AS more
          FROM l WHERE stage NOT IN ('error', 'purchase'))
    SELECT * FROM a WHERE rank <= 5
    """
)
def active_cases(spark, sf):
    return report.active_cases(state_events(spark, sf), ["error", "purchase"], k=5)


@query(
    """
    SELECT conv_id AS case_name, arg_max(role, turn) AS role, max(turn) AS turn, arg_max(text, turn) AS text
    FROM conversations GROUP BY conv_id
    """
)
def latest_turns(spark, sf):
    """Latest record per key where the order is a number."""
    turns = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("case_name"), F.col("turn").alias("updated"), "role", "text"
    )
    return report.latest_state(turns, ["case_name"]).withColumnRenamed("updated", "turn")
