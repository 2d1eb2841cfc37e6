"""Streaming forms of the progress reports, run to the end of the given files."""


from catalog import query
from catalog.reports import COUNTS_SQL, STATE_SQL, results, state_events
from gridloom.session import scratch_path
from gridloom.streaming import progress


def landed(df, spark, name, parts=4):
    """The rows as files that arrive in a folder, and the stream over it."""
    path = scratch_path(spark, name)
    df.repartition(parts).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream, spark, keys):
    target, checkpoint = scratch_path(spark, "updates"), scratch_path(spark, "checkpoint")
    progress.start_updates(stream, target, checkpoint).awaitTermination()
    return progress.latest_update(spark.read.parquet(target), keys)


@query(
    f"""
    {COUNTS_SQL} SELECT batch_id, stage, count(*) AS processed, count(*) FILTER (status = 'created') AS created, count(*) FILTER (status = 'dry_run') AS dry_run,
       count(*) FILTER (status = 'meshed') AS meshed, count(*) FILTER (status = 'solved') AS solved, count(*) FILTER (status = 'continued') AS continued,
       count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed
    FROM c GROUP BY ALL
    """
)
def live_stage_progress(spark, sf):
    rows = results(spark, sf).select("batch_id", "stage", "status")
    return run(progress.stage_progress(landed(rows, spark, "results")), spark, ["batch_id", "stage"])


@query(
    f"""
    WITH e AS ({STATE_SQL}), l AS (SELECT batch_id, case_name, max(updated) AS updated, arg_max(stage, updated) AS stage, arg_max(message, updated) AS message FROM e GROUP BY ALL)
    SELECT * FROM l WHERE stage NOT IN ('error', 'purchase')
    """
)
def live_case_states(spark, sf):
    states = progress.case_state(landed(state_events(spark, sf), spark, "states"))
    return progress.active_only(run(states, spark, ["batch_id", "case_name"]), ["error", "purchase"])


@query(
    f"""
    WITH e AS ({STATE_SQL}), l AS (SELECT batch_id, case_name, max(updated) AS updated, arg_max(stage, updated) AS stage, arg_max(message, updated) AS message FROM e GROUP BY ALL)
    SELECT * FROM l WHERE stage NOT IN ('error', 'purchase')
    """
)
def live_case_lifecycle(spark, sf):
    """The same from keyed state that drops finished cases, kept in a compacted table."""
    keys, target = ["batch_id", "case_name"], scratch_path(spark, "cases")
    changes = progress.case_lifecycle(landed(state_events(spark, sf), spark, "states"), ["error", "purchase"])
    progress.start_compacted(changes, target, scratch_path(spark, "checkpoint"), keys, "gone", every=3).awaitTermination()
    return progress.current_rows(spark, target, keys, "gone")
