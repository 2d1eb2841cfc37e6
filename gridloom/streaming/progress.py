"""Live progress of stages and cases.

Result and state rows must land as new files (or in a table): a file source
never reads a file again that grew. State is one row per batch and stage, or
one row per case, which the experiment table bounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridloom.operators.report import clean, progress_counters


def stage_progress(results: DataFrame) -> DataFrame:
    """Counters per batch and stage over everything that has landed."""
    return results.groupBy("batch_id", "stage").agg(*progress_counters(clean(F.col("status"))))


def case_state(events: DataFrame) -> DataFrame:
    """Latest state per case: batch_id, case_name, stage, message, updated."""
    latest = events.groupBy("batch_id", "case_name").agg(
        F.max(F.struct("updated", "stage", "message")).alias("_s")
    )
    return latest.select(
        "batch_id", "case_name", F.col("_s.stage").alias("stage"),
        F.col("_s.message").alias("message"), F.col("_s.updated").alias("updated"),
    )


_STATE = "updated bigint, stage string, message string"


def case_lifecycle(events: DataFrame, finished: Sequence[str], forget_ms: int = 3_600_000) -> DataFrame:
    """Changes of the latest state per case, with ``gone`` where its stage is a finished one.

    ``events``: batch_id, case_name, updated, stage, message. A case is a row of
    state while it runs. When it has finished, its last event is remembered
    until nothing came for ``forget_ms``, so that older events that land late
    don't bring it back, and then a timer removes it. A newer event opens the
    case again. An event that is no news gives no row. Start it with
    ``start_compacted``.
    """
    ended = tuple(finished)

    def rank(row):  # nulls come first, as in max(struct)
        return tuple((v is not None, v) for v in row)

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = newest = tuple(state.get) if state.exists else None
        # A group is a few rows: plain values cost far less here than operations on small frames.
        for part in parts:
            for found in zip(*(part[c].tolist() for c in ("updated", "stage", "message"))):
                updated, *rest = (None if pd.isna(v) else v for v in found)
                row = (None if updated is None else int(updated), *rest)
                newest = row if newest is None or rank(row) > rank(newest) else newest
        gone = newest[1] in ended
        state.update(newest)
        if gone:
            state.setTimeoutDuration(forget_ms)
        if newest != held:
            updated, stage, message = newest
            yield pd.DataFrame(
                {"batch_id": [key[0]], "case_name": [key[1]], "updated": pd.array([updated], dtype="Int64"),
                 "stage": [stage], "message": [message], "gone": [gone]}
            )

    named = events.select(
        F.col("batch_id").cast("string"), F.col("case_name").cast("string"),
        F.unix_micros(F.col("updated").cast("timestamp")).alias("updated"), "stage", "message",
    )
    changed = named.groupBy("batch_id", "case_name").applyInPandasWithState(
        step,
        f"batch_id string, case_name string, {_STATE}, gone boolean",
        _STATE,
        "update",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    return changed.withColumn("updated", F.timestamp_micros("updated"))


def active_only(states: DataFrame, finished: Sequence[str]) -> DataFrame:
    return states.filter(~F.col("stage").isin(*finished))


def start_updates(
    df: DataFrame, target: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write every changed group of each trigger below ``target``.

    A trigger owns one folder and rewrites it when it is retried, so a lost
    executor or a restart cannot count twice. Without an interval the query
    takes what is there and ends.
    """
    def write(batch: DataFrame, batch_no: int) -> None:
        (
            batch.withColumn("_trigger", F.lit(batch_no).cast("bigint"))
            .write.mode("overwrite")
            .parquet(f"{target}/trigger={batch_no}")
        )

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def latest_update(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of what ``start_updates`` wrote."""
    rest = [c for c in updates.columns if c not in (*keys, "_trigger", "trigger")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_trigger").alias("_s"))
    return newest.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in rest])


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders below ``path`` that were written to their end."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    numbers = [s.getPath().getName() for s in files.listStatus(where)]
    done = [n for n in numbers if n.isdigit() and files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[1])]
    return sorted(map(int, done))


def start_compacted(
    df: DataFrame, target: str, checkpoint: str, keys: Sequence[str], gone: str | None = None,
    interval: str | None = None, every: int = 16, files: int = 8,
) -> StreamingQuery:
    """Keep the newest row per key below ``target`` in a bounded number of files.

    ``interval`` is the least time between two updates; without it the query
    takes what is there and ends, which forces the last update of a run. Each
    trigger writes its changed rows to ``delta/<trigger>``. Every ``every``
    triggers they are merged with the last whole table into ``base/<trigger>``,
    without rows that are ``gone``. What the base before has replaced is
    deleted, so one that is being read stays for ``every`` triggers. A
    repeated trigger rewrites its own folders; they count once.
    """
    keys = list(keys)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bases = _versions(spark, f"{target}/base")
        if bases and bases[-1] >= number:
            return  # this trigger ended after its base was written
        batch.repartition(files).withColumn("_trigger", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{target}/delta/{number}")
        if (number + 1) % every:
            return
        merged = _newest(spark, target, keys)
        merged = merged.where(~F.coalesce(F.col(gone), F.lit(False))) if gone else merged
        merged.write.mode("overwrite").parquet(f"{target}/base/{number}")
        last = bases[-1] if bases else -1
        for kind, old in (("delta", lambda n: n <= last), ("base", lambda n: n < last)):
            for n in filter(old, _versions(spark, f"{target}/{kind}")):
                store, where = _folder(spark, f"{target}/{kind}/{n}")
                store.delete(where, True)

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if interval:
        return writer.trigger(processingTime=interval).start()
    # State with timers asks for batches without data for ever, so a run that is to end does without them.
    conf, name = df.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")  # the query takes a copy of the settings when it starts
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(name, before)


def _newest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    bases, deltas = _versions(spark, f"{target}/base"), _versions(spark, f"{target}/delta")
    paths = [f"{target}/base/{n}" for n in bases[-1:]]
    paths += [f"{target}/delta/{n}" for n in deltas if not bases or n > bases[-1]]
    if not paths:
        raise ValueError(f"no update has been written below {target}")
    rows = spark.read.parquet(*paths)
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), "_trigger").alias("_s"))
    return newest.select(*keys, "_s.*")


def current_rows(spark: SparkSession, target: str, keys: Sequence[str], gone: str | None = None) -> DataFrame:
    """The newest row per key of what ``start_compacted`` keeps, without those that are ``gone``."""
    rows = _newest(spark, target, keys).drop("_trigger")
    return rows.where(~F.coalesce(F.col(gone), F.lit(False))).drop(gone) if gone else rows
