import datetime
import time
from pathlib import Path

import pytest

from gridloom.streaming import progress
from tests.conftest import rows

SCHEMA = "batch_id string, case_name string, updated timestamp, stage string, message string"
KEYS = ["batch_id", "case_name"]


def at(second):
    return datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=second)


class Feed:
    """A folder where events land, the compacted table made of them, and one run over what is new."""

    def __init__(self, spark, root, forget_ms=3_600_000, every=3):
        self.spark, self.root, self.forget_ms, self.every, self.landed = spark, root, forget_ms, every, 0

    def land(self, *events):
        self.landed += 1
        made = [("0", case, at(second), stage, note) for case, second, stage, note in events]
        self.spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{self.root}/in/{self.landed}")

    def start(self, interval=None):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/in/*")
        changes = progress.case_lifecycle(stream, ["done"], self.forget_ms)
        return progress.start_compacted(changes, f"{self.root}/out", f"{self.root}/mark", KEYS, "gone", interval, self.every, files=1)

    def run(self):
        query = self.start()
        query.awaitTermination()
        return query

    def active(self):
        return rows(progress.current_rows(self.spark, f"{self.root}/out", KEYS, "gone"), "case_name", "stage", "message")


def state_keys(spark, root):
    return spark.read.format("statestore").load(f"{root}/mark").count()


def test_a_finished_case_leaves_and_late_events_do_not_bring_it_back(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(("a", 1, "mesh", "x"), ("b", 1, "mesh", None), ("c", 1, None, None))
    feed.run()
    assert feed.active() == [("a", "mesh", "x"), ("b", "mesh", None), ("c", None, None)]
    feed.land(("a", 5, "done", "x"), ("b", 1, "mesh", "y"))  # of equal times the greater row counts
    feed.run()
    assert feed.active() == [("b", "mesh", "y"), ("c", None, None)]
    feed.land(("a", 3, "solve", "late"))
    feed.run()
    assert feed.active() == [("b", "mesh", "y"), ("c", None, None)]
    feed.land(("a", 9, "mesh", "again"))
    feed.run()
    assert feed.active() == [("a", "mesh", "again"), ("b", "mesh", "y"), ("c", None, None)]


def test_the_state_of_a_finished_case_is_removed_by_its_timer(spark, tmp_path):
    feed = Feed(spark, tmp_path, forget_ms=1)
    feed.land(("a", 1, "done", "x"), ("b", 1, "mesh", "x"))
    feed.run()
    time.sleep(0.1)
    feed.land(("b", 2, "solve", "x"))
    feed.run()
    assert state_keys(spark, tmp_path) == 1
    assert feed.active() == [("b", "solve", "x")]


def test_files_stay_bounded_and_a_restart_counts_nothing_twice(spark, tmp_path):
    feed = Feed(spark, tmp_path, every=2)
    for i in range(9):
        feed.land((f"c{i % 3}", i, "mesh", str(i)))
        if i % 4 == 3:
            feed.run()
    feed.run()
    assert feed.active() == [("c0", "mesh", "6"), ("c1", "mesh", "7"), ("c2", "mesh", "8")]
    assert len(list(Path(tmp_path, "out", "delta").iterdir())) <= 4
    assert len(list(Path(tmp_path, "out", "base").iterdir())) <= 2
    # A trigger that ended after its base was written is repeated: the marks of its end are lost.
    last = max(int(p.name) for p in Path(tmp_path, "mark", "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        Path(tmp_path, "mark", "commits", name).unlink(missing_ok=True)
    feed.run()
    assert feed.active() == [("c0", "mesh", "6"), ("c1", "mesh", "7"), ("c2", "mesh", "8")]


def test_an_interval_bounds_the_updates_and_the_last_run_is_forced(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(("a", 1, "mesh", "x"))
    query = feed.start("1 hour")
    while not progress._versions(spark, f"{tmp_path}/out/delta"):
        assert query.isActive
        time.sleep(0.1)
    feed.land(("a", 2, "solve", "x"))
    time.sleep(1)
    assert feed.active() == [("a", "mesh", "x")]
    query.stop()
    feed.run()
    assert feed.active() == [("a", "solve", "x")]


def test_counters_without_keyed_state_are_compacted_too(spark, tmp_path):
    for i, status in enumerate(("created", "failed", "created")):
        made = spark.createDataFrame([("0", "mesh", status)], "batch_id string, stage string, status string")
        made.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("batch_id string, stage string, status string").option("maxFilesPerTrigger", 1)
    counted = progress.stage_progress(stream.parquet(f"{tmp_path}/in/*"))
    keys = ["batch_id", "stage"]
    progress.start_compacted(counted, f"{tmp_path}/out", f"{tmp_path}/mark", keys, every=2).awaitTermination()
    assert rows(progress.current_rows(spark, f"{tmp_path}/out", keys), "processed", "created", "failed") == [(3, 2, 1)]


def test_nothing_written_yet_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no update"):
        progress.current_rows(spark, f"{tmp_path}/out", KEYS)
