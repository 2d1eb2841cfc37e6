"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Bytes of rows that Spark hands to Python at once. Its own bound is 256 MB, so a whole split of texts is one batch,
#: which the JVM holds as vectors and again as a message, and the Python worker once more.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def build_session(app: str = "gridloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Values given by the cluster (spark-submit, spark-defaults) win over these.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        BATCH_BYTES[0]: BATCH_BYTES[1],
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Have rows handed to Python a few megabytes at a time, unless the session names a bound of its own."""
    name, bound = BATCH_BYTES
    if name not in spark.conf.getAll:
        spark.conf.set(name, bound)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    ``spark.checkpoint.dir`` names it. Only a local session may fall back to a
    temporary folder of this machine, because there the driver and the tasks
    share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs inside; those from before come back."""
    own = spark.conf.getAll
    before = {name: own.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cut_lineage(df: DataFrame, **conf: str) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    A columnar table keeps column pruning for its readers, and a lost executor
    costs no more than reading it again. ``conf`` holds while it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    with settings(spark, conf):
        df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held._scratch = path
    return held


def release(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more."""
    for table in tables:
        path = vars(table).pop("_scratch", None)
        if path:
            jvm = table.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
