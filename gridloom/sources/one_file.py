"""One sorted file that many tasks write."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def in_one_task(lines: DataFrame, path: str, header: str = "") -> None:
    """The sorted lines as one text file that a single task writes, after the header."""

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if header:
            yield pa.RecordBatch.from_pydict({"line": [header]})
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], ["line"])  # nullable, as the header's batch

    made = lines.select("line").coalesce(1).mapInArrow(with_header, "line string")
    made.write.mode("overwrite").text(path)
    spark = lines.sparkSession
    if header and spark.read.text(path).isEmpty():  # Spark runs no task over a table that it knows to be empty
        spark.createDataFrame([(header,)], "line string").coalesce(1).write.mode("overwrite").text(path)


def write_one_file(lines: DataFrame, path: str, name: str, header: str = "") -> None:
    """Write the column ``line`` of sorted rows as the file ``name``, alone in the folder ``path``.

    The sorted parts are written by their tasks. In a mounted folder, which all
    machines see as files, each part is then copied by a task to its place in
    the one file, so no task and no driver handles the whole; a task that runs
    again writes the same bytes to the same place. Other stores can't write in
    the middle of a file: there one task writes all of it. What stood in
    ``path`` goes once the new file is complete. Without rows the file holds
    the header alone.
    """
    spark = lines.sparkSession
    fs, at = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    if fs.getScheme() != "file":
        in_one_task(lines, path, header)
        return
    work = f"{path.rstrip('/')}._work-{uuid.uuid4().hex}"
    lines.select("line").write.option("compression", "none").text(f"{work}/parts")
    listed = [(s.getPath().toUri().getPath(), s.getLen()) for s in fs.listStatus(at(f"{work}/parts"))]
    parts, head = [], f"{header}\n".encode() if header else b""
    end = len(head)
    for part, size in sorted(p for p in listed if p[0].rsplit("/", 1)[1].startswith("part-")):
        parts.append((part, end))
        end += size
    fs.mkdirs(at(f"{work}/out"))
    target = at(f"{work}/out/{name}").toUri().getPath()
    with open(target, "wb") as out:
        out.write(head)
        out.truncate(end)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            copied = 0
            for part, start in zip(b["part"], b["start"]):
                with open(part, "rb") as source, open(target, "r+b") as out:
                    out.seek(start)
                    shutil.copyfileobj(source, out, 1 << 20)
                    copied += out.tell() - start
            yield pd.DataFrame({"copied": [copied]})

    if parts:
        dealt = spark.createDataFrame(parts, "part string, start long").repartition(len(parts))
        copied = dealt.mapInPandas(copy, "copied long").agg(F.sum("copied")).first()[0]
        if len(head) + copied != end:
            raise OSError(f"{path}: {copied} of {end - len(head)} bytes were copied")
    fs.delete(at(path), True)
    if not fs.rename(at(f"{work}/out"), at(path)):
        raise OSError(f"{path}: the new file could not be put in place")
    fs.delete(at(work), True)
