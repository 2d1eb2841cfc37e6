"""Helpers that several of the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridloom.session import cut_lineage, release

#: Rows of a table that may be broadcast; a larger side is left to a shuffle join.
BROADCAST_ROWS = 200_000

#: Everything in ASCII that is neither a digit nor a letter; a word is what stands between.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order (runs of digits, ASCII letters and non-ASCII characters)."""
    return F.array_remove(F.split(text, NOT_WORD), "")


def shingles(text: Column, size: int = 5) -> Column:
    """Hashes of all runs of ``size`` words, by the run's first word; a shorter text has none."""
    return let(
        F.transform(words(F.lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w)),
        lambda h: F.when(
            F.size(h) >= size,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def bounded_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a table whose row count is known to be small; leave a larger one to Spark's own choice."""
    n = df.limit(limit + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, columns: Sequence[str], name: str = "row") -> DataFrame:
    """``columns`` with a row number that is the same each time the result is read, on any number of executors.

    The number is the rank of the row's Parquet file by its path (times 2^40)
    and the row's place in it; how a scan is cut into tasks has no part in it.
    Rows that don't come straight from Parquet files are first written to the
    shared folder. The driver sees the paths alone, which its listing of the
    table holds already.
    """
    held = docs if _scanned(docs) else cut_lineage(docs.select(*columns))
    at = held.metadataColumn("_metadata")
    path, index = fresh(held, "_path"), fresh(held, "_index")
    files = sorted(r[0] for r in held.select(at["file_path"].alias(path)).distinct().collect())
    ranks = held.sparkSession.createDataFrame(list(zip(files, range(len(files)))), f"{path} string, {path}_rank long")
    return (
        held.select(*columns, at["file_path"].alias(path), at["row_index"].alias(index))
        .join(bounded_broadcast(ranks, len(files)), path)
        .select(F.shiftleft(f"{path}_rank", 40).bitwiseOR(F.col(index)).alias(name), *columns)
    )


def _scanned(docs: DataFrame) -> bool:
    """Whether the rows come straight from Parquet files."""
    tree = docs._jdf.queryExecution().optimizedPlan().toString()
    nodes = re.findall(r"^[\s:+-]*(\w+)", tree, re.M)
    return set(nodes) <= {"Project", "Filter", "Relation"} and bool(re.search(r"Relation .*parquet\s*$", tree, re.M))


def as_written(docs: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``columns``, and names of further ones that sort the rows as the partitions of a Parquet table were written.

    A scan deals files out by their size, so the order is read from the files:
    the number of the partition, the file, and the row in it. Rows that don't
    come straight from files are first written to the shared folder.
    """
    held = docs if _scanned(docs) else cut_lineage(docs.select(*columns))
    name = F.col("_metadata.file_name")
    order = {
        "_part": F.regexp_extract(name, r"^part-([0-9]+)", 1).try_cast("long"),
        "_file": name,
        "_at": F.col("_metadata.row_index"),
    }
    return held.select(*columns, *[c.alias(n) for n, c in order.items()]), list(order)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows range-partitioned and sorted, held in the shared folder, with ``_part`` and ``_at``.

    ``_at`` grows with the order over the whole table. Rows that are equal in
    the whole order are spread too, so no key makes one partition large.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(shuffle_parts(df.sparkSession), *order, F.col("_tie"))
    placed = dealt.sortWithinPartitions(*order, F.col("_tie")).drop("_tie")
    return cut_lineage(
        placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    )


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str, group: Sequence[str] = ()) -> DataFrame:
    """``name``: the sum of ``value`` over the rows before this one, in ``order``, within ``group``.

    ``group`` columns hold no nulls and lead the order. Sums are taken inside
    the partitions of a range-partitioned table; then the sums of the
    partitions before are added, so a group of any size is spread over tasks.
    """
    group = list(group)
    held = in_order(df, order)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        held.groupBy(*group, "_part")
        .agg(F.sum(value).alias("_sum"))
        .select(*group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        held.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(bounded_broadcast(sums), [*group, "_part"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside", "_part", "_at")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of the edges; the component is its smallest node.

    Labels go to the neighbours and then jump to the label of the label, until
    nothing changes. Each round is held in the shared folder.
    """
    both = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).where("v <> u")
    both = cut_lineage(both.unionByName(both.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct())
    labels = cut_lineage(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("c")))
    last = labels
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("u"), "c"), "u").groupBy("v").agg(F.min("c").alias("near"))
        )
        stepped = cut_lineage(
            labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        )
        up = stepped.select(F.col("v").alias("c"), F.col("c").alias("up"))
        jumped = cut_lineage(
            stepped.join(up, "c", "left").select("v", "old", F.least(F.col("c"), F.coalesce("up", "c")).alias("c"))
        )
        release(stepped, last)
        labels, last = jumped.select("v", "c"), jumped
        if jumped.where("c < old").isEmpty():
            release(both)
            return labels.select(F.col("v").alias("node"), F.col("c").alias("component"))


def extend_components(joined: DataFrame, more: DataFrame) -> DataFrame:
    """``components`` of earlier and further links, from the result of the earlier ones.

    The further links ``(a, b)`` are first drawn between the components that
    their ends lie in; loops and repetitions go, so many links between two
    large components cost as much as one.
    """
    ends = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
    labels = cut_lineage(
        joined.join(ends, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    )
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    drawn = more.join(of("a"), "a").join(of("b"), "b").where("a_of <> b_of")
    drawn = drawn.select(F.greatest("a_of", "b_of").alias("a"), F.least("a_of", "b_of").alias("b")).distinct()
    merged = components(drawn).select(F.col("node").alias("component"), F.col("component").alias("into"))
    made = cut_lineage(labels.join(merged, "component", "left").select("node", F.coalesce("into", "component").alias("component")))
    release(labels)
    return made
