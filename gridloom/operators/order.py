"""Row order without one big sort task.

A window without a partition key, or with a hot one, sorts everything in one
task. The helpers here cut the order into blocks, number the rows inside each
block, and add the size of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.session import cut_lineage

BLOCK = 65536


def small_table(spark, rows: Sequence, schema: str, limit: int = 100_000) -> DataFrame:
    """A broadcast table of driver-side contract rows; its size is checked here."""
    rows = list(rows)
    if len(rows) > limit:
        raise ValueError(f"{len(rows)} rows are too many for a contract table")
    return F.broadcast(spark.createDataFrame(rows, schema))


def blocked_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str
) -> DataFrame:
    """1-based number of each row within ``keys`` by ``order``.

    ``block`` must grow with the order and bound the rows that one task sorts.
    """
    keys, order = list(keys), list(order)
    tagged = df.withColumn("_block", block)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        tagged.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    return (
        tagged.withColumn("_inside", F.row_number().over(inside))
        .join(sizes, [*keys, "_block"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_block", "_inside", "_before")
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, block: int = BLOCK
) -> DataFrame:
    """Last non-null ``value`` up to each row, within ``keys`` by the whole number ``order``.

    Rows are carried inside blocks of ``block`` order steps; each block starts
    with the last value of the blocks before it. No task sees more than one
    block, however long one key is.
    """
    keys = list(keys)
    tagged = df.withColumn("_block", F.floor(F.col(order) / block))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        tagged.groupBy(*keys, "_block")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
        .drop("_last")
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        tagged.withColumn("_here", F.last(value, ignorenulls=True).over(inside))
        .join(heads, [*keys, "_block"])
        .withColumn(name, F.coalesce("_here", "_carry"))
        .drop("_block", "_here", "_carry")
    )


def global_row_number(df: DataFrame, order: str | Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """1-based number of each row over the whole table, by columns of any orderable type.

    The rows are range-partitioned by the order, sorted inside the partitions
    and held in the shared folder; the row counts of the partitions before,
    one number per partition, are added. Rows that are equal in the whole order are
    spread over partitions too.
    """
    order = [order] if isinstance(order, str) else list(order)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_tie"]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(*df.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    )
    placed = cut_lineage(placed)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    sizes = sizes.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    # Numbers inside a partition are consecutive as they were given when it was written.
    return placed.join(F.broadcast(sizes), "_part").select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def first_of_group(df: DataFrame, group: Sequence[str], row_key: Sequence[str], name: str) -> DataFrame:
    """Flag the least ``row_key`` of each group (``row_key`` is unique in the table).

    The groups are reduced with partial aggregation and joined back on the row
    key, so a group that holds a third of the table never meets in one task.
    Rows whose group is NULL form one group, as in GROUP BY.
    """
    row_key = list(row_key)
    firsts = (
        df.groupBy(*group)
        .agg(F.min(F.struct(*row_key)).alias("_first"))
        .select(*[F.col(f"_first.{k}").alias(k) for k in row_key], F.lit(True).alias("_is_first"))
    )
    return (
        df.join(firsts, row_key, "left")
        .withColumn(name, F.coalesce("_is_first", F.lit(False)))
        .drop("_is_first")
    )
