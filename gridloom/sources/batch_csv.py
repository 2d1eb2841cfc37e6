"""Experiment batch tables: two CSV dialects, batch scans and batch writers."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridloom.functions.cells import (
    CASE_ALIASES,
    WD_ALIASES,
    WS_ALIASES,
    batch_number,
    cell,
    header_index,
)
from gridloom.operators.doe import batch_of
from gridloom.session import cut_lineage
from gridloom.sources.lines import read_lines, read_splits

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def split_simple(line: Column) -> Column:
    """Cells of one line: every comma splits, quotes mean nothing.

    A trailing empty cell is dropped.
    """
    return F.split(F.regexp_replace(F.translate(line, "\r", ""), ",$", ""), ",")


def simple_rows(lines: DataFrame) -> DataFrame:
    """(path, file_name, row_number, header, cells) of the simple dialect.

    ``lines`` has (path, file_name, line_no, line). The first line is the
    header; blank lines are dropped but counted.
    """
    cells = split_simple(F.col("line"))
    headers = lines.filter("line_no = 1").select("path", cells.alias("header"))
    body = lines.filter("line_no > 1").filter(F.trim(F.regexp_replace("line", r"\s", "")) != "")
    rows = body.select(
        "path", "file_name", F.col("line_no").cast("bigint").alias("row_number"), cells.alias("cells")
    )
    return rows.join(headers, "path").select("path", "file_name", "row_number", "header", "cells")


#: The inside of a quoted cell, up to the quote that closes it; a doubled quote stays inside.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
#: Whole cells with the commas that end them. A quote in the middle of a cell means nothing.
_CELLS = f'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'


def _open_at_end(line: Column, inside: bool) -> Column:
    """Whether a quoted cell is open at the end of a line that begins outside, or inside, of one."""
    opened = f'{_CELLS}"{_INSIDE}\\z'
    return line.rlike(f'^{_INSIDE}(?:\\z|"[^,]*+,{opened})' if inside else f"^{opened}")


def _before(window, *, parity: str, fixed: str) -> tuple[Column, Column]:
    """What the rows before make of the state they begin with: (the state they force or NULL, turns since then).

    ``fixed`` is the state after a row that forces one and NULL for others;
    ``parity`` is 1 for a row that turns the state around.
    """
    turns = F.coalesce(F.sum(parity).over(window), F.lit(0))
    after = F.sum(parity).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    forced = F.when(F.col(fixed).isNotNull(), F.struct(F.col(fixed).alias("state"), after.alias("turns")))
    return turns, forced


def _with_state(df: DataFrame, keys: Sequence[str], order: str, start: Column) -> DataFrame:
    """``_forced`` and ``_turns`` of the rows before each row, and ``_state`` where ``start`` is known."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns, forced = _before(window, parity="_turn", fixed="_fixed")
    held = df.withColumns({"_all": turns, "_here": forced}).withColumn("_last", F.last("_here", True).over(window))
    since = F.col("_all") - F.coalesce("_last.turns", F.lit(0))
    return held.withColumns(
        {"_forced": F.col("_last.state"), "_turns": since, "_state": (F.coalesce("_last.state", start) + since) % 2}
    ).drop("_all", "_here", "_last")


#: Pieces of records, as ``_pieces`` makes them of the lines of a split. ``_split`` is the id of the split's first
#: line and ``_at`` the place of the piece's first one; the path and name stand in the first piece alone. Of each pair, the
#: first is what holds if the split begins outside of a quoted cell: whether the piece begins and ends inside of one,
#: and the record of the split it belongs to.
_PIECE = "path string, file_name string, _start long, _split long, _at long, text string, _in0 boolean, _in1 boolean, _out0 boolean, _out1 boolean, _n0 long, _n1 long"


def _after(begin: bool, opened: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The state after each line: ``opened`` and ``kept`` say whether a cell is open then if none, or one, was before."""
    turns = np.cumsum(opened & ~kept)
    forced = np.maximum.accumulate(np.where(opened == kept, np.arange(len(opened)), -1))
    since = turns - np.where(forced >= 0, turns[forced], 0)
    return (np.where(forced >= 0, opened[forced], begin) + since) % 2 == 1


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in the order of their splits as pieces of records: consecutive lines of a record make one piece
    where the state is known, any other line is a piece of its own."""
    key, split, at, state, count = None, 0, 0, [False, False], [0, 0]
    for b in batches:
        path, start, ids, line = (b.column(c) for c in ("path", "_start", "_id", "line"))
        n, starts, numbers = b.num_rows, start.to_numpy(), ids.to_numpy()
        if n == 0:
            continue
        flags = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("_opened", "_kept", "_empty", "_opened_bare", "_kept_bare", "_empty_bare")}
        new = np.ones(n, bool)
        new[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(path.slice(1), path.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = key != (path[0].as_py(), starts[0])
        key = (path[n - 1].as_py(), starts[n - 1])
        begins, places = np.zeros(n, bool), np.empty(n, np.int64)
        ins, outs, counts = np.empty((2, n), bool), np.empty((2, n), bool), np.empty((2, n), np.int64)
        splits = np.empty(n, np.int64)
        edges = np.unique(np.concatenate([[0], np.flatnonzero(new), [n]]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            opened, kept, empty = (flags[c][lo:hi].copy() for c in ("_opened", "_kept", "_empty"))
            if new[lo]:
                # A file begins outside of a cell; its first line goes without a byte order mark.
                split, at, state, count = numbers[lo], 0, [False, starts[lo] != 0], [0, 0]
                if starts[lo] == 0:
                    opened[0], kept[0], empty[0] = (flags[c][lo] for c in ("_opened_bare", "_kept_bare", "_empty_bare"))
            for s in (0, 1):
                after = _after(state[s], opened, kept)
                ins[s, lo:hi], outs[s, lo:hi] = np.concatenate([[state[s]], after[:-1]]), after
                counts[s, lo:hi] = count[s] + np.cumsum(~ins[s, lo:hi] & ~empty)
                state[s], count[s] = bool(after[-1]), int(counts[s, hi - 1])
            begins[lo], splits[lo:hi], places[lo:hi] = True, split, np.arange(at, at + hi - lo)
            at += hi - lo
        begins |= (ins[0] != ins[1]) | ~ins[0]
        first = np.flatnonzero(begins)
        last = np.append(first[1:], n) - 1
        texts = pa.ListArray.from_arrays(pa.array(np.append(first, n), pa.int32()), line)
        # Empty lines outside of cells are no records; the first line of a split stays for its path.
        stay = ins[0, first] | ins[1, first] | ~flags["_empty"][first] | (places[first] == 0)
        named = pa.array(np.where(places[first] == 0, first, 0), mask=places[first] != 0)
        columns = [
            path.take(named), b.column("file_name").take(named), start.take(pa.array(first)),
            pa.array(splits[first]), pa.array(places[first]), pc.binary_join(texts, "\n"),
            *(pa.array(v) for v in (ins[0, first], ins[1, first], outs[0, last], outs[1, last], counts[0, first], counts[1, first])),
        ]
        names = [c.split(" ")[0] for c in _PIECE.split(", ")]
        yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stay))


def _numbered(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """(_file, record_no, record) of the pieces, given the state and the records with which their splits begin."""
    of = lambda name: F.when(F.col("_begin") == 1, F.col(f"_{name}1")).otherwise(F.col(f"_{name}0"))
    placed = pieces.select("_split", "_at", "text", *[c for c in pieces.columns if c[-1] in "01"]).join(
        splits.select("_split", "_file", "_start", "_begin", "_past"), "_split"
    )
    placed = placed.withColumns({"_in": of("in"), "_out": of("out"), "record_no": F.col("_past") + of("n")})
    bare = F.when((F.col("_start") == 0) & (F.col("_at") == 0), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    placed = placed.withColumn("text", bare).where(F.col("_in") | ~F.col("text").isin("", "\r"))
    keys = ["_file", "record_no"]
    whole = placed.where(~F.col("_in") & ~F.col("_out")).select(*keys, F.col("text").alias("record"))
    # Only pieces of records that go on in another one meet, one record in a group.
    parts = F.sort_array(F.collect_list(F.struct("_start", "_at", "text")))
    broken = placed.where(F.col("_in") | F.col("_out")).groupBy(*keys).agg(F.array_join(parts["text"], "\n").alias("record"))
    return whole.unionByName(broken)


def _quoted_parts(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Pieces of records in the shared folder, and (_split, path, file_name, _file, _start, _begin, _past) of each split.

    ``_file`` is the ``_split`` of the file's first one.
    """
    line, bare = F.col("line"), F.regexp_replace("line", "^\ufeff", "")
    marked = line.startswith("\ufeff")
    lines = read_splits(spark, paths).select("path", "file_name", "_start", "_id", "line", _open_at_end(line, False).alias("_opened"), _open_at_end(line, True).alias("_kept"))
    lines = lines.withColumns(
        {
            "_opened_bare": F.when(marked, _open_at_end(bare, False)).otherwise(F.col("_opened")),
            "_kept_bare": F.when(marked, _open_at_end(bare, True)).otherwise(F.col("_kept")),
            "_empty": line.isin("", "\r"),
            "_empty_bare": bare.isin("", "\r"),
        }
    )
    pieces = cut_lineage(lines.mapInArrow(_pieces, _PIECE))
    ends = pieces.groupBy("_split").agg(
        F.max(F.col("_at") * 4 + F.col("_out0").cast("int") * 2 + F.col("_out1").cast("int")).alias("_e"),
        F.max("_n0").alias("_n0"), F.max("_n1").alias("_n1"),
    )
    out0, out1 = F.floor(F.col("_e") / 2) % 2, F.col("_e") % 2
    effect = pieces.where("_at = 0").select("_split", "path", "file_name", "_start").join(ends, "_split")
    effect = effect.withColumns({"_fixed": F.when(out0 == out1, out0), "_turn": F.when(out0 > out1, 1).otherwise(0)})
    begins = _with_state(effect, ["path"], "_start", F.lit(0)).withColumnRenamed("_state", "_begin")
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    records = F.when(F.col("_begin") == 1, F.col("_n1")).otherwise(F.col("_n0"))
    return pieces, begins.select(
        "_split", "path", "file_name", F.first("_split").over(Window.partitionBy("path").orderBy("_start")).alias("_file"), "_start", "_begin",
        F.coalesce(F.sum(records).over(before), F.lit(0)).alias("_past"),
    )


def _files(splits: DataFrame) -> DataFrame:
    """(_file, path, file_name), one row per file."""
    return splits.where("_split = _file").select("_file", "path", "file_name")


def quoted_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, file_name, record_no, record) of CSV files with quoted cells, which may hold line ends.

    A file is read once, in splits by many tasks. Each line either keeps, turns
    or forces the state "inside a quoted cell". The lines of a split are put
    together in the order in which its task reads them, and what they do to the
    state is put together over the splits of a file, one row for each split, so
    that a split knows the state it begins in. Empty lines outside of cells
    are no records. A cell that is never closed lasts to the end of its file.
    """
    pieces, splits = _quoted_parts(spark, paths)
    return _numbered(pieces, splits).join(_files(splits), "_file").select("path", "file_name", "record_no", "record")


def split_quoted(record: Column) -> Column:
    """Cells of one record: quotes around a cell go, doubled ones become one."""
    body = F.concat(F.lit(","), F.regexp_replace(record, "\r\\z", ""))
    raw = F.regexp_extract_all(body, F.lit(f',("{_INSIDE}"?[^,]*+|[^,]*+)'), F.lit(1))
    pattern = f'^"({_INSIDE})"?([^,]*+)\\z'
    return F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'),
            F.concat(F.replace(F.regexp_extract(c, pattern, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, pattern, 2)),
        ).otherwise(c),
    )


def quoted_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, file_name, row_number, header, cells) of the quoted dialect; the first record is the header."""
    pieces, splits = _quoted_parts(spark, paths)
    cells = split_quoted(F.col("record")).alias("cells")
    # Few pieces can belong to the first record of a file.
    first = _numbered(pieces.where(F.least("_n0", "_n1") <= 1), splits).where("record_no = 1")
    files = _files(splits).join(first.select("_file", cells.alias("header")), "_file")
    rows = _numbered(pieces, splits).where("record_no > 1").select("_file", F.col("record_no").alias("row_number"), cells)
    return rows.join(files, "_file").select("path", "file_name", "row_number", "header", "cells")


def read_batch_csv(
    spark: SparkSession, paths: str | Sequence[str], dialect: str = "simple"
) -> DataFrame:
    """Batch tables as (path, file_name, row_number, header, cells).

    ``simple`` numbers physical lines, ``rfc`` understands quotes and a byte
    order mark and numbers records; both give 2 to the first data row.
    """
    if dialect == "simple":
        return simple_rows(read_lines(spark, paths))
    if dialect != "rfc":
        raise ValueError(f"unknown dialect {dialect!r}")
    return quoted_rows(spark, paths)


def read_batches(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All batch files of a scan with ``batch_id`` and their natural order."""
    return with_batch_id(read_batch_csv(spark, paths))


def with_batch_id(rows: DataFrame) -> DataFrame:
    """Add ``batch_id`` (text), and ``file_ord``: number, then name."""
    number = batch_number(F.col("file_name"))
    keyed = rows.withColumn("batch_id", number)
    order = Window.orderBy(
        F.col("batch_id").try_cast("decimal(38,0)").asc_nulls_last(), "file_name", "path"
    )
    # One row per file: the window sorts file names, not data.
    files = keyed.select("path", "file_name", "batch_id").distinct()
    files = files.select("path", F.row_number().over(order).alias("file_ord"))
    return keyed.join(files, "path")


def require_columns(rows: DataFrame, *alias_lists: Sequence[str]) -> DataFrame:
    """Files that lack a required column: (path, missing)."""
    missing = [
        F.when(header_index("header", aliases).isNull(), F.lit(aliases[0])) for aliases in alias_lists
    ]
    return (
        rows.select("path", "header")
        .distinct()
        .select("path", F.array_compact(F.array(*missing)).alias("missing"))
        .filter(F.size("missing") > 0)
    )


def case_columns(rows: DataFrame) -> DataFrame:
    """Raw case, wind speed and wind direction cells by their aliases."""
    def pick(aliases: Sequence[str]) -> Column:
        return cell("header", "cells", *aliases)

    return rows.select(
        *[c for c in rows.columns if c not in ("header", "cells")],
        pick(CASE_ALIASES).alias("raw_case"),
        pick(WS_ALIASES).alias("raw_ws"),
        pick(WD_ALIASES).alias("raw_wd"),
    )


def long_params(rows: DataFrame) -> DataFrame:
    """One row per cell: (…, parameter, value). A missing cell is ''."""
    keep = [c for c in rows.columns if c not in ("header", "cells")]
    return rows.select(*keep, "cells", F.posexplode("header").alias("_i", "parameter")).select(
        *keep, "parameter", F.coalesce(F.get("cells", F.col("_i")), F.lit("")).alias("value")
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_batches(df: DataFrame, order: str, path: str, batch_size: int = 16) -> None:
    """One folder ``batch_id=<n>`` per batch, rows in order inside it."""
    (
        batch_of(df, order, batch_size)
        .repartition("batch_id")
        .sortWithinPartitions("batch_id", order)
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("batch_id")
        .csv(path)
    )
