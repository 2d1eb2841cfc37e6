"""Hard-negative mining by a secondary-sort shuffle.

Anchors meet all vectors in blocks, and a block's integer scores are one matrix
product. A block passes on the few pairs that can matter: its own best rows of
the anchor's label, then, once an anchor's positives are known, its own first
rows inside the score window of each positive. What is passed on is packed into
keys that sort as (anchor, descending score, positives first, id), dealt by
anchor and sorted on the way; a streaming reader opens a window at each
positive, gives every open window the negatives as they come by, and never
holds the rows of an anchor.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.llm.common import numbered, shuffle_parts
from gridloom.session import cut_lineage, release

POSITIVES, NEGATIVES = 5, 5
#: The window of a positive's score p: a negative's score n with LOW * p <= HIGH * n <= HIGH * p.
LOW, HIGH = 80, 100
#: Expected rows of a block of vectors, and of a block of anchors.
BLOCK, ANCHOR_BLOCK = 8192, 2048
#: Scores that a task holds at once.
CELLS = 2_000_000

_SIGN = 1 << 63


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list array, with zeros after the end of the shorter ones."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if len(flat) == width * len(sizes):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors as 64-bit integers; in doubles only where those are exact."""
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
    high = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * width
    if high < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x @ y.T


def first_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
    """Places of the first ``top`` entries of each owner: highest score, then smallest id, then row."""
    order = np.lexsort((rows, ids, -score, owner))
    sorted_ = owner[order]
    starts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < top]


def _dealt(vectors: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int):
    """Every block of vectors beside every block of anchors, as cogroups."""
    own = lambda salt, n: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", own("anchor", anchor_blocks).alias("a")).select("*", every(blocks).alias("b"))
    right = vectors.select("*", own("vector", blocks).alias("b")).select("*", every(anchor_blocks).alias("a"))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # new column identities for the self-cogroup
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))


def _parts(anchors: pa.Table, vectors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Scores by the anchors' label and in parts: (anchor places, vector places of the same or other labels, scores, same)."""
    if not anchors.num_rows or not vectors.num_rows:
        return
    a, v = (t.column("q").combine_chunks() for t in (anchors, vectors))
    a, v = (matrix(x.chunk(0) if isinstance(x, pa.ChunkedArray) else x) for x in (a, v))
    labels, kinds = anchors.column("label").to_numpy(), vectors.column("label").to_numpy()
    step = max(1, CELLS // max(1, len(v)))
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        for same in (True, False):
            others = np.flatnonzero((kinds == label) == same)
            for at in range(0, len(mine), step):
                if len(others):
                    yield mine[at : at + step], others, products(a[mine[at : at + step]], v[others]), same


def _best_positives(anchors: pa.Table, vectors: pa.Table) -> pa.Table:
    """The block's first rows of each anchor's label, the anchor's own row left out."""
    ids, rows, own = vectors.column("id").to_numpy(), vectors.column("row").to_numpy(), anchors.column("row").to_numpy()
    got = []
    for mine, others, scores, same in _parts(anchors, vectors):
        if not same:
            continue
        scores = np.where(own[mine][:, None] == rows[others][None], np.iinfo(np.int64).min, scores)
        kth = max(0, scores.shape[1] - POSITIVES - 1)
        i, j = np.nonzero(scores >= np.partition(scores, kth, axis=1)[:, kth : kth + 1])
        keep = own[mine][i] != rows[others][j]
        i, j = i[keep], j[keep]
        at = first_of(i, scores[i, j], ids[others[j]], rows[others[j]], POSITIVES)
        got.append((own[mine[i[at]]], scores[i[at], j[at]], ids[others[j[at]]], rows[others[j[at]]]))
    return _table(got, ["anchor", "score", "id", "row"])


def _near_negatives(anchors: pa.Table, vectors: pa.Table) -> pa.Table:
    """The block's first rows of other labels inside the window of each of an anchor's positives."""
    ids, rows, own = vectors.column("id").to_numpy(), vectors.column("row").to_numpy(), anchors.column("row").to_numpy()
    positives = matrix(pa.concat_arrays(anchors.column("scores").chunks)) if anchors.num_rows else np.zeros((0, 0), np.int64)
    sizes = np.array([len(x) for x in anchors.column("scores").to_pylist()], np.int64)
    got = []
    for mine, others, scores, same in _parts(anchors, vectors):
        if same:
            continue
        picked = np.zeros(scores.shape, bool)
        for k in range(positives.shape[1]):
            p = positives[mine, k][:, None]
            inside = (LOW * p <= HIGH * scores) & (scores <= p) & (k < sizes[mine])[:, None]
            i, j = np.nonzero(inside)
            at = first_of(i, scores[i, j], ids[others[j]], rows[others[j]], NEGATIVES)
            picked[i[at], j[at]] = True
        i, j = np.nonzero(picked)
        got.append((own[mine[i]], scores[i, j], ids[others[j]], rows[others[j]]))
    return _table(got, ["anchor", "score", "id", "row"])


def _table(got: list, names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*got)] if got else [np.zeros(0, np.int64)] * len(names)
    return pa.table(dict(zip(names, columns)))


def packed(anchor: int, score: int, negative: bool, id_: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, descending score, positives before negatives, id and row."""
    return struct.pack(">QQBQQ", anchor + _SIGN, _SIGN - 1 - score, negative, id_ + _SIGN, row + _SIGN)


def unpacked(key: bytes) -> tuple[int, int, bool, int, int]:
    anchor, score, negative, id_, row = struct.unpack(">QQBQQ", key)
    return anchor - _SIGN, _SIGN - 1 - score, bool(negative), id_ - _SIGN, row - _SIGN


def emit(entries: Iterator[tuple[bytes, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Reads sorted keys (with the anchor's id) once; each positive opens a window, which takes its first negatives."""
    anchor, windows = None, []
    for key, anchor_id in entries:
        owner, score, negative, id_, _ = unpacked(key)
        if owner != anchor:
            anchor, windows = owner, []
        if not negative:
            windows.append([score, id_, 0])
            continue
        windows = [w for w in windows if LOW * w[0] <= HIGH * score and w[2] < NEGATIVES]
        for w in windows:
            w[2] += 1
            yield anchor_id, w[1], w[2], id_, w[0], score


def mine_negatives(table: DataFrame, id_: str = "vec_id", is_anchor: Column | None = None, label: Column | None = None) -> DataFrame:
    """Hard negatives of the anchors of ``table(vec_id, embedding, label)``.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor and each of its first positives the first
    rows of other labels whose score lies in the positive's window. Components
    count as ``floor(256 * x)``; scores are integer inner products, a shorter
    vector having zeros after its end. Ties go to the smaller id. By default
    anchors are the rows whose id is divisible by 100, and rows whose id is
    divisible by 7 have the next of ten labels.

    Rows with a null id or label, and vectors that are null or hold a null or
    non-finite component, take no part; an empty vector has score 0 with all.
    Repeated rows are rows of their own: a copy of an anchor is one of its
    positives, and a repeated anchor has its result once for each row. An empty
    table, and anchors without a positive or without a negative in a window,
    give no row.
    """
    spark = table.sparkSession
    own = F.col("label").cast("long")
    moved = F.when(F.col("id") % 7 == 0, (own + 1) % 10).otherwise(own) if label is None else label
    chosen = F.col("id") % 100 == 0 if is_anchor is None else is_anchor
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = lambda v: F.floor(v.cast("double") * 256).cast("long")
    rows = numbered(table.select(F.col(id_).cast("long").alias("id"), "embedding", "label"), ["id", "embedding", "label"])
    held = cut_lineage(
        rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(~F.coalesce(F.exists("embedding", bad), F.lit(False)))
        .select("row", "id", moved.alias("label"), F.transform("embedding", whole).alias("q"), chosen.alias("anchor"))
    )
    count = held.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    blocks = max(1, -(-count.n // BLOCK)), max(1, -(-count.anchors // ANCHOR_BLOCK))
    anchors = held.where("anchor").select("row", "id", "label", "q")
    vectors = held.select("row", "id", "label", "q")
    near = _dealt(vectors, anchors, *blocks).applyInArrow(_best_positives, "anchor long, score long, id long, row long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    positives = cut_lineage(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= POSITIVES).drop("rank"))
    # At most POSITIVES scores for each anchor.
    known = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("scores"))
    asking = cut_lineage(anchors.join(known, "row"))
    negatives = cut_lineage(
        _dealt(vectors, asking, *blocks).applyInArrow(_near_negatives, "anchor long, score long, id long, row long")
    )
    pairs = positives.withColumn("negative", F.lit(False)).unionByName(negatives.withColumn("negative", F.lit(True)))
    named = pairs.join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    fields = named.select("anchor", "score", "negative", "id", "row", "anchor_id").rdd
    keyed = fields.map(lambda r: (packed(r[0], r[1], r[2], r[3], r[4]), r[5]))
    dealt = keyed.repartitionAndSortWithinPartitions(shuffle_parts(spark), lambda key: zlib.crc32(key[:8]))
    mined = spark.createDataFrame(
        dealt.mapPartitions(emit),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
    made = cut_lineage(mined)
    release(held, positives, asking, negatives)
    return made
