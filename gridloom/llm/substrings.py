"""Removal of long repeated substrings by bucket-pointer refinement.

Every start of a ``LENGTH``-byte string has an anchor, the start of the least
``Q``-gram (by hash) inside that string; equal strings have their anchors at
equal offsets. Starts with one anchor form a zone. The zones' anchors fall
into initial buckets by their Q-gram; a bucket of one holds no repeat and is
dropped, which ends most of the text. The rest is refined by the identifiers
of what stands at other offsets from the anchor: first the whole zone's
content, then that of blocks of 64 offsets, of 8, and of single ones. A block
whose core (the bytes that all its strings share) stands alone holds no repeat
and is dropped; a block that meets its equal is settled; what is left goes to
the next level, one of equal members for all.

Each level groups by an identifier, so a bucket of any size is spread over
the tasks and no pair of positions is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, numbered
from gridloom.session import cut_lineage, release, small_batches

LENGTH, Q = 400, 64
#: Offsets of the refinement's levels after the whole zone.
LEVELS = (64, 8, 1)
#: Starts that are worked on at once; a longer text is cut into segments, whose zones meet at the next level.
SEGMENT = 1 << 20

#: Rows (of numbers, or of zones with their bytes) that a task holds before it hands them on.
HELD_ROWS, HELD_ZONES = 100_000, 2_000

#: Elements of all lists of a table that may be broadcast (under 64 bytes each).
LIST_ELEMENTS = 1_000_000

_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out, k, step = np.ones(n, np.uint64), 1, base
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(step)
        k, step = k + m, step * step % 2**64
    return out


class Rolling:
    """Hashes of all substrings of a byte string: prefix sums of a polynomial in an odd base modulo 2^64."""

    def __init__(self) -> None:
        self.size = 0

    def load(self, data: bytes | np.ndarray) -> None:
        b = np.frombuffer(data, np.uint8)
        if len(b) >= self.size:
            self.size = max(4096, 2 * len(b))
            self.up, self.down = _powers(_ODD, self.size), _powers(pow(_ODD, -1, 2**64), self.size)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[: len(b)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def zones(data: bytes, rolling: Rolling, length: int = LENGTH, q: int = Q) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (first start, last start, anchor, anchor's hash, identifier of the content), segment by segment."""
    w = length - q + 1
    for base in range(0, max(0, len(data) - length + 1), SEGMENT):
        piece = data[base : base + SEGMENT + length - 1]
        rolling.load(piece)
        n = len(piece) - q + 1
        grams = rolling.of(np.arange(n), np.arange(q, n + q))
        # Least hash of each window of w, from the running minima inside blocks of w.
        rows = np.concatenate([grams, np.full(-n % w, np.uint64(2**64 - 1))]).reshape(-1, w)
        ahead = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].reshape(-1)
        behind = np.minimum.accumulate(rows, 1).reshape(-1)
        starts = n - w + 1
        least = np.minimum(ahead[:starts], behind[w - 1 : w - 1 + starts])
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut - 1, [starts - 1]])
        anchor = np.concatenate(
            [s + (grams[s[:, None] + np.arange(w)] == least[s][:, None]).argmax(1) for s in np.array_split(lo, len(lo) // 512 + 1)]
        )
        late = np.flatnonzero(anchor < hi)  # the same hash again: the later starts have later anchors
        if len(late):
            los, his, anchors = [lo], [np.minimum(hi, anchor)], [anchor]
            for k in late:
                again = anchor[k] + 1 + np.flatnonzero(grams[anchor[k] + 1 : hi[k] + w] == least[lo[k]])
                first = np.concatenate([[anchor[k] + 1], again[:-1] + 1])
                keep = first <= hi[k]
                los.append(first[keep])
                his.append(np.minimum(again[keep], hi[k]))
                anchors.append(again[keep])
            lo, hi, anchor = np.concatenate(los), np.concatenate(his), np.concatenate(anchors)
        content = rolling.of(lo, hi + length) + _mix((anchor - lo).astype(np.uint64) * np.uint64(_ODD))
        yield base + lo, base + hi, base + anchor, grams[anchor], _mix(content)


def _zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = Rolling()
    for b in batches:
        held: list[list[np.ndarray]] = [[], [], [], [], [], []]
        size = 0
        for row, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            for made in zones(text or b"", rolling):
                for out, x in zip(held, (np.full(len(made[0]), row), *made)):
                    out.append(x)
                size += len(made[0])
            if size > HELD_ROWS:
                yield _zone_batch(held)
                held, size = [[], [], [], [], [], []], 0
        if size:
            yield _zone_batch(held)


def _zone_batch(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in held]
    arrays = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)) for x in columns]
    return pa.RecordBatch.from_arrays(arrays, ["row", "lo", "hi", "anchor", "bucket", "id"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked zones of each text."""
    for b in batches:
        rows = []
        for row, text, asked in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
            for z in asked:
                rows.append((z["bucket"], row, z["lo"], z["hi"], z["anchor"], z["alone"], text[z["lo"] : z["hi"] + LENGTH]))
                if len(rows) >= HELD_ZONES:
                    yield _content_batch(rows)
                    rows = []
        if rows:
            yield _content_batch(rows)


def _content_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows), (*[pa.int64()] * 5, pa.bool_(), pa.binary()))],
        ["bucket", "row", "lo", "hi", "anchor", "alone", "content"],
    )


def _pieces(size: int, parent: int):
    """A task that cuts the asked offsets of each zone into blocks of ``size`` and identifies their contents.

    A zone asks for all its offsets, or for blocks of ``parent`` of them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for b in batches:
            held, made = [], 0
            for bucket, row, lo, hi, anchor, alone, content, asked in zip(*(c.to_pylist() for c in b.columns)):
                rolling.load(content)
                starts = np.arange(lo, hi + 1)
                offset = anchor - starts
                if asked is not None:
                    keep = np.isin(offset // parent, asked)
                    starts, offset = starts[keep], offset[keep]
                block = offset // size
                first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
                a, z = starts[first], starts[last]
                ids = rolling.of(a - lo, z - lo + LENGTH) + _mix((anchor - a).astype(np.uint64) * np.uint64(_ODD))
                latest = anchor - block[first] * size - lo  # of all starts of the block, also outside the zone
                core = rolling.of(latest, latest - size + 1 + LENGTH)
                one = np.ones(len(a), np.int64)
                fields = (bucket * one, row * one, lo * one, a, z, block[first], core.view(np.int64), ids.view(np.int64))
                held.append((*fields, (one > 0) & alone))
                made += len(a)
                if made > HELD_ROWS:
                    yield _piece_batch(held)
                    held, made = [], 0
            if held:
                yield _piece_batch(held)

    return cut


def _piece_batch(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(x)) for x in zip(*held)]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "row", "zone", "lo", "hi", "block", "core", "id", "alone"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``(row, lo, hi)``: runs of starts of strings that also start elsewhere, for ``texts(row, text)``."""
    small_batches(texts.sparkSession)
    found = cut_lineage(
        texts.mapInArrow(_zones, "row bigint, lo bigint, hi bigint, anchor bigint, bucket bigint, id bigint")
    )
    buckets = found.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.min("id").alias("least"), F.max("id").alias("most")
    ).where("members > 1")
    buckets = cut_lineage(buckets)  # then Spark can split the hot buckets of the join
    kept = found.join(buckets.select("bucket", (F.col("least") < F.col("most")).alias("open")), "bucket")
    kept = cut_lineage(kept)
    release(found, buckets)
    classes = cut_lineage(
        kept.groupBy("bucket", "id").agg(
            F.count(F.lit(1)).alias("members"),
            F.min(F.struct("row", "lo", "hi", "anchor")).alias("one"),
            F.first("open").alias("open"),
        )
    )
    settled = kept.join(classes.where("members > 1").select("bucket", "id"), ["bucket", "id"]).select("row", "lo", "hi")
    settled = cut_lineage(settled)
    release(kept)
    asked = (
        classes.where("open")
        .select("bucket", "one.*", (F.col("members") == 1).alias("alone"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("bucket", "lo", "hi", "anchor", "alone")).alias("asked"))
    )
    asked = cut_lineage(asked)
    contents = cut_lineage(
        texts.join(_sized(asked, "asked"), "row")
        .select("row", "text", "asked")
        .mapInArrow(
            _contents,
            "bucket bigint, row bigint, lo bigint, hi bigint, anchor bigint, alone boolean, content binary",
        )
    )
    release(classes, asked)
    out = [settled]
    todo = contents.withColumn("asked", F.lit(None).cast("array<bigint>"))
    for size, parent in zip(LEVELS, (1, *LEVELS)):
        pieces = cut_lineage(
            todo.mapInArrow(
                _pieces(size, parent),
                "bucket bigint, row bigint, zone bigint, lo bigint, hi bigint, block bigint, core bigint, id bigint, alone boolean",
            )
        )
        met = pieces.groupBy("bucket", "block", "core").agg(
            F.count(F.lit(1)).alias("members"), F.min("id").alias("least"), F.max("id").alias("most")
        ).where("members > 1")
        alike = cut_lineage(
            pieces.join(met.select("bucket", "block", "core", (F.col("least") < F.col("most")).alias("open")), ["bucket", "block", "core"])
        )
        release(pieces)
        equal = cut_lineage(
            alike.groupBy("bucket", "block", "id").agg(
                F.count(F.lit(1)).alias("members"), F.min(F.struct("row", "zone")).alias("one"), F.first("open").alias("open")
            )
        )
        twice = equal.where("members > 1").select("bucket", "block", "id")
        out.append(cut_lineage(alike.where("alone").join(twice, ["bucket", "block", "id"]).select("row", "lo", "hi")))
        release(alike)
        if size > 1:
            again = (
                equal.where("open")
                .select("bucket", "block", "one.row", F.col("one.zone").alias("lo"))
                .groupBy("bucket", "row", "lo")
                .agg(F.collect_list("block").alias("asked"))
            )
            again = cut_lineage(again)
            todo = contents.join(again, ["bucket", "row", "lo"]).select(
                "bucket", "row", "lo", "hi", "anchor", "alone", "content", "asked"
            )
    spans = out[0]
    for more in out[1:]:
        spans = spans.unionByName(more)
    return spans


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row, its spans as maximal runs of removed bytes."""
    for b in batches:
        runs = []
        for spans in b.column(1).to_pylist():
            out: list[list[int]] = []
            for lo, hi in sorted((s["lo"], s["hi"] + LENGTH) for s in spans):
                if out and lo <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], hi)
                else:
                    out.append([lo, hi])
            runs.append([x for run in out for x in run])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(runs, pa.list_(pa.int64()))], ["row", "runs"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, runs in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
            data, runs = text or b"", runs or []
            edges = [0, *runs, len(data)]
            left = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2]))
            rows.append(
                (len(data), len(data) - len(left), len(runs) // 2, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace"))
            )
        made = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(x, pa.int64()) for x in made[:3]], *[pa.array(x, pa.string()) for x in made[3:]]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )


def _sized(table: DataFrame, lists: str) -> DataFrame:
    """Broadcast a table of lists if they have few enough elements in all."""
    elements = table.agg(F.sum(F.size(lists) + 1).alias("n")).first()["n"] or 0
    return bounded_broadcast(table, elements, LIST_ELEMENTS)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text``.

    Removes every byte that lies in a 400-byte string which starts at another
    place too, in this text or in another row's; all copies go, repeated rows
    included. Null texts are empty; texts under 400 bytes lose nothing.
    ``kept_text`` holds the remaining bytes as text, where a cut character
    becomes U+FFFD; the checksum is of the bytes. An empty table gives no row.
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs, ["doc_id", "text"])
    spans = repeated_spans(rows.select("row", "text"))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    runs = cut_lineage(spans.mapInArrow(_merged, "row bigint, runs array<bigint>"))
    joined = rows.join(_sized(runs, "runs"), "row", "left").select("doc_id", "text", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _cleaned,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string",
    )
