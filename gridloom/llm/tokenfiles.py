"""Token-ID output: Arrow files of fixed-size-list batches.

Documents are encoded in ascending id order or in a given one, an end id
follows each, and the stream of a partition is cut into sequences of equal
length. A file holds
record batches of two fixed-size-list columns: ``ids`` (2 bytes an id where
the vocabulary fits) and ``mask`` (false on the padding of the last
sequence), so any sequence of a memory-mapped file is a slice without a copy.
Beside it lies an Arrow file with the id and token count of each document.

A task writes files under a name of its own attempt and reports them in its
result row; only reported files count, so a repeated task does no harm.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gridloom.llm.common import shuffle_parts
from gridloom.session import cut_lineage, scratch_path

END_ID = 2
SEQUENCE = 2048
#: Sequences in one record batch.
BATCH = 64
#: Pieces that a task process remembers, about 200 bytes each.
_KNOWN = 1_000_000

# Pieces whose ends are ends of tokens in the byte-level pattern too: a word of Latin letters before a blank, line end,
# stop or comma; one of those signs; or white space with all that follows it up to the next white space.
_PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[ \n.,])|[.,](?=[ \n])|\n(?=\S)|\s*\S+|\s+")
# Characters that only one of the two patterns takes for white space; special tokens. Such texts are encoded whole.
_WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Encoder(dict):
    """Encodes texts with a tokenizer file; remembers the ids of pieces as bytes."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    @classmethod
    def of_process(cls, path: str) -> Encoder:
        """The encoder of this process; a worker that runs several tasks keeps what it has learnt."""
        import tokenizers

        held = vars(tokenizers).setdefault("_encoders", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def packed(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, as little-endian bytes."""
        if len(self) > _KNOWN:
            self.clear()
        pieces: list[str] = []
        ends = [0]
        for t in texts:
            if not any(x in t for x in _WHOLE):
                pieces += _PIECE.findall(t)
            ends.append(len(pieces))
        made = list(map(self.get, pieces))
        at, missing = -1, []
        for _ in range(made.count(None)):
            at = made.index(None, at + 1)
            missing.append(at)
        new = list({pieces[k] for k in missing})
        for piece, got in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self[piece] = array(self.kind.char, got.ids).tobytes()
        for k in missing:
            made[k] = self[pieces[k]]
        return [b"".join(made[a:z]) if z > a else self.packed(t) for t, a, z in zip(texts, ends, ends[1:])]


class SequenceWriter:
    """Cuts a stream of ids into equal sequences and writes them batch by batch."""

    def __init__(self, sink, kind: np.dtype, length: int) -> None:
        self.kind, self.length, self.waiting, self.size = kind, length, [], 0
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.uint16() if kind.itemsize == 2 else pa.uint32(), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ]
        )
        self.file = pa.ipc.new_file(sink, self.schema)

    def add(self, data: bytes) -> None:
        self.waiting.append(data)
        self.size += len(data)
        if self.size >= BATCH * self.length * self.kind.itemsize:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), self.kind)
        step = BATCH * self.length
        end = len(ids) if last else len(ids) // step * step
        for at in range(0, end, step):
            piece = ids[at : at + step][: end - at]
            pad = -len(piece) % self.length
            mask = np.arange(len(piece) + pad) < len(piece)
            piece = np.concatenate([piece, np.zeros(pad, self.kind)]) if pad else piece
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((piece, mask), self.schema)
            ]
            self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        rest = ids[end:].tobytes()
        self.waiting, self.size = [rest] if rest else [], len(rest)

    def close(self) -> None:
        self._flush(True)
        self.file.close()


def write_sequences(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, length: int = SEQUENCE, order: Sequence[str] = ()
) -> DataFrame:
    """Write ``docs(doc_id, text)`` below ``folder``; one row per file: ``part, path, documents, tokens, start``.

    ``tokenizer`` is the path of a tokenizer file on every machine. Null texts
    are empty ones: a document of the end id alone. Null ids come last, equal
    ids in the order of their texts; ``order`` names columns of ``docs`` to
    sort by instead. An empty table gives no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        fs, local = filesystem(path)
        fs.create_dir(os.path.dirname(local), recursive=True)
        encoder = Encoder.of_process(tokenizer)
        end = np.array([end_id], encoder.kind).tobytes()
        documents = tokens = 0
        schema = pa.schema([("doc_id", first.schema.field("doc_id").type), ("n_tokens", pa.int64())])
        with fs.open_output_stream(f"{local}.arrow") as sink, fs.open_output_stream(f"{local}.docs.arrow") as listed:
            out, index = SequenceWriter(sink, encoder.kind, length), pa.ipc.new_file(listed, schema)
            for b in chain([first], batches):
                for at in range(0, b.num_rows, 256):
                    piece = b.slice(at, 256)
                    made = encoder.encode([t or "" for t in piece.column(1).to_pylist()])
                    counts = [len(m) // encoder.kind.itemsize + 1 for m in made]
                    for m in made:
                        out.add(m + end)
                    index.write_batch(pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts, pa.int64())], schema=schema))
                    documents, tokens = documents + len(made), tokens + sum(counts)
            out.close()
            index.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "documents": [documents], "tokens": [tokens]})

    dealt = [F.col(c) for c in order] or [F.col("doc_id").asc_nulls_last()]
    ordered = (
        docs.select("doc_id", "text", *order)
        .repartitionByRange(shuffle_parts(docs.sparkSession), *dealt)
        .sortWithinPartitions(*(dealt if order else [*dealt, F.col("text").asc_nulls_first()]))
        .select("doc_id", "text")
    )
    files = cut_lineage(ordered.mapInArrow(write, "part bigint, path string, documents bigint, tokens bigint"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    """A reader of one file; a local file is mapped, so its batches are views of it."""
    fs, local = filesystem(path)
    return pa.ipc.open_file(pa.memory_map(local) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(local))


def sequence_view(path: str, number: int, batch: int = BATCH) -> tuple[pa.Array, pa.BooleanArray]:
    """Ids and mask of one sequence by its number, both views of the file: one batch is touched and nothing is copied."""
    got = open_file(f"{path}.arrow").get_batch(number // batch)
    return got.column(0)[number % batch].values, got.column(1)[number % batch].values


def sequence(path: str, number: int, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """``sequence_view`` for NumPy, which has no arrays of bits: the ids are not copied, the mask is."""
    ids, mask = sequence_view(path, number, batch)
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def read_documents(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, index = open_file(f"{path}.arrow"), open_file(f"{path}.docs.arrow")
                pieces = (ids.get_batch(k).column(0).flatten().to_numpy() for k in range(ids.num_record_batches))
                held, at = np.zeros(0, np.uint16), 0
                for k in range(index.num_record_batches):
                    listed = index.get_batch(k)
                    starts, sums = [], []
                    for n in listed.column(1).to_pylist():
                        starts.append(start)
                        start, crc = start + n, 0
                        while n:
                            if at == len(held):
                                held, at = next(pieces), 0
                            took = held[at : at + n]
                            crc = zlib.crc32(took.astype("<u4").tobytes(), crc)
                            at, n = at + len(took), n - len(took)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [listed.column(0), pa.array(starts, pa.int64()), listed.column(1), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = files.select("path", "start", "part").repartition(shuffle_parts(files.sparkSession), "part").select("path", "start")
    return spread.mapInArrow(read, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_and_read(docs: DataFrame, tokenizer: str, folder: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Write the files, by default into a new folder of the shared one, and read them back."""
    files = write_sequences(docs, tokenizer, folder or scratch_path(docs.sparkSession, "tokens"), order=order)
    return read_documents(files, docs.schema["doc_id"].dataType.simpleString())
