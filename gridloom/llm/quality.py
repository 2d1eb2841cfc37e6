"""Quality classifier: hashed word n-gram logistic regression trained with follow-the-regularised-leader updates.

A text becomes a sparse vector of hashed features: its words and signs, pairs
of neighbours, and the same for word shapes, each by its share of the text's
places, so a long text weighs as much as a short one. Training is one pass
after another over a bounded sample of labelled rows; scoring is a sparse dot
product with the weights, which every task gets once.
"""

from __future__ import annotations

import re
import tempfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, DoubleType

from gridloom.session import small_batches

#: Fixed number of hashed features; the model that is sent to every task holds this many 4-byte weights.
FEATURES = 1 << 18
#: Expected bound on the labelled rows that are sampled for training.
SAMPLE_ROWS = 12_000
THRESHOLD = 0.7

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_KNOWN = 100_000


@dataclass(frozen=True)
class Ftrl:
    """Settings of the updates: learning rate, its smoothing, the two penalties, and passes over the sample."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    passes: int = 4


def _shape(token: str) -> str:
    if not token[0].isalnum():
        return token[:4]
    kind = "A" if token.isupper() else "9" if token.isdigit() else "a" if token.islower() else "Aa"
    return kind if len(token) > 1 else kind[0] + "1"


class Hasher(dict):
    """Hashes of tokens (high half) and their shapes (low half), remembered for the tokens seen before."""

    def __missing__(self, token: str) -> int:
        if len(self) > _KNOWN:
            self.clear()
        word = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        shape = zlib.crc32(b"#" + _shape(token).encode("utf-8", "surrogatepass"))
        got = self[token] = word << 32 | shape
        return got

    def features(self, text: str | None) -> np.ndarray:
        """Feature number of every place of a feature in one whole text; empty for a null, empty or blank one."""
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.zeros(0, np.int64)
        both = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        step = np.uint64(0x9E3779B1)
        repeats = np.full(int((word[1:] == word[:-1]).sum()), 7, np.uint64)
        mixed = np.concatenate([word, shape, word[:-1] * step + word[1:], shape[:-1] * step + shape[1:], repeats])
        return (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)


#: Constant input of the constant term, and the length that a text's vector is scaled to (in the sum of its values).
CONSTANT, LENGTH = 0.3, 12.0


def vector(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of a text and their shares of its places."""
    found, counts = np.unique(places, return_counts=True)
    return found, counts * (LENGTH / max(1, len(places)))


def train(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], settings: Ftrl = Ftrl()) -> np.ndarray:
    """Weights after FTRL passes over (feature numbers, values, label); the last one is the constant term."""
    z, n = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * settings.l1) / ((settings.beta + np.sqrt(n[i])) / settings.alpha + settings.l2)
        w[np.abs(z[i]) <= settings.l1] = 0.0
        return w

    for _ in range(settings.passes):
        for found, values, label in rows:
            i, x = np.append(found, FEATURES), np.append(values, CONSTANT)
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / settings.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(FEATURES + 1)).astype(np.float32)


def training_fold(doc_id: Column) -> Column:
    """True where a row may be learnt from; every fourth one (by checksum of its id) is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, settings: Ftrl = Ftrl()) -> np.ndarray:
    """Train on at most about ``sample_rows`` of the labelled documents outside the held-out fold.

    The sample is the documents with the smallest hashes of their id, cut at a
    hash value so that no sort is needed. Their features are made where the
    texts lie; one task runs the passes over this bounded sample, and only the
    weights reach the driver. Rows with a null id, text or label are not
    learnt from. Without any row every weight is 0 and each score 0.5.
    """
    small_batches(docs.sparkSession)
    named = (
        labels.select("doc_id", F.col("quality").cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull() & training_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("_label").alias("_label"))
    )
    share = min(1.0, sample_rows / max(1, named.count()))
    cut = int(-(2**63) + share * (2**64 - 1))
    named = named.where(F.xxhash64("doc_id", F.lit("quality")) <= F.lit(min(cut, 2**63 - 1)))
    chosen = docs.select("doc_id", "text").where("text is not null").join(named, "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            made = [vector(hasher.features(t)) for t in b.column("text").to_pylist()]
            found = pa.array([f.astype("<i4").tobytes() for f, _ in made], pa.binary())
            values = pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_label"), found, values], ["doc_id", "label", "found", "values"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The passes read the vectors from a file of the task, so none stays in memory.
        with tempfile.TemporaryFile() as held:
            sizes, labels_ = [], []
            for b in batches:
                labels_.extend(b.column("label").to_pylist())
                for f, v in zip(b.column("found"), b.column("values")):
                    sizes.append(len(f.as_buffer()) // 4)
                    held.write(f.as_buffer())
                    held.write(v.as_buffer())
            if not sizes:
                return
            held.flush()
            words = np.asarray(np.memmap(held, "<i4", "r")) if sum(sizes) else np.zeros(0, "<i4")
            ends = 2 * np.cumsum(sizes)
            known = [(words[e - 2 * n : e - n], words[e - n : e].view("<f4"), y) for e, n, y in zip(ends, sizes, labels_)]
            weights = train(known, settings).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], ["weights"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    sampled = chosen.mapInArrow(vectors, f"doc_id {kind}, label int, found binary, values binary")
    place = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ordered = sampled.repartition(1).sortWithinPartitions(place, "doc_id", "found", "values")
    got = ordered.mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(got[0]["weights"], "<f4") if got else np.zeros(FEATURES + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text; null and empty texts have the constant term alone."""
    small_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = StructType([*kept, StructField(name, DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(), sent.value
        for b in batches:
            sums = np.full(b.num_rows, CONSTANT * float(w[FEATURES]))
            for k, text in enumerate(b.column(b.schema.get_field_index("text")).to_pylist()):
                places = hasher.features(text)
                sums[k] += LENGTH * float(w[places].mean(dtype=np.float64)) if len(places) else 0.0
            columns = [b.column(b.schema.get_field_index(f.name)) for f in kept]
            made = pa.array(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))
            yield pa.RecordBatch.from_arrays([*columns, made], [*(f.name for f in kept), name])

    return docs.mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, held_out, score, predicted``.

    Labels, language, source and id are never inputs of a score. Equal texts
    have equal scores. An empty table gives no row.
    """
    weights = fit(docs, labels, sample_rows)
    return score(docs.select("doc_id", "text"), weights).select(
        "doc_id",
        (~training_fold(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
