"""Embedding near-duplicates by product quantisation with inverted lists and an exact rerank.

A bounded sample trains coarse centroids and the codebooks of the residuals'
subspaces; every vector is then indexed under its nearest centroid with one
code byte per subspace and the length of what the codes leave out. A vector
probes each list that can hold a partner: a partner within distance ``d`` lies
at most ``d`` beyond the plane between the two centroids. Table lookups give
the distance to a coded vector up to its left-out length, so a pair is passed
on unless that already rules it out. No pair is lost by probes or codes; exact
cosines in double precision decide.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, components, numbered
from gridloom.session import cut_lineage

COSINE = 0.93
#: Vectors that the index is trained on at most; all vectors are indexed.
SAMPLE = 16_384
SUBSPACES, CODES = 8, 256
#: Expected vectors on either side of one comparison.
BLOCK = 1024


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(17)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own = (centres * centres).sum(1)
    return np.concatenate([(own - 2 * part @ centres.T).argmin(1) for part in np.array_split(x, len(x) // 4096 + 1)])


class Index:
    """Coarse centroids and residual codebooks for vectors padded with zeros to one width."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        width = max(1, sample.shape[1])
        self.width = -(-width // SUBSPACES) * SUBSPACES
        sample = self.padded(list(sample)) if len(sample) else np.zeros((1, self.width))
        self.coarse = _kmeans(sample, min(lists, len(sample)))
        rest = sample - self.coarse[_nearest(sample, self.coarse)]
        parts = rest.reshape(len(rest), SUBSPACES, -1)
        self.books = np.stack([self._book(np.ascontiguousarray(parts[:, m])) for m in range(SUBSPACES)])

    @classmethod
    def of(cls, fields: dict) -> Index:
        made = cls.__new__(cls)
        vars(made).update(fields)
        return made

    @staticmethod
    def _book(part: np.ndarray) -> np.ndarray:
        made = _kmeans(part, min(CODES, len(part)), 6)
        return np.concatenate([made, np.repeat(made[:1], CODES - len(made), 0)])

    def padded(self, vectors: list) -> np.ndarray:
        """Unit vectors in double precision."""
        out = np.zeros((len(vectors), self.width))
        for k, v in enumerate(vectors):
            v = np.asarray(v, np.float64)[: self.width]
            out[k, : len(v)] = v
        size = np.abs(out).max(1, keepdims=True)
        out /= np.where(size > 0, size, 1.0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)

    def code(self, x: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = x - self.coarse[near]
        parts = rest.reshape(len(x), SUBSPACES, -1)
        codes = np.stack([_nearest(np.ascontiguousarray(parts[:, m]), self.books[m]) for m in range(SUBSPACES)], 1)
        left = parts - self.books[np.arange(SUBSPACES), codes]
        return codes.astype(np.uint8), np.sqrt((left * left).sum((1, 2)))

    def probes(self, x: np.ndarray, near: np.ndarray, reach: float) -> np.ndarray:
        """Which lists may hold a vector within ``reach``: by the distance to the plane between the centroids."""
        to = ((x[:, None] - self.coarse[None]) ** 2).sum(2)
        gap = np.sqrt(((self.coarse[near][:, None] - self.coarse[None]) ** 2).sum(2))
        beyond = (to - to[np.arange(len(x)), near][:, None]) / np.maximum(2 * gap, 1e-12)
        return (beyond <= reach + 1e-9) | (gap <= 1e-12)

    def lookups(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distances of exact vectors to the coded ones of list ``at``."""
        parts = (x - self.coarse[at]).reshape(len(x), SUBSPACES, -1)
        total = np.zeros((len(x), len(codes)))
        for m in range(SUBSPACES):
            book = self.books[m]
            table = (parts[:, m] ** 2).sum(1)[:, None] - 2 * parts[:, m] @ book.T + (book * book).sum(1)
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0.0))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, by passing minima along the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``table(vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Vectors are linked if their labels and lengths are equal and their cosine
    is at least ``cosine``. Rows with a null label, and vectors that are null,
    empty, zero or hold a null or non-finite component, link with nothing.
    Equal vectors of one label are one node with a count, so copies are
    compared once and counted in full. Repeated rows are other vectors. An
    empty table gives no row.
    """
    rows = numbered(table, ["vec_id", "embedding", "label"])
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    good = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False))
        & ~F.coalesce(F.exists("embedding", bad), F.lit(False))
    )
    held = cut_lineage(rows.withColumn("good", good))
    nodes = cut_lineage(
        held.where("good").groupBy("label", "embedding").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"))
    )
    n = nodes.count()
    if not n:
        own = F.col("vec_id")
        return held.select("vec_id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
    share = min(1.0, SAMPLE / n)
    cut = min(int(-(2**63) + share * (2**64 - 1)), 2**63 - 1)
    sample = nodes.where(F.xxhash64("node") <= F.lit(cut)).select("embedding").limit(2 * SAMPLE).collect()
    width = nodes.agg(F.max(F.size("embedding"))).first()[0]
    padded = np.zeros((len(sample), width))
    for k, r in enumerate(sample):
        padded[k, : len(r[0])] = r[0]
    index = Index(padded, max(1, round(math.sqrt(n) / 16)))
    reach = math.sqrt(2 - 2 * cosine)
    sent = table.sparkSession.sparkContext.broadcast(vars(index))

    def indexed(batches):
        index = Index.of(sent.value)
        for b in batches:
            for part in np.array_split(np.arange(len(b)), len(b) // 2048 + 1):
                if not len(part):
                    continue
                piece = b.iloc[part]
                x = index.padded(list(piece["embedding"]))
                near = _nearest(x, index.coarse)
                codes, left = index.code(x, near)
                asks = index.probes(x, near, reach) & (np.arange(len(index.coarse)) >= near[:, None])
                yield pd.DataFrame(
                    {
                        "node": piece["node"],
                        "copies": piece["copies"],
                        "label": piece["label"],
                        "width": [len(v) for v in piece["embedding"]],
                        "embedding": piece["embedding"],
                        "list": near,
                        "codes": [c.tobytes() for c in codes],
                        "left_out": left,
                        "asks": [np.flatnonzero(a) for a in asks],
                    }
                )

    label = table.schema["label"].dataType.simpleString()
    element = table.schema["embedding"].dataType.simpleString()
    coded = cut_lineage(
        nodes.mapInPandas(
            indexed,
            f"node bigint, copies bigint, label {label}, width int, embedding {element}, list int, codes binary, "
            "left_out double, asks array<int>",
        )
    )
    keys = ["label", "width", "list"]
    asking = coded.select("node", "copies", "label", "width", "embedding", F.explode("asks").alias("list"), F.col("list").alias("own"))
    parts = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    counts = parts(coded, "d_parts").join(parts(asking, "q_parts"), keys)
    counts = bounded_broadcast(cut_lineage(counts))
    salt = lambda n: F.pmod(F.xxhash64("node", F.lit("block")), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asking.join(counts, keys).select("node", "copies", "embedding", "own", *keys, salt("q_parts").alias("q"), all_of("d_parts").alias("d"))
    right = coded.join(counts, keys).select(
        "node", "copies", "embedding", "codes", "left_out", *keys, salt("d_parts").alias("d"), all_of("q_parts").alias("q")
    )

    def compare(key, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"node": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64"), "root": pd.Series([], dtype="int64")})
        if not len(q) or not len(d):
            return none
        index, at = Index.of(sent.value), int(key[2])
        qn, dn = q["node"].to_numpy(np.int64), d["node"].to_numpy(np.int64)
        same = q["own"].to_numpy() == at  # inside a list each pair once
        codes = np.frombuffer(b"".join(d["codes"]), np.uint8).reshape(len(d), SUBSPACES)
        x, y = index.padded(list(q["embedding"])), np.stack([np.asarray(v, np.float64) for v in d["embedding"]])
        raw = np.stack([np.asarray(v, np.float64) for v in q["embedding"]])
        sizes = np.linalg.norm(raw, axis=1), np.linalg.norm(y, axis=1)
        left_out = d["left_out"].to_numpy()
        found = []
        for s in range(0, len(x), 256):
            near = index.lookups(x[s : s + 256], at, codes) <= reach + left_out + 1e-6
            near &= ~(same[s : s + 256, None] & (qn[s : s + 256, None] >= dn[None]))
            i, j = np.nonzero(near)
            for c in range(0, len(i), 65_536):
                a, b = i[c : c + 65_536] + s, j[c : c + 65_536]
                exact = np.einsum("ij,ij->i", raw[a], y[b]) / (sizes[0][a] * sizes[1][b])
                keep = exact >= cosine
                found.append((a[keep], b[keep]))
        i, j = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        if not len(i):
            return none
        names, at_name = np.unique(np.concatenate([qn[i], dn[j]]), return_inverse=True)
        a, b = at_name[: len(i)], at_name[len(i) :]
        links = np.zeros(len(names), np.int64)
        np.add.at(links, a, d["copies"].to_numpy(np.int64)[j])
        np.add.at(links, b, q["copies"].to_numpy(np.int64)[i])
        return pd.DataFrame({"node": names, "links": links, "root": names[_roots(len(names), a, b)]})

    by = [*keys, "q", "d"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # new column identities for the self-cogroup
    linked = cut_lineage(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(compare, "node bigint, links bigint, root bigint"))
    joined = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (
        nodes.join(links, "node", "left")
        .join(joined, "node", "left")
        .select("label", "embedding", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    placed = held.where("good").join(classes, ["label", "embedding"]).select(
        "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component"
    )
    placed = cut_lineage(placed)
    least = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    found = placed.join(least, "component").select("vec_id", "n_links", "component_id")
    rest = held.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
