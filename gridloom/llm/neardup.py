"""MinHash near-duplicates of weighted word shingles: BagMinHash signatures, bands, and exact verification.

A text is a multiset of five-word shingles. For each shingle a sequence of
Poisson points lies over (time x weight); the weight axis is cut into the
dyadic intervals [0,1), [1,2), [2,4), [4,8)..., each with a process of its own
that is seeded by the shingle and the interval. A point counts for a text if
its weight coordinate lies below the shingle's count there, and goes to one of
the signature's components; a component keeps its least time. Two texts then
agree in a component with probability equal to their weighted Jaccard
similarity. Processes stop once they are later than every component, so most
shingles cost a few points, however many components there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, components, extend_components, numbered
from gridloom.session import cut_lineage, release, small_batches

SHINGLE = 5
THRESHOLD = 0.8
#: 32 bands of 6 components: a pair at similarity 0.8 shares none with a probability of 6e-5.
BANDS, ROWS = 32, 6
M = BANDS * ROWS
#: One bit of each component: at similarity 0.8, 19 of 192 differ on average (deviation 4); more than this differ
#: with a probability under 1e-6, and such pairs aren't read in full.
SKETCH_DIFFER = 40
#: Buckets of up to so many members give the pairs that are still open; larger ones are compared in blocks of members.
SMALL_BUCKET, BLOCK = 32, 256
#: Bands whose pairs are read first; pairs of the others are read only where links don't connect them yet.
FIRST_BANDS = 4
#: Words that are hashed at once in a task, texts that are taken out of a batch at once, and words that are remembered.
CHUNK_WORDS, CHUNK_TEXTS, KNOWN_WORDS = 100_000, 64, 100_000

_WORDS = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, remembered for the words seen before."""

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return got


def split_words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def shingle_hashes(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of texts whose word hashes follow one another: (hash, text number) of each place.

    A text of one to four words is one shingle of all its words.
    """
    text = np.repeat(np.arange(len(lengths)), lengths)
    out_h, out_t = [], []
    if len(hashes) >= SHINGLE:
        h = hashes[: len(hashes) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            h = h * _P + hashes[k : len(hashes) - SHINGLE + 1 + k]
        whole = text[: len(h)] == text[SHINGLE - 1 :]
        out_h.append(h[whole])
        out_t.append(text[: len(h)][whole])
    ends = np.cumsum(lengths)
    for t in np.flatnonzero((lengths > 0) & (lengths < SHINGLE)):
        h = np.uint64(lengths[t])
        with np.errstate(over="ignore"):
            for x in hashes[ends[t] - lengths[t] : ends[t]]:
                h = h * _P + x
        out_h.append(np.array([h], np.uint64))
        out_t.append(np.array([t]))
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _mix(np.concatenate(out_h)), np.concatenate(out_t)


def counted(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text) with their counts."""
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(first)
    return h[at], t[at], np.diff(np.append(at, len(h)))


def bag_signatures(hashes: np.ndarray, text: np.ndarray, counts: np.ndarray, texts: int, m: int = M) -> np.ndarray:
    """Signatures (texts x m) of the bags; infinite where a text has no shingle."""
    sig = np.full(texts * m, np.inf)
    low, level = 0, 0
    seeds, owners, weights = hashes, text, counts
    while len(seeds):
        span = max(1, low)
        state = _mix(seeds + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64))
        owner, weight, t = owners, weights, np.zeros(len(seeds))
        latest = sig.reshape(texts, m).max(1)
        while len(state):
            state = state + _P
            drawn = _mix(state)
            t = t - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * span)
            going = t <= latest[owner]
            state, owner, weight, t, drawn = state[going], owner[going], weight[going], t[going], drawn[going]
            if not len(state):
                break
            other = _mix(drawn ^ np.uint64(0xD6E8FEB86659FD93))
            part = ((other & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            cell = owner * m + part
            if span > 1:
                inside = low + ((other >> np.uint64(32)) * np.uint64(span) >> np.uint64(32)).astype(np.int64) < weight
                np.minimum.at(sig, cell[inside], t[inside])
            else:
                np.minimum.at(sig, cell, t)
            latest = sig.reshape(texts, m).max(1)
        low, level = low + span, level + 1
        more = weights > low
        seeds, owners, weights = seeds[more], owners[more], weights[more]
    return sig.reshape(texts, m)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHash()
    for b in batches:
        at = 0
        while at < b.num_rows:
            ids: list[int] = []
            lengths, digests, begin = [], [], at
            while at < b.num_rows and (at == begin or len(ids) < CHUNK_WORDS) and at - begin < CHUNK_TEXTS:
                w = split_words(b.column(2)[at].as_py())
                ids.extend(map(known.__getitem__, w))
                lengths.append(len(w))
                digests.append(xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")) if w else None)
                at += 1
            n = at - begin
            h, t = shingle_hashes(np.array(ids, np.uint64), np.array(lengths, np.int64))
            distinct, owner, counts = counted(h, t)
            sig = bag_signatures(distinct, owner, counts, n)
            bits = sig.view(np.uint64).reshape(n, BANDS, ROWS)
            band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _P, (n, BANDS)).copy()
            for r in range(ROWS):
                band = _mix(band * _P + bits[:, :, r])
            flags = (_mix(sig.view(np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(n, 3, 64)
            sketch = np.packbits(flags, axis=2).view(">i8").astype(np.int64).reshape(n, 3)
            offsets = np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(begin, n),
                    b.column(1).slice(begin, n),
                    pa.array(digests, pa.binary()),
                    pa.array(np.bincount(t, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.view(np.int64).reshape(-1))),
                    *[pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(3)],
                ],
                ["row", "doc_id", "digest", "n", "bands", "s0", "s1", "s2"],
            )


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact multiset overlap of two bags of (distinct shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / max(1, int(a[1].sum()) + int(b[1].sum()) - shared)


def bag(text: str | None, known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    w = split_words(text)
    h, _ = shingle_hashes(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)), np.array([len(w)]))
    return np.unique(h, return_counts=True)


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for b in batches:
            keep = [
                weighted_jaccard(bag(t.as_py(), known), bag(u.as_py(), known)) >= threshold for t, u in zip(b.column(2), b.column(3))
            ]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], ["a", "b"])

    with_b = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(verified, "a bigint, b bigint")


def _verify_blocks(members: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """Links that connect the members of large buckets, found block by block; ``held(node, bands, text)``.

    A bucket is split into blocks of about ``BLOCK`` members and each pair of
    blocks is one group. A pair is looked at in the first band it shares. The
    likeliest pairs come first, and pairs that links already connect are
    passed over, as they can't change the classes.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    full = members.join(bounded_broadcast(cut_lineage(sizes)), "band").join(held, "node")
    full = full.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    columns = ["band", "node", "label", "n", "s0", "s1", "s2", "bands", "text"]
    left = full.select(*columns, F.col("own").alias("q"), F.explode(F.sequence("own", F.col("parts") - 1)).alias("d"))
    right = full.select(*columns, F.explode(F.sequence(F.lit(0), "own")).alias("q"), F.col("own").alias("d"))

    def compare(key, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64")})
        if not len(x) or not len(y):
            return none
        bits = lambda t: np.unpackbits(np.ascontiguousarray(t[["s0", "s1", "s2"]].to_numpy(np.int64)).view(np.uint8), axis=1).astype(np.float32)
        bx, by = bits(x), bits(y)
        differ = (bx.sum(1)[:, None] + by.sum(1)[None] - 2 * bx @ by.T).astype(np.int64)
        nx, ny = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None]
        near = (differ <= SKETCH_DIFFER) & (np.minimum(nx, ny) >= threshold * np.maximum(nx, ny))
        near &= x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None]
        if key[1] == key[2]:
            near &= x["node"].to_numpy()[:, None] < y["node"].to_numpy()[None]
        i, j = np.nonzero(near)
        bands_x, bands_y = np.stack(x["bands"]), np.stack(y["bands"])
        first = (bands_x[i] == bands_y[j]).argmax(1) if len(i) else i
        here = bands_x[i, first] == key[0]
        i, j = i[here], j[here]
        order = np.argsort(differ[i, j], kind="stable")
        known, bags, top, out = WordHash(), {}, {}, []

        def get(side: int, k: int, table: pd.DataFrame):
            if (side, k) not in bags:
                bags[side, k] = bag(table["text"].iat[k], known)
            return bags[side, k]

        def root(v: int) -> int:
            while top.get(v, v) != v:
                top[v] = top.get(top[v], top[v])
                v = top[v]
            return v

        names = x["node"].to_numpy(), y["node"].to_numpy(), x["label"].to_numpy(), y["label"].to_numpy()
        for k in order:
            a, b = root(int(names[2][i[k]])), root(int(names[3][j[k]]))
            if a != b and weighted_jaccard(get(0, i[k], x), get(1, j[k], y)) >= threshold:
                top[max(a, b)] = min(a, b)
                out.append((int(names[0][i[k]]), int(names[1][j[k]])))
        return pd.DataFrame(out, columns=["a", "b"]) if out else none

    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # new column identities for the self-cogroup
    return left.groupBy("band", "q", "d").cogroup(right.groupBy("band", "q", "d")).applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, row: str | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``row, doc_id, class_id, class_size, kept``.

    Rows are linked if their shingle multisets overlap by ``threshold`` or
    more; classes are what links connect. ``class_id`` is the class's smallest
    doc_id and the row with it (of equal ones, the first) is kept. Texts with
    the same words are one node of the graph. Null texts and texts without a
    word link with nothing and are kept. ``row`` names a column that numbers
    the rows; without it they are numbered as they are scanned, in a column
    ``row``. Nulls in doc_id come last. An empty table gives no row.

    All members of a band's bucket are compared with one of them, another in
    each band, and then with all members that links don't yet connect them
    with. No link between members of a bucket is left out that would change a
    class, and a large class of copies is compared a few times per member.
    """
    small_batches(docs.sparkSession)
    if row:
        rows = docs.select(F.col(row).alias("row"), "doc_id", "text")
    else:
        rows = numbered(docs, ["doc_id", "text"])
    signed = cut_lineage(
        rows.mapInArrow(
            _signed,
            f"row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest binary, n bigint, "
            "bands array<bigint>, s0 bigint, s1 bigint, s2 bigint",
        )
    )
    nodes = cut_lineage(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("row").alias("node"), *[F.first(c).alias(c) for c in ("n", "bands", "s0", "s1", "s2")])
        .drop("digest")
    )
    members = nodes.select("node", "n", "s0", "s1", "s2", F.posexplode("bands").alias("place", "band"))
    centre = F.struct(F.xxhash64("node", "band").alias("h"), "node", "n", "s0", "s1", "s2")
    centres = members.groupBy("band").agg(F.min(centre).alias("f"), F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = cut_lineage(members.join(centres, "band"))
    differ = lambda x, y: sum(
        (F.bit_count(F.col(f"{x}{s}").bitwiseXOR(F.col(f"{y}{s}"))) for s in ("s0", "s1", "s2")), F.lit(0)
    )
    alike = (differ("", "f.") <= SKETCH_DIFFER) & (F.least("n", "f.n") >= threshold * F.greatest("n", "f.n"))
    stars = cut_lineage(
        shared.where(F.col("node") != F.col("f.node"))
        .where(alike)
        .groupBy(F.greatest("node", "f.node").alias("a"), F.least("node", "f.node").alias("b"))
        .agg(F.min("place").alias("place"))
    )

    def texts_of(nodes_: DataFrame) -> DataFrame:
        wanted = cut_lineage(nodes_.distinct())
        return cut_lineage(rows.drop("doc_id").join(bounded_broadcast(wanted), "row"))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row")))

    first = stars.where(F.col("place") < FIRST_BANDS)
    links = cut_lineage(_verify(first, texts_of(ends(first)), threshold))
    joined = components(links)
    of = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    later = stars.where(F.col("place") >= FIRST_BANDS).join(of("a"), "a", "left").join(of("b"), "b", "left")
    later = cut_lineage(later.where(~F.coalesce(F.col("a_of") == F.col("b_of"), F.lit(False))).select("a", "b"))
    further = cut_lineage(_verify(later, texts_of(ends(later)), threshold))
    if not further.isEmpty():
        joined = extend_components(joined, further)
    labelled = shared.drop("f", "place").join(joined, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("component", "node")).drop("component")
    open_bands = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    open_members = cut_lineage(labelled.join(open_bands.select("band"), "band"))
    fields = ("node", "n", "s0", "s1", "s2", "label")
    small = open_members.where(F.col("size") <= SMALL_BUCKET)
    x = small.select("band", *[F.col(c).alias(f"x{c}") for c in fields])
    y = small.select("band", *[F.col(c).alias(f"y{c}") for c in fields])
    apart = (
        (F.col("xnode") > F.col("ynode"))
        & (F.col("xlabel") != F.col("ylabel"))
        & (F.least("xn", "yn") >= threshold * F.greatest("xn", "yn"))
        & (differ("x", "y") <= SKETCH_DIFFER)
    )
    rest = x.join(y, (x["band"] == y["band"]) & apart).select(F.col("xnode").alias("a"), F.col("ynode").alias("b"))
    rest = cut_lineage(rest.distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    large = open_members.where(F.col("size") > SMALL_BUCKET)
    texts = texts_of(ends(rest).unionByName(large.select(F.col("node").alias("row"))))
    # Bands and text meet once for each node, before its buckets ask for them.
    once = large.select("node").distinct().join(nodes.select("node", "bands"), "node")
    once = cut_lineage(once.join(texts.withColumnRenamed("row", "node"), "node"))
    more = cut_lineage(_verify(rest, texts, threshold).unionByName(_verify_blocks(large, once, threshold)))
    if not more.isEmpty():
        joined = extend_components(joined, more)
    # Membership: row -> digest -> node -> class.
    of_digest = signed.where("digest is not null").groupBy("digest").agg(F.min("row").alias("node"))
    of_digest = of_digest.join(joined, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    placed = cut_lineage(
        signed.select("row", "doc_id", "digest").join(of_digest, "digest", "left").select(
            "row", "doc_id", F.coalesce("class", "row").alias("class")
        )
    )
    release(signed, nodes, shared, stars, links, later, further, open_members, rest, texts, once, more)
    best = placed.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("best"),
        F.count(F.lit(1)).alias("class_size"),
    )
    return placed.join(best, "class").select(
        F.col("row").alias(row or "row"),
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
