"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window without any five-word shingle of the benchmark has similarity 0 with
all items, so windows are laid only where such a shingle stands: a shingle at
word ``p`` of a text and at word ``o`` of an item of ``L`` words asks for the
window of ``L`` words that begins at ``p - o``. Each window gets the 64-bit
SimHash of its shingles and is compared with the items of ``L`` words. The
fingerprint is cut into ``RADIUS + 1`` blocks: two fingerprints that differ in
at most RADIUS bits agree in at least one block, so joins on block number and
value miss none of them. What lies within the radius is verified by the exact
overlap of the two shingle multisets. An item of fewer than five words is one
shingle of all its words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, let, numbered, shingles, words
from gridloom.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
#: At similarity 0.8 fingerprints differ in 10 of 64 bits on average, deviation 3.
RADIUS = 20
BITS = 64
#: Most benchmark shingles whose index is broadcast; a larger index is joined by shuffling.
INDEX_ROWS = 2_000_000


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of shingle hashes, each with the weight of its count."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def bit(h: Column, at: int) -> Column:
        ones = F.aggregate(h, zero, lambda n, x: n + F.shiftrightunsigned(x, at).bitwiseAND(one))
        return F.when(ones * 2 > F.size(h), F.shiftleft(one, at)).otherwise(zero)

    def all_bits(h: Column) -> Column:
        parts = [bit(h, at) for at in range(BITS)]
        while len(parts) > 1:
            parts = [x.bitwiseOR(y) for x, y in zip(parts[::2], parts[1::2])]
        return parts[0]

    return let(hashes, all_bits)


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """``radius + 1`` structs of block number and value that together hold all bits."""
    n = radius + 1
    edges = [BITS * k // n for k in range(n + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"),
            )
            for k, (lo, hi) in enumerate(zip(edges, edges[1:]))
        ]
    )


def _texts(w: Column) -> Column:
    """The shingles of a word array as text."""
    k = F.least(F.lit(SHINGLE), F.size(w))
    return F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))


def _shared(a: Column, b: Column) -> Column:
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))


def _hashed(w: Column) -> Column:
    """The shingles of a word array as hashes."""
    whole = [F.when(F.size(w) == k, shingles(F.array_join(w, " "), k)) for k in range(1, SHINGLE)]
    return F.coalesce(*whole, shingles(F.array_join(w, " "), SHINGLE))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS, row: str | None = None
) -> DataFrame:
    """Pairs of a document and an item that one of its windows repeats: ``doc_id, item_id, similarity, first_word``.

    ``first_word`` is where the best window (of equal ones, the first) begins.
    Texts and items without a word match nothing; an item of one to four words
    is found where they stand together, and a text of so few words matches
    only such items. Windows at the ends of a text are moved or cut to lie
    inside it. Repeated documents and repeated items give their pairs
    each; an empty table gives no row. ``row`` names a column that numbers the
    documents, which the result then carries too; without it rows are
    numbered as they are scanned.
    """
    if row:
        docs = docs.select(F.col(row).alias("_row"), "doc_id", "text")
    else:
        docs = numbered(docs, ["doc_id", "text"], "_row")
    lower = F.lower(F.coalesce("text", F.lit("")))
    items = benchmark.select("item_id", words(lower).alias("w")).where(F.size("w") > 0)
    items = cut_lineage(
        items.select(
            F.monotonically_increasing_id().alias("_item"), "item_id", F.size("w").alias("L"), "w", _hashed(F.col("w")).alias("h")
        )
    )
    index = items.select("L", F.posexplode("h").alias("o", "h")).distinct()
    short = [r[0] for r in items.where(F.col("L") < SHINGLE).select("L").distinct().collect()]  # four lengths at most
    places = [docs.select("_row", F.posexplode(shingles(F.col("text"), k)).alias("p", "h")) for k in (SHINGLE, *sorted(short))]
    anchors = (
        reduce(DataFrame.unionByName, places)
        .join(bounded_broadcast(index, limit=INDEX_ROWS), "h")
        .select("_row", (F.col("p") - F.col("o")).alias("start"), "L")
        .distinct()
        .groupBy("_row")
        .agg(F.collect_set(F.struct("start", "L")).alias("asked"))
    )
    anchors = cut_lineage(anchors)
    inside = docs.join(bounded_broadcast(anchors), "_row").select("_row", "doc_id", words(lower).alias("w"), "asked")
    inside = inside.select(
        "_row",
        "doc_id",
        let(
            F.col("w"),
            lambda w: F.array_distinct(
                F.transform(
                    "asked",
                    lambda a: F.struct(
                        F.greatest(F.lit(0), F.least(a["start"], F.size(w) - a["L"])).alias("start"),
                        a["L"].alias("L"),
                        F.slice(w, F.greatest(F.lit(0), F.least(a["start"], F.size(w) - a["L"])) + 1, a["L"]).alias("w"),
                    ),
                )
            ),
        ).alias("windows"),
    )
    windows = inside.select("_row", "doc_id", F.explode("windows").alias("x")).select("_row", "doc_id", "x.start", "x.L", "x.w")
    windows = windows.withColumn("_h", _hashed(F.col("w"))).withColumn("fp", simhash(F.col("_h"))).drop("_h")
    windows = cut_lineage(windows)
    known = items.withColumn("fp", simhash(F.col("h"))).drop("h")
    found = (
        windows.select("_row", "start", "L", "fp", F.explode(blocks(F.col("fp"), radius)).alias("b"))
        .select("_row", "start", "L", "fp", "b.block", "b.value")
        .join(
            known.select("_item", "L", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), radius)).alias("b")).select(
                "_item", "L", "item_fp", "b.block", "b.value"
            ),
            ["L", "block", "value"],
        )
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select("_row", "start", "L", "_item")
        .distinct()
    )
    pairs = (
        found.join(windows.drop("fp"), ["_row", "start", "L"])
        .join(known.select("_item", "item_id", F.col("w").alias("item_w")), "_item")
        .withColumn("a", _texts(F.col("w")))
        .withColumn("b", _texts(F.col("item_w")))
        .withColumn("shared", _shared(F.col("a"), F.col("b")))
        .withColumn("similarity", F.col("shared") / (F.size("a") + F.size("b") - F.col("shared")))
        .where(F.col("similarity") >= threshold)
    )
    best = pairs.groupBy("_row", "_item").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("item_id").alias("item_id"),
        F.max(F.struct("similarity", (-F.col("start")).alias("before"))).alias("best"),
    )
    return best.select(
        *([F.col("_row").alias(row)] if row else []),
        "doc_id",
        "item_id",
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.before")).cast("long").alias("first_word"),
    )
