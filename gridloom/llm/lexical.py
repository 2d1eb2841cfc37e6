"""Ranked lexical search by scanning whole documents with an Aho-Corasick automaton of all query terms.

No index of the documents is made. The distinct terms of the items, each with
a guard on either side, form one automaton that every task gets; a text whose
separators are turned into guards runs through it once, so all its query terms
are counted in one pass whatever their number. A first scan adds up the
statistics of the corpus and of the terms, a second one maps the automaton's
outputs to the items that hold them, scores whole documents in integers, and
keeps the best rows of each item in a task. Very many items are taken in
groups of a bounded number of terms, so what is broadcast stays bounded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridloom.llm.common import ascii_lower, bounded_broadcast, numbered, running_total, words
from gridloom.session import cut_lineage, release

TOP = 20
#: Weight of a document's length in hundredths, and the damping of repeated terms in tenths.
B, K = 25, 12
#: Terms (with repeats) of the items that one automaton is built from, not counting the last item's.
GROUP_TERMS = 500_000
#: Cells of the table (documents x items) that a task scores at once.
CELLS = 2_000_000

_GUARD = b" "
_UPPER = bytes(range(65, 91))
#: Bytes of UTF-8 text: A-Z in lower case, all other ASCII but letters and digits become guards, the rest stays.
_FOLD = bytes(
    b + 32 if b in _UPPER else b if b >= 0x80 or chr(b).isalnum() else _GUARD[0] for b in range(256)
)


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def count_terms(text: bytes) -> int:
    """The number of terms of a folded text, repeats counted."""
    return len(text.split())


class Scanner:
    """Counts of the given terms in whole texts."""

    def __init__(self, terms: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            self.automaton.add_word(f" {term} ", k)
        self.any = bool(terms)
        if self.any:
            self.automaton.make_automaton()

    def count(self, text: bytes) -> Counter:
        """How often each term, by its number, stands in a folded text. Neighbours share the guard between them."""
        if not self.any:
            return Counter()
        guarded = (_GUARD + text + _GUARD).decode("utf-8", "surrogatepass")
        return Counter(k for _, k in self.automaton.iter(guarded))


@dataclass
class Group:
    """Items that are searched together: their distinct terms, and for each term its items with repeats (in slices)."""

    terms: list[str]
    items: list
    starts: np.ndarray
    posted: np.ndarray
    times: np.ndarray


def _group(rows: list) -> Group:
    """``rows``: (item number, item_id, term, repeats)."""
    items: dict[int, int] = {}
    ids = []
    for r in rows:
        if r.item not in items:
            items[r.item] = len(items)
            ids.append(r.item_id)
    terms = sorted({r.term for r in rows})
    number = {t: k for k, t in enumerate(terms)}
    posted = sorted((number[r.term], items[r.item], r.times) for r in rows)
    at = np.array([p[0] for p in posted], np.int64)
    return Group(
        terms,
        ids,
        np.searchsorted(at, np.arange(len(terms) + 1)),
        np.array([p[1] for p in posted], np.int64),
        np.array([p[2] for p in posted], np.int64),
    )


def _best(found: pd.DataFrame, top: int) -> pd.DataFrame:
    """The first rows of each item: highest score, then smallest doc_id, null last."""
    placed = found.sort_values(["item", "score", "doc_id"], ascending=[True, False, True], na_position="last", kind="stable")
    return placed[placed.groupby("item").cumcount() < top]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """The ``top`` best rows of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters, digits and non-ASCII characters of the
    whole text, A-Z in lower case. Scores are 64-bit integers and count each
    term of an item as often as the item holds it; rows with score 0 are not
    returned. Equal scores come by ascending doc_id, a null one last. Null and
    empty texts have no terms: such items give no row and such documents don't
    count. Repeated rows of either table are rows of their own, so a repeated
    item_id has its ranks once for each row. Other columns don't matter. An
    empty table gives no row.
    """
    spark = docs.sparkSession
    sized = numbered(items, ["item_id", "text"], "item").select("item", "item_id", words(ascii_lower(F.col("text"))).alias("terms"))
    sized = sized.where(F.size("terms") > 0).withColumn("n", F.size("terms").cast("long"))
    grouped = running_total(sized, [F.col("item")], "n", "before").withColumn("group", F.floor(F.col("before") / group_terms))
    postings = cut_lineage(
        grouped.select("group", "item", "item_id", F.explode("terms").alias("term"))
        .groupBy("group", "item", "item_id", "term")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    last = postings.agg(F.max("group")).first()[0]
    texts = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found, corpus = None, None
    for g in range(0 if last is None else last + 1):
        # One group holds at most ``group_terms`` terms and those of one more item.
        rows = postings.where(F.col("group") == g).select("item", "item_id", "term", "times").collect()
        if not rows:
            continue
        group = _group(sorted(rows, key=lambda r: (r.item, r.term)))
        counts = _statistics(texts, group.terms)
        corpus = corpus or counts[:2]
        if not corpus[0]:
            break
        best = _scores(texts, spark.sparkContext.broadcast(group), corpus, counts[2], kind, top)
        names = spark.createDataFrame(
            [(k, i) for k, i in enumerate(group.items)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        made = ranked.join(bounded_broadcast(names, len(group.items)), "item").select("item_id", "rank", "doc_id", "score")
        made = cut_lineage(made) if last else made
        found = made if found is None else found.unionByName(made)
    release(postings)
    if found is None:
        given = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {kind}, score long"
        return spark.createDataFrame([], given)
    return found


def _statistics(texts: DataFrame, terms: list[str]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each of ``terms``."""
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, documents, length = Scanner(sent.value), 0, 0
        held = np.zeros(len(sent.value), np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                plain = folded(text)
                n = count_terms(plain)
                if n:
                    documents, length = documents + 1, length + n
                    held[list(scanner.count(plain))] += 1
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *seen.tolist()], pa.int32()), pa.array([documents, length, *held[seen].tolist()], pa.int64())], ["term", "n"]
        )

    sums = texts.select("text").mapInArrow(counted, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = dict((r.term, r.n) for r in sums)
    df = np.zeros(len(terms), np.int64)
    for term, n in got.items():
        if term >= 0:
            df[term] = n
    return got.get(-2, 0), got.get(-1, 0), df


def _weights(documents: int, df: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((2N + 2) / (2df + 1)))`` in doubles."""
    return np.floor(1000.0 * np.log((2.0 * documents + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def _scores(texts: DataFrame, sent, corpus: tuple[int, int], df: np.ndarray, kind: str, top: int) -> DataFrame:
    """``item, doc_id, score``: for each item the best rows of every task."""
    documents, length = corpus
    weights = texts.sparkSession.sparkContext.broadcast(_weights(documents, df))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Group = sent.value
        scanner, w, items = Scanner(group.terms), weights.value, len(group.items)
        sizes = np.diff(group.starts)
        step = max(1, CELLS // max(1, items))
        least = np.zeros(items, np.int64)  # a row must reach this score to be among the best of its item
        best, ids_type = None, None
        for b in batches:
            ids_type = b.schema.field(0).type
            texts_ = b.column(1).to_pylist()
            for at in range(0, b.num_rows, step):
                table = np.zeros((min(step, b.num_rows - at), items), np.int64)
                for k, text in enumerate(texts_[at : at + step]):
                    plain = folded(text)
                    n, counts = count_terms(plain), scanner.count(plain)
                    if not counts:
                        continue
                    terms = np.fromiter(counts.keys(), np.int64, len(counts))
                    tf = np.fromiter(counts.values(), np.int64, len(counts))
                    m = 100 - B + (B * n * documents) // length
                    gained = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + K * m))
                    many = sizes[terms]
                    places = np.repeat(group.starts[terms] - np.cumsum(many) + many, many) + np.arange(many.sum())
                    np.add.at(table[k], group.posted[places], np.repeat(gained, many) * group.times[places])
                docs_at, items_at = np.nonzero((table > 0) & (table >= least))
                if not len(docs_at):
                    continue
                ids = b.column(0).slice(at, len(table)).to_pandas(integer_object_nulls=True)
                now = pd.DataFrame({"item": items_at, "doc_id": ids.to_numpy()[docs_at], "score": table[docs_at, items_at]})
                best = _best(now if best is None else pd.concat([best, now], ignore_index=True), top)
                full = best.groupby("item")["score"].agg(["size", "min"])
                full = full[full["size"] >= top]
                least[full.index] = full["min"]
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(best["item"].to_numpy(), pa.int32()),
                    pa.Array.from_pandas(best["doc_id"], type=ids_type),
                    pa.array(best["score"].to_numpy(), pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return texts.mapInArrow(scored, f"item int, doc_id {kind}, score long")
