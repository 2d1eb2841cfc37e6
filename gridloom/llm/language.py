"""Language identification by words first, backing off to shorter and shorter character n-grams.

Every language has log frequencies of its words and of the n-grams of its words,
with a mark at either end. A word that any language knows is scored by its
frequency in each; a language without it gets a penalty below its rarest word.
A word that none knows is cut into its longest n-grams; if none of those is
known either, into shorter ones, down to single characters. A text's score for
a language is the mean over all its words.

The tables are fitted on a bounded sample of labelled texts by counting in
Spark, and cut to a bounded number of entries for each language.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridloom.llm.quality import training_fold
from gridloom.session import cut_lineage, release, small_batches

#: Lengths of the n-grams, longest first.
GRAMS = (5, 4, 3, 2, 1)
#: Expected bound on the distinct labelled texts that are learnt from.
SAMPLE_ROWS = 20_000
#: Languages, words and n-grams (of each length) that a model holds at most, the most frequent ones; together they
#: bound what is sent to the tasks.
LANGUAGES, WORDS, NGRAMS = 200, 20_000, 5_000
#: What a missing entry costs beyond the rarest known one of a table, in natural logs.
PENALTY = 2.0
#: Words of a text that count as independent evidence in its confidence.
EVIDENCE = 20
_SEEN = 200_000
#: Entries that a task counts before it hands them on.
HELD = 100_000

_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
UNDETERMINED = "und"


def split_words(text: str | None) -> list[str]:
    """Runs of letters (with combining marks) in lower case."""
    return _WORD.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with a blank at either end; single characters leave the blanks out."""
    marked = word if n == 1 else f" {word} "
    return [marked[k : k + n] for k in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Scores of known words and n-grams for each language, in the order of ``languages``."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]

    def word(self, word: str) -> np.ndarray:
        found = self.words.get(word)
        if found is not None:
            return found
        for n in GRAMS:
            known = [g for g in map(self.grams.get, grams(word, n)) if g is not None]
            if known:
                return np.mean(known, axis=0, dtype=np.float32)
        return np.zeros(len(self.languages), np.float32)


class Scores:
    """Mean scores of texts; the rows of words seen before are kept, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.at = model, {}
        self.table = np.zeros((1024, len(model.languages)), np.float32)

    def _row(self, word: str) -> int:
        at = self.at[word] = len(self.at)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.model.word(word)
        return at

    def text(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the belief; ties go to the first in order."""
        found = split_words(text)
        if not found or not self.model.languages:
            return UNDETERMINED, 0.0
        if len(self.at) > _SEEN:
            self.at.clear()
        rows = np.fromiter((self.at[w] if w in self.at else self._row(w) for w in found), np.int64, len(found))
        mean = self.table[rows].mean(0, dtype=np.float64)
        best = int(mean.argmax())
        belief = np.exp((mean - mean[best]) * min(len(found), EVIDENCE))
        return self.model.languages[best], float(1.0 / belief.sum())


def tables(languages: list[str], counts: dict[tuple[str, str], int]) -> dict[str, np.ndarray]:
    """Log frequencies by entry from counts by (language, entry)."""
    totals, rarest = Counter(), {}
    for (lang, _), n in counts.items():
        totals[lang] += n
        rarest[lang] = min(n, rarest.get(lang, n))
    place = {lang: k for k, lang in enumerate(languages)}
    missing = np.array(
        [math.log(rarest[x] / totals[x]) - PENALTY if x in totals else -30.0 for x in languages], np.float32
    )
    out: dict[str, np.ndarray] = {}
    for (lang, entry), n in counts.items():
        if entry not in out:
            out[entry] = missing.copy()
        out[entry][place[lang]] = math.log(n / totals[lang])
    return out


def build(languages: list[str], entries: list[tuple[str, int, str, int]]) -> Model:
    """A model from (language, length or 0 for words, entry, count)."""
    by_kind: dict[int, dict] = defaultdict(dict)
    for lang, kind, entry, n in entries:
        by_kind[kind][lang, entry] = n
    known = {kind: tables(languages, counts) for kind, counts in by_kind.items()}
    # Entries of different lengths differ, so the n-grams fit in one dictionary.
    return Model(languages, known.get(0, {}), {g: v for n in GRAMS for g, v in known.get(n, {}).items()})


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, words: int = WORDS, ngrams: int = NGRAMS) -> Model:
    """Learn from at most about ``sample_rows`` distinct texts with a language, outside the held-out fold.

    The sample holds the texts with the smallest hashes; a text counts once for
    each language that it is labelled with, however often it is repeated. Whole
    texts are counted. Rows with a null text or language are not learnt from.
    """
    small_batches(docs.sparkSession)
    given = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    given = given.where(training_fold(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    share = min(1.0, sample_rows / max(1, given.count()))
    cut = min(int(-(2**63) + share * (2**64 - 1)), 2**63 - 1)
    sample = given.where(F.xxhash64("text", F.lit("language")) <= F.lit(cut)).dropDuplicates(["lang", "text"])

    def made(counts: Counter, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
        parts = zip(*counts) if counts else [()] * len(kinds)
        arrays = [pa.array(list(p), t) for p, t in zip(parts, kinds)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(list(counts.values()), pa.int64())], [*names, "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, form = Counter(), ([pa.string(), pa.string()], ["lang", "word"])
        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                lang = lang.as_py()
                counts.update((lang, w) for w in split_words(text.as_py()))
                if len(counts) > HELD:
                    yield made(counts, *form)
                    counts.clear()
        yield made(counts, *form)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, form = Counter(), ([pa.string(), pa.int32(), pa.string()], ["lang", "kind", "entry"])
        for b in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns)):
                counts[lang, 0, word] += n
                for size in GRAMS:
                    for g in grams(word, size):
                        counts[lang, size, g] += n
                if len(counts) > HELD:
                    yield made(counts, *form)
                    counts.clear()
        yield made(counts, *form)

    seen = sample.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    entries = cut_lineage(
        seen.mapInArrow(cut_up, "lang string, kind int, entry string, n long").groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))
    )
    sizes = entries.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang")
    languages = sorted(r.lang for r in sizes.limit(LANGUAGES).collect())
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "entry")
    ranked = entries.where(F.col("lang").isin(languages)).withColumn("rank", F.row_number().over(order))
    kept = ranked.where(F.col("rank") <= F.when(F.col("kind") == 0, words).otherwise(ngrams))
    found = [(r.lang, r.kind, r.entry, r.n) for r in kept.select("lang", "kind", "entry", "n").collect()]
    release(entries)
    return build(languages, found)


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: ``doc_id, held_out, lang_pred, score``.

    Only texts are looked at for a prediction. A text that is null, empty or
    without a letter is ``und`` with score 0, and so is every text if there is
    nothing to learn from. Very long texts are read whole. Repeated rows are
    predicted alike; of equally likely languages the first in alphabetical
    order is taken. Other columns don't matter. An empty table gives no row.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(sent.value)
        for b in batches:
            made = [scores.text(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    found = docs.select("doc_id", "text").mapInArrow(predicted, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", (~training_fold(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")
