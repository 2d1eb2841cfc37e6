"""A training corpus from raw documents: classify, deduplicate, decontaminate, mix, and write token files.

Each stage gets the documents that the one before kept, and all but the last
return rows with the columns of ``documents``, further ones of any name included.
Rows are kept or dropped whole. Null and empty texts, repeated rows and ties are
treated as each operator says; a stage without documents returns none.
The training order of the mix is the order of partitions and rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm import decontaminate, mixing, neardup, quality, tokenfiles
from gridloom.llm.common import as_written, bounded_broadcast, fresh, numbered, read
from gridloom.llm.queries import tokenizer_file
from gridloom.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the training fold."""
    weights, score = quality.fit(docs, read(spark, sf_dir, "labels")), fresh(docs, "_quality")
    return quality.score(docs, weights, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id."""
    row = fresh(docs, "_row")
    held = numbered(docs, docs.columns, row)
    found = neardup.near_duplicates(held, row=row)
    return _without(held, found.where("not kept").select(row), docs, row)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    row = fresh(docs, "_row")
    held = numbered(docs, docs.columns, row)
    found = decontaminate.contaminated(held, read(spark, sf_dir, "benchmark"), row=row)
    return _without(held, found.select(row).distinct(), docs, row)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: a document once for each pass that takes at least half of its words, sorted by training time."""
    row, time = fresh(docs, "_row"), fresh(docs, "_time")
    held = numbered(docs, docs.columns, row)
    mixed = mixing.mix(held.select(row, "doc_id", "text", "source"), keep=[row])
    passes = mixed.select(row, "size", F.explode("epochs").alias("pass")).where(F.col("pass.words") * 2 >= F.col("size"))
    passes = cut_lineage(passes.select(row, F.col("pass.time").alias(time)))
    return held.join(passes, row).repartitionByRange(time, row).sortWithinPartitions(time, row).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, and what they hold of each document."""
    held, order = as_written(docs, ["doc_id", "text"])
    return tokenfiles.encode_and_read(held, tokenizer_file(), order=order)


def _without(held: DataFrame, rows: DataFrame, docs: DataFrame, row: str) -> DataFrame:
    return held.join(bounded_broadcast(cut_lineage(rows)), row, "left_anti").select(*docs.columns)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_first),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: A trained classifier and a tokenizer have no SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is held in the shared folder before the next."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut_lineage(docs) if n + 1 < len(STAGES) else docs
    return docs
