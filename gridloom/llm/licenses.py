"""License scan: exact set-similarity join of text blocks with license notices.

A block is a line of a text; its tokens are its distinct words. A notice is
found where at least ``threshold`` of its tokens occur in one block. A wrapped
notice is found as well: a block is also any stretch of words, over line ends,
that is at most ``1 / threshold`` times as long as the notice. Notice
tokens are ordered by their frequency in the whole corpus, rarest first. A
block that reaches the needed overlap ``k`` of an ``m``-token notice holds at
least one of the notice's first ``m - k + 1`` tokens (prefix filter), has at
least ``k`` tokens (length filter), and the tokens after the shared one still
suffice on both sides (positional filter). What is left is verified. Stretches
are laid around the tokens of the prefix filter alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.common import NOT_WORD, ascii_lower, bounded_broadcast, let, words
from gridloom.session import cut_lineage

#: Label and words of the phrases that are looked up word by word.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Label and words of the notices of the similarity join. Near variants of one license are short, so that each of
#: their tokens is needed.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "creative commons cc0 1 0 universal"),
    ("gpl", "licensed under the gnu general public license version"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
    ),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
    ),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

THRESHOLD = 0.9


def _needed(tokens: int, threshold: float) -> int:
    return math.ceil(threshold * tokens - 1e-9)


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def _starts(w: Column, phrase: str) -> Column:
    """All places where the phrase's words stand one after another."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)))
    return F.filter(places, lambda i: _all([F.get(w, i + k) == p for k, p in enumerate(parts)]))


def token_ranks(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES) -> dict[str, int]:
    """Rank of each notice token by its number of places in the whole corpus, rarest first.

    Only tokens of the notices are counted, so the result is as long as their
    vocabulary, whatever the corpus holds.
    """
    vocabulary = sorted({w for _, t in notices for w in t.split()})
    found = F.filter(F.split(ascii_lower(F.col("text")), NOT_WORD), lambda w: w.isin(vocabulary))
    counted = docs.select(F.explode(found).alias("token")).groupBy("token").count().collect()
    counts = {r["token"]: r["count"] for r in counted}
    return {w: n for n, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def scan_licenses(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    threshold: float = THRESHOLD,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with its phrases, notices and labels.

    Null and empty texts have no word and no label; repeated rows each get
    their row; other columns are ignored; an empty table gives no row.
    ``score`` is the greatest share of a notice's tokens found in one block,
    1.0 where a phrase occurs, and 0.0 where neither is found.
    ``notices_found`` lists label, block number and share of every block and
    notice that reach the threshold; a stretch has the number of the line where
    it begins.
    """
    spark = docs.sparkSession
    ranks = token_ranks(docs, notices)
    made = []
    for n, (label, text) in enumerate(notices):
        tokens = sorted(ranks[w] for w in set(text.split()))
        made.append((n, label, tokens, _needed(len(tokens), threshold), int(len(text.split()) / threshold + 1e-9)))
    rarest = {r for _, _, t, k, _ in made for r in t[: len(t) - k + 1]}
    names = {r: w for w, r in ranks.items()}
    fewest = min(k for *_, k, _ in made)
    reach = max(x for *_, x in made) - 1

    text = ascii_lower(F.col("text"))
    # Every text with a phrase or a notice's prefix token holds one of these words; only those are looked at closely.
    openers = sorted({p.split()[0] for _, p in phrases} | {names[r] for r in rarest})
    rank_of = F.create_map(*[F.lit(x) for w, r in ranks.items() for x in (w, r)])
    blocks = F.transform(
        F.split("_text", "\n"),
        lambda line, at: let(
            F.array_distinct(words(line)),
            lambda w: F.struct(
                at.alias("block"),
                F.size(w).alias("n"),
                F.array_sort(F.filter(F.transform(w, lambda x: F.element_at(rank_of, x)), lambda r: r.isNotNull())).alias("ranks"),
            ),
        ),
    )
    blocks = F.filter(blocks, lambda b: F.size(b["ranks"]) >= fewest)
    placed = F.flatten(
        F.transform(
            F.split("_text", "\n"),
            lambda line, at: F.transform(words(line), lambda x: F.struct(at.alias("block"), F.element_at(rank_of, x).alias("rank"))),
        )
    )

    def around(w: Column) -> Column:
        """Each token of the prefix filter with the notice tokens near it, by their distance in words."""
        spots = F.transform(w, lambda x, p: F.when(x["rank"].isin(sorted(rarest)), p))
        near = lambda p: F.slice(w, F.greatest(p - reach, F.lit(0)) + 1, F.least(p, F.lit(reach)) + reach + 1)
        listed = lambda p: F.transform(
            near(p), lambda x, i: F.struct((i - F.least(p, F.lit(reach))).alias("off"), x["block"].alias("block"), x["rank"].alias("rank"))
        )
        return F.transform(
            F.filter(spots, lambda p: p.isNotNull()),
            lambda p: F.struct(F.get(w, p)["rank"].alias("token"), F.filter(listed(p), lambda x: x["rank"].isNotNull()).alias("near")),
        )

    # Inside one line the line itself is the larger block.
    wrapped = F.filter(
        let(placed, around), lambda c: (F.size(c["near"]) >= fewest) & (F.element_at(c["near"], 1)["block"] != F.element_at(c["near"], -1)["block"])
    )
    found = let(
        words(F.col("_text")),
        lambda w: F.struct(*[_starts(w, p).alias(label) for label, p in phrases]),
    )
    first = let(
        F.split("_text", NOT_WORD),
        lambda p: F.struct(
            (
                F.size(p)
                - (F.get(p, F.lit(0)) == "").cast("int")
                - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")
            ).alias("n"),
            F.exists(p, lambda w: w.isin(openers)).alias("likely"),
        ),
    )
    likely = F.col("_first.likely")
    held = cut_lineage(
        docs.select("doc_id", text.alias("_text"))
        .withColumn("_first", first)
        .select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            F.col("_first.n").cast("long").alias("n_words"),
            F.when(likely, found).alias("_found"),
            F.when(likely, blocks).alias("_blocks"),
            F.when(likely, wrapped).alias("_wrapped"),
        )
    )
    index = spark.createDataFrame(
        [(t[i], n, label, t, i, len(t), k, x) for n, label, t, k, x in made for i in range(len(t) - k + 1)],
        "token int, notice int, label string, tokens array<int>, i int, m int, k int, longest int",
    )
    block = held.where("_blocks is not null").select("_row", F.explode("_blocks").alias("b"))
    block = block.select("_row", "b.block", "b.n", "b.ranks", F.posexplode("b.ranks").alias("j", "token"))
    matched = (
        block.join(bounded_broadcast(index, len(rarest) * len(made)), "token")
        .where("n >= k")
        .where(F.least(F.col("m") - F.col("i"), F.size("ranks") - F.col("j")) >= F.col("k"))
        .select("_row", "block", "notice", "label", "m", "k", F.size(F.array_intersect("ranks", "tokens")).alias("shared"))
        .where("shared >= k")
    )
    own = F.filter("near", lambda x: F.array_contains(F.col("tokens"), x["rank"]))
    stretches = let(
        own,
        lambda own: F.transform(
            F.filter(own, lambda s: s["off"] <= 0),
            lambda s: F.struct(
                F.size(
                    F.array_distinct(
                        F.transform(
                            F.filter(own, lambda x: (x["off"] >= s["off"]) & (x["off"] < s["off"] + F.col("longest"))), lambda x: x["rank"]
                        )
                    )
                ).alias("shared"),
                s["off"].alias("off"),
                s["block"].alias("block"),
            ),
        ),
    )
    stretch = (
        held.where("size(_wrapped) > 0")
        .select("_row", F.inline("_wrapped"))
        .join(bounded_broadcast(index, len(rarest) * len(made)), "token")
        .where("size(near) >= k")
        .select("_row", "notice", "label", "m", "k", F.array_max(stretches).alias("best"))  # of equal ones, the last
        .where("best.shared >= k")
        .select("_row", "best.block", "notice", "label", "m", "k", "best.shared")
    )
    matched = (
        matched.unionByName(stretch)
        .groupBy("_row", "block", "notice")
        .agg(F.min("label").alias("label"), F.max(F.col("shared") / F.col("m")).alias("share"))
    )
    per_row = matched.groupBy("_row").agg(
        F.collect_set("label").alias("_labels"),
        F.max("share").alias("_share"),
        F.array_sort(F.collect_list(F.struct("block", "label", "share"))).alias("notices_found"),
    )
    places = F.concat(*[F.coalesce(F.col("_found")[label], F.array().cast("array<int>")) for label, _ in phrases])
    base = F.array_compact(
        F.array(*[F.when(F.size(F.col("_found")[label]) > 0, F.lit(label)) for label, _ in sorted(phrases)])
    )
    return (
        held.drop("_blocks", "_wrapped")
        .join(per_row, "_row", "left")
        .withColumn("_places", places)
        .withColumn("_base", base)
        .select(
            "doc_id",
            "n_words",
            F.size("_places").cast("long").alias("n_base"),
            F.array_min("_places").cast("long").alias("first_word"),
            F.array_max("_places").cast("long").alias("last_word"),
            F.array_join("_base", ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>"))))), ","
            ).alias("labels"),
            F.when(F.size("_places") > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
            "notices_found",
        )
    )
