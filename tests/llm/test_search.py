"""Language identification, ranked search and hard negatives: plain versions, edge cases and any order of the rows."""

import math
import mmap
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import language, lexical, negatives, neardup, quality, substrings
from gridloom.llm.queries import QUERIES

ITEMS = "item_id long, text string, score string, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=20):
    """The ranking by its definition, over (id, text) rows."""
    held = [(d, Counter(t), len(t)) for d, t in ((d, terms(t)) for d, t in docs)]
    full = [h for h in held if h[2]]
    n, length, out = len(full), sum(h[2] for h in full), []
    df = Counter(t for h in full for t in h[1])
    for item, text in items:
        scores = []
        for d, tf, size in full:
            m = 75 + 25 * size * n // length
            w = lambda t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
            s = sum(w(t) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms(text))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def ranks(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_edges(spark, nasty, empty):
    rows = [(1, "word MIT w5 w5 é"), (1, "word MIT w5 w5 é"), (2, None), (3, ""), (4, "... ,"), (5, "nothing-known here"), (None, "日本 same"), (6, "\x1c x \U0001f600")]
    items = spark.createDataFrame([(*r, "s", 3) for r in rows], ITEMS)
    docs = [(r.doc_id, r.text) for r in nasty.collect()]
    assert ranks(lexical.search(nasty, items)) == plain_search(docs, rows)
    assert lexical.search(empty, items).count() == 0 and lexical.search(nasty, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " . ")], "doc_id long, text string")
    assert lexical.search(blank, items).count() == 0


def test_search_in_groups_of_items_and_with_ties(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice(["Alpha", "beta", "gamma", "béta", "x1", "le", "the", "tha", "a"])
    sep = lambda: rnd.choice([" ", "  ", "-", "\n", "\x00", "_", "."])
    docs = [(k, "".join(word() + sep() for _ in range(rnd.randint(0, 30)))) for k in range(120)]
    docs += [(200 - k, docs[7][1] + " zeta") for k in range(40)]  # forty equal scores
    items = [(k, " ".join(word() for _ in range(rnd.randint(1, 8)))) for k in range(9)] + [(50, "zeta zeta the")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = plain_search(docs, items)
    assert ranks(lexical.search(d, i)) == want
    assert ranks(lexical.search(d, i, group_terms=7)) == want  # several automata
    text_ids = lexical.search(d.withColumn("doc_id", F.format_string("d%05d", "doc_id")), i)
    assert sorted((r.item_id, r.rank, int(r.doc_id[1:]), r.score) for r in text_ids.collect()) == sorted(want)


def test_automaton_counts_whole_terms_only():
    scanner = lexical.Scanner(["a", "ab", "b", "é"])
    text = lexical.folded("A ab-AB,aé b.b b")
    assert dict(scanner.count(text)) == {0: 1, 1: 2, 2: 3} and lexical.count_terms(text) == 7
    assert not lexical.Scanner([]).count(text)


def plain_negatives(rows):
    """Hard negatives by their definition, over (id, vector, label) rows."""
    good = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((k, i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, i, v, label in good:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, w, other in good if m != k)
        for p in [s for s in scored if s[3] == label][:5]:
            fit = [s for s in scored if s[3] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:5]
            out += [(i, p[1], n + 1, s[1], -p[0], -s[0]) for n, s in enumerate(fit)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, row long, id string, score double, anchor string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5, "y") for r in rows], VECTORS)


def test_hard_negatives(spark, monkeypatch):
    rnd = random.Random(3)
    vec = lambda: [float(np.float32(rnd.gauss(0, 0.4))) for _ in range(4)]
    rows = [(k, vec(), rnd.randrange(3)) for k in range(400)]
    rows += [(k, [0.5, 0.5, 0.5, 0.5], k % 2) for k in range(400, 520)]  # ties without end, two labels
    rows += [(100, [0.5, 0.5, 0.5, 0.5], 0), (600, [], 1), (700, [1.0, -1.0], 1), (601, [], 2), (None, vec(), 1)]
    rows += [(800, None, 1), (900, vec(), None), (1000, [float("nan"), 1.0], 1), (1100, [None, 1.0], 1), (1200, [float("inf")], 1)]
    want = plain_negatives(rows)
    assert sorted(map(tuple, negatives.mine_negatives(vectors(spark, rows)).collect())) == want and len(want) > 50
    monkeypatch.setattr(negatives, "BLOCK", 50)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 2)
    monkeypatch.setattr(negatives, "CELLS", 100)
    assert sorted(map(tuple, negatives.mine_negatives(vectors(spark, rows)).collect())) == want
    assert negatives.mine_negatives(vectors(spark, rows).limit(0)).count() == 0
    assert negatives.mine_negatives(vectors(spark, [(100, [1.0], 1), (101, [1.0], 2)])).count() == 0


def test_hard_negatives_of_chosen_anchors(spark):
    rows = spark.createDataFrame([("1", [1.0], "a"), ("2", [1.0], "a"), ("3", [0.9], "b")], "key string, embedding array<double>, label string")
    got = negatives.mine_negatives(rows, "key", is_anchor=F.col("id") == 2, label=F.ascii("label"))
    assert [tuple(r) for r in got.collect()] == [(2, 1, 1, 3, 256 * 256, 256 * 230)]


def test_keys_sort_like_their_parts():
    rnd = random.Random(1)
    parts = [(rnd.randrange(3), rnd.choice([-(2**62), -1, 0, 1, 2**62]), rnd.random() < 0.5, rnd.randrange(-2, 3), rnd.randrange(3)) for _ in range(300)]
    keys = [negatives.packed(*p) for p in parts]
    assert [negatives.unpacked(k) for k in keys] == parts
    assert [negatives.unpacked(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], *p[2:]))


def plain_languages(rows, learn):
    """The scoring by its definition, with dictionaries."""
    langs = sorted({lang for lang, _ in learn})
    counts = Counter()
    for lang, text in set(learn):
        for w in language.split_words(text):
            counts[lang, 0, w] += 1
            for n in language.GRAMS:
                for g in language.grams(w, n):
                    counts[lang, n, g] += 1
    total = Counter()
    for (lang, n, _), c in counts.items():
        total[lang, n] += c
    least = {k: min(c for (lang, n, _), c in counts.items() if (lang, n) == k) for k in total}

    def entry(lang, n, g):
        known = counts.get((lang, n, g))
        return math.log(known / total[lang, n]) if known else math.log(least[lang, n] / total[lang, n]) - language.PENALTY

    def word(lang, w):
        if any((x, 0, w) in counts for x in langs):
            return entry(lang, 0, w)
        for n in language.GRAMS:
            known = [g for g in language.grams(w, n) if any((x, n, g) in counts for x in langs)]
            if known:
                return sum(entry(lang, n, g) for g in known) / len(known)
        return 0.0

    out = {}
    for d, text in rows:
        found = language.split_words(text)
        if not found:
            out[d] = ("und", 0.0)
            continue
        means = [sum(word(lang, w) for w in found) / len(found) for lang in langs]
        best = max(range(len(langs)), key=lambda k: means[k])
        belief = sum(math.exp((m - means[best]) * min(len(found), language.EVIDENCE)) for m in means)
        out[d] = (langs[best], 1 / belief)
    return out


def test_languages_against_the_plain_scoring(spark):
    text = {"en": "the house and the dog went out", "de": "das haus und der hund ging hinaus", "fr": "la maison et le chien sortent"}
    rows = [(k, " ".join(random.Random(k).sample(text[x].split(), 4)), x) for k, x in enumerate(list(text) * 12)]
    rows += [(100, "houses dogged", None), (101, "hundert", "en"), (102, "", "en"), (103, None, "fr"), (104, "12 34 !", "fr"), (105, "日本", None)]
    docs = spark.createDataFrame([(d, t, x, 1.0) for d, t, x in rows], "doc_id long, text string, lang string, score double")
    learn = [(x, t) for d, t, x in rows if x and t is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    want = plain_languages([r[:2] for r in rows], learn)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows)
    for d, (lang, score) in want.items():
        assert got[d].lang_pred == lang and got[d].score == pytest.approx(score, abs=1e-4)
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
    assert {got[d].lang_pred for d in (102, 103, 104)} == {"und"}


def test_languages_edges(spark, nasty, empty):
    assert language.identify(empty).count() == 0
    got = language.identify(nasty.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(got) == nasty.count() and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}  # nothing to learn from
    mixed = language.identify(nasty.withColumn("lang", F.when(F.col("row") % 2 == 0, "en").otherwise("xx"))).collect()
    assert len(mixed) == nasty.count() and {r.lang_pred for r in mixed if r.doc_id in (1, 2, 3, 12)} == {"und"}


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op11_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out and lang is not null")
    assert got.agg(F.avg(F.expr("cast(lang = lang_pred as int)"))).first()[0] > 0.97


def test_row_numbers_do_not_depend_on_the_number_of_executors(spark, tmp_path):
    from gridloom.llm.common import numbered

    path = str(tmp_path / "many")
    spark.range(3000).withColumn("_path", F.lit("x")).repartition(12).write.parquet(path)
    got = []
    for cores in ("1", "2", "6"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
        try:
            rows = numbered(spark.read.parquet(path), ["id", "_path"], "n").collect()
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        got.append({r.id: r.n for r in rows})
    assert got[0] == got[1] == got[2] and len(set(got[0].values())) == 3000
    assert numbered(spark.range(5).limit(0), ["id"]).count() == 0


def test_further_links_join_components(spark):
    from gridloom.llm.common import components, extend_components

    links = "a long, b long"
    joined = components(spark.createDataFrame([(2, 1), (3, 2), (11, 10), (21, 20)], links))
    more = spark.createDataFrame([(3, 11), (10, 1), (30, 21), (40, 41), (2, 1)], links)
    got = {r.node: r.component for r in extend_components(joined, more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 20: 20, 21: 20, 30: 20, 40: 40, 41: 40}


def test_pipeline_stages_keep_columns_of_any_name(spark, nasty, tmp_path):
    import corpus_pipeline

    path = str(tmp_path / "docs")
    names = ["_quality", "_row", "_time", "_path", "_index"]
    nasty.select("doc_id", "text", "lang", F.coalesce("source", F.lit("s")).alias("source"), *[F.lit(n).alias(n) for n in names]).write.parquet(path)
    docs = spark.read.parquet(path)
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.mix_sources):
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and all([r[n] for n in names] == names for r in got.collect())


def test_quality_of_documents_with_text_ids(spark):
    from gridloom.llm import quality

    docs = spark.createDataFrame([(f"d{k}", "good clear prose" if k % 2 else "!!! ??? ###") for k in range(60)], "doc_id string, text string")
    labels = docs.select("doc_id", F.col("text").startswith("good").cast("int").alias("quality"))
    got = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 60 and all((r.score > 0.5) == bool(r.quality) for r in got)


@pytest.mark.parametrize("call", [language.identify, neardup.near_duplicates, lambda docs: quality.score(docs, np.zeros(quality.FEATURES + 1))])
def test_rows_reach_python_a_few_megabytes_at_a_time(spark, call):
    """A split of texts was one batch of up to 10,000 rows, held several times beside the heap."""
    docs = spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word"), "id", F.lit(" ")), 250).alias("text"), F.lit("xx").alias("lang")
    )
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    call(docs)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "n"])

    got = docs.select("text").mapInArrow(sizes, "bytes long, n long").collect()
    assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 4_000_000


def test_language_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(k, f"un deux mot{k} trois" if k % 2 else f"one two word{k} three one", "fr" if k % 2 else "en") for k in range(60)],
        "doc_id long, text string, lang string",
    ).repartition(2)
    whole = language.fit(docs)
    monkeypatch.setattr(language, "HELD", 7)
    parts = language.fit(docs)
    assert whole.languages == parts.languages == ["en", "fr"]
    for a, b in ((whole.words, parts.words), (whole.grams, parts.grams)):
        assert a.keys() == b.keys() and all((a[k] == b[k]).all() for k in a)


def test_substring_tables_are_handed_on_in_parts(spark, monkeypatch):
    """A split of texts, and all that was cut out of it, was one batch of a task."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    substrings.remove_repeats(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string"))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "2m"
    text = " ".join(f"w{k}" for k in range(1000))
    asked = [{"bucket": k, "lo": 9 * k, "hi": 9 * k + 20, "anchor": 9 * k + 25, "alone": True} for k in range(10)]
    kind = pa.list_(pa.struct([("bucket", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("anchor", pa.int64()), ("alone", pa.bool_())]))
    given = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([text]), pa.array([asked], kind)], ["row", "text", "asked"])
    whole = pa.Table.from_batches(substrings._contents([given]))
    zones = whole.append_column("asked", pa.nulls(10, pa.list_(pa.int64()))).select(
        ["bucket", "row", "lo", "hi", "anchor", "alone", "content", "asked"]
    )
    pieces = pa.Table.from_batches(substrings._pieces(8, 64)(zones.to_batches()))
    monkeypatch.setattr(substrings, "HELD_ROWS", 5)
    monkeypatch.setattr(substrings, "HELD_ZONES", 4)
    parts = list(substrings._contents([given]))
    assert [b.num_rows for b in parts] == [4, 4, 2] and pa.Table.from_batches(parts).equals(whole)
    cut = list(substrings._pieces(8, 64)(zones.to_batches()))
    assert len(cut) == 5 and max(b.num_rows for b in cut) < 10 and pa.Table.from_batches(cut).equals(pieces)


def test_the_classifiers_sample_is_not_held_in_memory(spark, monkeypatch):
    """All vectors of the sample were one Arrow table of one worker, which kept its size for what it ran later."""
    docs = spark.range(0, 800, 1, 4).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(1500)), lambda k: F.concat(F.lit("w"), F.col("id") * 7 + k))).alias("text")
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))

    def train(rows, settings):
        held = 0
        for found, values, _ in rows:
            for x in (found, values):
                while isinstance(x, np.ndarray):
                    x = x.base
                held += not isinstance(x, mmap.mmap)
        w = np.zeros(quality.FEATURES + 1, np.float32)
        w[:2] = held, len(rows)
        return w

    monkeypatch.setattr(quality, "train", train)
    held, rows = quality.fit(docs, labels)[:2]
    assert rows > 500 and held == 0
