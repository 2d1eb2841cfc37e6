"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import decontaminate, html, licenses, mixing, neardup, pii, quality, substrings, tokenfiles, vectors
from gridloom.llm.queries import tokenizer_file

ITEMS = "item_id long, text string"


def test_licenses(nasty, empty):
    got = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(nasty).collect()}
    assert licenses.scan_licenses(nasty).count() == 14 and licenses.scan_licenses(empty).count() == 0
    assert got[5, 5].labels == "mit" and got[5, 5].first_word == 3 and got[5, 5].n_base == 1
    assert got[1, 0].labels == "" and got[1, 0].score == 0.0 and got[1, 0].first_word is None
    assert got[10, 60000].n_base == 0


def test_license_notice_without_phrase(spark):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation files"
    r = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.labels == "mit" and r.base_labels == "" and 0.9 <= r.score < 1 and r.notices_found[0].block == 0


def test_wrapped_license_notices(spark):
    import textwrap

    wrap = lambda text, width, lead="": "\n".join(lead + x for x in textwrap.wrap(text, width))
    rows = []
    for n, (label, text) in enumerate(licenses.NOTICES):
        rows += [(f"{label}", f"Copyright 2020 A. Body\n\n{wrap('All of it: ' + text + ' as follows', 30, ' * ')}\nint x = {n};")]
    words = licenses.NOTICES[2][1].split()
    rows += [("", " ".join(words[:9]) + "\n" + "and then other things\n" * 12 + " ".join(words[9:])), ("", "\n".join(words[:15]))]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert all(set(r.doc_id.split()) <= set(r.labels.split(",")) for r in got) and len(got) == len(rows)
    assert all(r.labels == "" and r.score == 0.0 for r in got if not r.doc_id)
    assert all(r.score == 1.0 and [x.block for x in r.notices_found if x.label == r.doc_id][0] == 2 for r in got if r.doc_id)
    assert [r.base_labels for r in got if r.doc_id in ("bsd", "isc", "unlicense")] == [""] * 3


def test_decontamination(spark, nasty, empty):
    item = " ".join(f"w{k}" for k in range(100, 140))
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (5, item.replace("w120", "x"))], ITEMS)
    got = sorted(tuple(r)[:4] for r in decontaminate.contaminated(nasty, items).collect())
    assert [g[:2] for g in got] == [(10, 1), (10, 1)] and got[0][2] == 1.0 and got[0][3] == 100
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(nasty, items.limit(0)).count() == 0


def test_decontamination_of_near_copies(spark):
    words = [f"t{k}" for k in range(90)]
    near = ["intro"] * 7 + words[:40] + ["changed"] + words[41:] + ["end"] * 3  # 81 of 91 shingles: 0.89
    far = [w if k % 12 else "x" for k, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(near)), (2, " ".join(far)), (3, " ".join(words).upper())], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, spark.createDataFrame([(9, " ".join(words))], ITEMS)).collect()}
    assert set(got) == {1, 3} and got[3].similarity == 1.0
    assert got[1].first_word == 7 and abs(got[1].similarity - 81 / 91) < 1e-12


def test_decontamination_of_short_items(spark, tmp_path):
    from gridloom.llm.oracle import SQL
    from tests.compare import connect

    docs = [(1, "Before: the Blue, whale. After"), (2, "the blue"), (3, "whale the blue"), (4, "blue whale"), (5, None), (6, ""),
            (7, "one two three four five six one two three four"), (8, "blue whale blue whale")]
    items = [(1, "The blue whale"), (2, "whale"), (3, "one two three four five"), (4, "two three four"), (5, "?!"), (6, None), (7, "a b c d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontaminate.contaminated(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    got = sorted(tuple(r) for r in got.select("doc_id", "item_id", "similarity", "first_word").collect())
    want = [(1, 1, 1), (1, 2, 3), (3, 2, 0), (4, 2, 1), (7, 3, 0), (7, 4, 1), (8, 2, 1)]
    assert got == [(d, i, 1.0, p) for d, i, p in want]
    con = connect("/root/testdata/sf0.001")
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    columns = "doc_id, item_id, similarity, first_word"
    assert sorted(con.execute(f"SELECT {columns} FROM ({SQL['op2_benchmark_decontamination']})").fetchall()) == got


def test_mixing(nasty, empty):
    got = mixing.mix(nasty).collect()
    assert len(got) == 14 and mixing.mix(empty).count() == 0
    per = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        per.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    assert all(abs(taken - target) <= 0.5 and target <= 2 * size for taken, target, size in per.values())
    assert abs(sum(t for _, t, _ in per.values()) - 1.5 * sum(s for *_, s in per.values())) < 1e-6
    assert [r.position for r in got if r.position is not None] == sorted(r.position for r in got if r.position is not None)


def test_mixing_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r.size, r.taken, r.target) for r in mixing.mix(docs).collect()] == [(0, 0, 0.0)] * 2


def test_quality(spark, nasty, empty):
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 0), (9, None, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(nasty, labels).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3, 12)}) == 1 and len({r.score for r in got if r.doc_id in (6, 7)}) == 1
    none = quality.classify(nasty, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert quality.score(nasty, np.zeros(quality.FEATURES + 1)).schema["score"].dataType.simpleString() == "double"


def test_near_duplicates(nasty, empty):
    got = neardup.near_duplicates(nasty).collect()
    assert len(got) == 14 and neardup.near_duplicates(empty).count() == 0
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r)
    assert sorted(r.doc_id for r in classes[6]) == [6, 6, 7] and sum(r.kept for r in classes[6]) == 1
    assert all(r.kept and r.class_size == 1 for r in got if r.doc_id not in (6, 7))


def test_token_files(spark, nasty, empty, tmp_path):
    files = tokenfiles.write_sequences(nasty, tokenizer_file(), str(tmp_path / "t"), length=128)
    got = tokenfiles.read_documents(files).collect()
    assert len(got) == 14 and {r.n_tokens for r in got if r.doc_id in (1, 2, 12)} == {1}
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[:-1] == sorted(order[:-1]) and order[-1] is None
    one = files.first()
    ids, mask = tokenfiles.sequence(one.path, 0)
    assert len(ids) == len(mask) == 128 and not ids.flags["OWNDATA"]
    held = pa.total_allocated_bytes()
    views = tokenfiles.sequence_view(one.path, 0)
    assert [v.to_pylist() for v in views] == [ids.tolist(), mask.tolist()] and pa.total_allocated_bytes() == held
    assert tokenfiles.encode_and_read(empty, tokenizer_file(), str(tmp_path / "e")).count() == 0


def test_html(spark):
    page = "<body><div class=ad>x</div><article><h1>T &amp; t</h1><p>a\n b<script>var x='</p>'</script></article></body>"
    loose = "<body><div>Menu of all</div><p>%s text that is its own and long</p><p>Seen everywhere</p></body>"
    rows = [
        (1, "http://h/a", page), (2, "http://h/a", page), (3, None, None), (4, "", ""), (5, "http://k/1", loose % "first"),
        (6, "http://k/2?q", loose % "second"), (6, "http://z/1", loose % "third"), (None, "http://z/1", loose % "third"),
        (7, "not a url", "<p>open <b"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("row", F.lit(1)).withColumn("at", F.lit("x"))
    got = [(r.page_id, r.text, r.n_chars) for r in html.extract(pages).collect()]
    assert len(got) == 9 and html.extract(pages.limit(0)).count() == 0
    texts = {p: [t for q, t, _ in got if q == p] for p, *_ in got}
    assert texts[1] == texts[2] == ["T & t\na b"] and texts[3] == texts[4] == [""] and texts[7] == ["open"]
    assert texts[5] == ["first text that is its own and long"]
    assert texts[None] == ["Menu of all\nthird text that is its own and long\nSeen everywhere"]  # a copy, not a template
    assert all(n == len(t) for _, t, n in got)


def test_html_cuts_no_article():
    text = lambda page: [t for t, *_ in html.blocks(page)]
    for around in ('div class="content-sidebar-wrap"', 'div class="page has-sidebar"', 'div class="no-sidebar"', 'div id="sidebar"', "form", 'app-root class="widget"', "aside"):
        for inner in ("main", "article"):
            tag = around.split()[0]
            assert text(f"<body><{around}><{inner}><p>Own text</p></{inner}></{tag}><div class=ad>x</div></body>") == ["Own text"], around
    kept = '<h2 id="related-work">A</h2><h2 id="related">B</h2><p class="notice">C</p><section id="search-results"><p>D</p></section>'
    kept += '<div class="post-header"><p>E</p></div><div data-id="ad" title="x class=ad"><p>F</p></div>'
    gone = '<div class="x ad">G</div><div id=comments><article class=comment><p>H</p></article></div><ul role="navigation"><li>I</ul>'
    assert text(f"<article>{kept}{gone}</article>") == list("ABCDEF")
    assert text("<main><p>A</p></main><aside><article><p>B</p></article></aside><footer>C</footer>") == ["A"]  # a teaser
    assert text('<div class="sidebar">A</div><div class="sidebar-wrap"><main></main><p>B</p></div>') == ["B"]


def test_repeats(nasty, empty):
    got = substrings.remove_repeats(nasty).collect()
    assert len(got) == 14 and substrings.remove_repeats(empty).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.kept_sha256 == none and r.n_removed == r.n_bytes and r.n_spans == (r.n_bytes > 0) for r in got if r.doc_id in (1, 2, 6, 7, 8, 12))
    assert [r.n_removed for r in got if r.doc_id == 10] == [0]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (9, [1.0, 0.0], 2), (8, [1.0, 0.0], None),
        (7, None, 1), (10, [], 1), (11, [0.0, 0.0], 1), (12, [nan, 1.0], 1), (13, [None, 1.0], 1), (14, [inf, 1.0], 1),
        (15, [1.0, 0.1, 0.0], 1), (16, [1.0, 0.38], 1), (17, [1.0, 0.42], 1), (None, [-1.0, 0.0], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(0))
    got = [tuple(r) for r in vectors.near_vectors(table).collect()]
    assert len(got) == 16 and vectors.near_vectors(table.limit(0)).count() == 0
    by = {g[0]: g for g in got}
    assert by[3] == (3, 4, 3, True) and by[5] == (5, 4, 3, False) and by[16] == (16, 5, 3, False) and by[17] == (17, 1, 3, False)
    assert [g for g in got if g[0] == 4] == [(4, 4, 3, False)] * 2
    assert all(by[k] == (k, 0, k, True) for k in (7, 8, 9, 10, 11, 12, 13, 14, 15)) and by[None] == (None, 0, None, True)


def test_personal_data(nasty, empty):
    got = {r.doc_id: r for r in pii.find(nasty).collect()}
    assert pii.find(nasty).count() == 14 and pii.find(empty).count() == 0
    assert got[None].spans.split(",")[:2] == ["email:21:34", "phone:38:55"] and got[None].n_phone == 1
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[1].redacted == ""
    assert got[None].redacted == "No id here, write to [email] or [phone]."


def test_numbers_behind_keywords_are_added(spark):
    rng = np.random.default_rng(3)
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    rows, want = [], []
    for _ in range(300):
        phone, number = f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)}-{n(2)}-{n(4)}"
        for kind, lead, s in (("local_phone", "Please call ", phone), ("id_number", "Her ssn is ", number), ("email", "Mail to ", f"u{n(3)}@x.example")):
            want.append(f"{kind}:{len(lead)}:{len(lead) + len(s)}")
            rows.append((len(rows), f"{lead}{s} now"))
        rows.append((len(rows), f"Rows {n(8)} of build {n(12)} read"))
        want.append("")
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: r.spans for r in got}
    assert [spans[k] for k in range(len(rows))] == want
    made = next(pii._examples(iter([pii.pd.DataFrame({"fold": 0, "text": ["See 555-123-4567 x", "No 123-45-6789.", "By ES9121000418450200051332 x", "auth Zm9vYmFyMTIzNDU2Nzg5"]})])))
    assert 0 not in made["label"].tolist()


@pytest.mark.parametrize("rows", ["nasty", "empty"])
def test_pipeline(spark, request, rows, tmp_path):
    docs = request.getfixturevalue(rows)
    spark.createDataFrame([(5, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "one two three four five six seven")], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"stage{k}"))
            docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        else:
            assert out.count() == docs.count()


@pytest.mark.parametrize("stored", [True, False])
def test_pipeline_writes_in_training_order(spark, tmp_path, stored):
    rows = [(k, " ".join(f"w{k % 7}" for _ in range(1 + k * 37 % 91)), f"s{k % 3}") for k in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    passes = [(p.time, r.doc_id) for r in mixing.mix(docs).collect() for p in r.epochs if p.words * 2 >= r.size]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # several files
    try:
        mixed = corpus_pipeline.mix_sources(spark, docs, "")
        if stored:
            mixed.write.parquet(str(tmp_path / "mixed"))
            mixed = spark.read.parquet(str(tmp_path / "mixed"))
            assert len(mixed.inputFiles()) > 1
        got = corpus_pipeline.write_tokens(spark, mixed, "").collect()
    finally:
        spark.conf.set(name, before)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [d for _, d in sorted(passes)]
    assert len({d for _, d in passes}) < len(passes)
