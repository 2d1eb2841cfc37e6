"""Queries without SQL, against plain versions on the smallest tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gridloom.llm import html, mixing, neardup, pii, tokenfiles
from gridloom.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


def classes(texts):
    """Smallest member of each text's class, by comparing all pairs."""
    known = neardup.WordHash()
    bags = [neardup.bag(t, known) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(bags[i][0]) and neardup.weighted_jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(texts))]


def test_quality_of_held_out_rows(spark):
    got = QUERIES["op4_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert all((zlib.crc32(str(d).encode()) % 4 == 2) == h for d, h in zip(got.doc_id, got.held_out))
    assert (held.predicted == held.quality).mean() > 0.93


def test_token_files(spark, docs):
    got = QUERIES["op5_token_files"](spark, SF).toPandas().set_index("doc_id")
    plain, at = Tokenizer.from_file(tokenizer_file()), 0
    for d, t in sorted(zip(docs.doc_id, docs.text)):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(got.loc[d]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_pieces_encode_like_whole_texts():
    rnd, encoder = random.Random(1), tokenfiles.Encoder(tokenizer_file())
    parts = ["a", "The", "é", "ж", "  ", " ", "\n", "\n\n", "\t", "\r\n", ".", ",", "'s", "don't", "23", "!!", "　", "\x1c", "́", "<|endoftext|>", ".\n", "_", "日本"]
    for _ in range(1500):
        x = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        assert np.frombuffer(encoder.encode([x])[0], encoder.kind).tolist() == encoder.tokenizer.encode(x, add_special_tokens=False).ids


def test_near_duplicates(spark, docs):
    got = QUERIES["op7_minhash_near_dedup"](spark, SF).toPandas().set_index("doc_id")
    ids = docs.doc_id.tolist()
    found = classes(docs.text.tolist())
    smallest = {}
    for d, c in zip(ids, found):
        smallest[c] = min(d, smallest.get(c, d))
    assert all(got.class_id[d] == smallest[c] and got.kept[d] == (d == smallest[c]) for d, c in zip(ids, found))


def test_signatures_estimate_the_weighted_overlap():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 9, 300)
    other = np.where(np.arange(300) < 60, np.maximum(1, counts - 3), counts)
    true = np.minimum(counts, other).sum() / np.maximum(counts, other).sum()
    agreed = []
    for seed in range(30):
        keys = neardup._mix(np.arange(300, dtype=np.uint64) + np.uint64(1000 * seed))
        sig = neardup.bag_signatures(np.concatenate([keys, keys]), np.repeat([0, 1], 300), np.concatenate([counts, other]), 2)
        agreed.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agreed) - true) < 0.02


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(w if rnd.random() > 0.02 else f"x{rnd.random()}" for w in base) for _ in range(90)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    assert [got[k] for k in range(90)] == classes(texts)


def test_repeats(spark, docs):
    got = QUERIES["op8_substring_dedup"](spark, SF).toPandas().set_index("doc_id")
    data = [(t or "").encode() for t in docs.text]
    seen = Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    for d, t in zip(docs.doc_id, data):
        gone = np.zeros(len(t) + 2, int)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i + 1 : i + 401] = 1
        kept = bytes(c for c, g in zip(t, gone[1:]) if not g)
        assert tuple(got.loc[d]) == (len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_vectors(spark, sf):
    got = QUERIES["op9_embedding_near_dedup"](spark, f"/root/testdata/sf{sf}").toPandas().set_index("vec_id")
    table = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").toPandas()
    x = np.stack(table.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (table.label.to_numpy()[:, None] == table.label.to_numpy()[None])
    np.fill_diagonal(near, False)
    label = table.vec_id.to_numpy().copy()
    for _ in range(len(label)):
        new = np.array([min([label[k], *label[near[k]]]) for k in range(len(label))])
        if (new == label).all():
            break
        label = new
    got = got.loc[table.vec_id]
    assert (got.n_links.to_numpy() == near.sum(1)).all() and (got.component_id.to_numpy() == label).all()


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_personal_data(spark, docs):
    got = QUERIES["op10_personal_data"](spark, SF).toPandas().set_index("doc_id")
    for d, t in zip(docs.doc_id, docs.text):
        want = plain_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        row = got.loc[d]
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.spans.startswith(text)
        assert [row[f"n_{k}"] for k in BASE] == [sum(k == x for x, *_ in want) for k in BASE]


def test_base_spans_of_random_texts():
    rnd = random.Random(2)
    parts = ["a", "b@", "@", "c.d", "1", "22", "333", ".", "-", " ", "+1", "+", "(5)", "4111111111111111", "1.2.3.4", "é", "256.1.1.1"]
    for _ in range(20_000):
        x = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 10)))
        assert pii.base_spans(x)[0] == plain_spans(x)


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5)).astype(float)
    model = pii.Boosted()
    model.fit(x[:2000], y[:2000])
    model.calibrate(x[2000:], y[2000:], 0.95)
    p = model.probability(x[2000:])
    assert y[2000:][p >= model.threshold].mean() >= 0.95 and (p >= model.threshold)[y[2000:] == 1].mean() > 0.9


def test_pages_keep_their_article(spark):
    got = QUERIES["op6_html_extraction"](spark, SF).toPandas().set_index("page_id")
    import html as references

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1])
        parts = [re.sub("<[^>]*>", "", x.replace("<br>", " ")) for x in re.split(r"</?(?:p|h1)>", article)]
        parts = [" ".join(references.unescape(x).split()) for x in parts]
        assert got.text[r.page_id] == "\n".join(x for x in parts if x)


def test_common_subsequences():
    rnd = random.Random(0)
    for _ in range(2000):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        i, j = html.common(a, b)
        assert len(i) == best[-1][-1] and [a[k] for k in i] == [b[k] for k in j] and i == sorted(set(i)) and j == sorted(set(j))


def test_pipeline(spark, docs, tmp_path):
    """Each stage on what the one before kept: near duplicates, leaks and the mix by plain versions."""
    held = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, held[-1], SF).write.parquet(str(tmp_path / str(k)))
        held.append(spark.read.parquet(str(tmp_path / str(k))))
    raw, good, first, clean, mixed, tokens = (h.toPandas() for h in held)
    assert set(good.doc_id) <= set(raw.doc_id) and len(good) > 0.7 * len(raw)
    found = classes(good.sort_values("doc_id").text.tolist())
    assert sorted(first.doc_id) == [d for k, (d, c) in enumerate(zip(sorted(good.doc_id), found)) if k == c]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    grams = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    items = [words(t) for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text]
    known = set().union(*(grams(i) for i in items))

    def leaks(text):
        w = words(text)
        if not known & set(grams(w)):
            return False
        for item in items:
            for k in range(max(1, len(w) - len(item) + 1)):
                a, b = grams(w[k : k + len(item)]), grams(item)
                if (a & b).total() >= 0.8 * max(1, (a | b).total()):
                    return True
        return False

    assert sorted(clean.doc_id) == sorted(d for d, t in zip(first.doc_id, first.text) if not leaks(t))
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(held[3]).collect()}
    times = Counter(mixed.doc_id)
    assert all(abs(times[d] * size - words_) <= size for d, (words_, size) in taken.items())
    assert len(tokens) == len(mixed) and Counter(tokens.doc_id) == times
