import pytest

NASTY = "doc_id long, text string, lang string, source string, n_chars long, row long, size int, score string, _hash int"


@pytest.fixture(scope="session")
def nasty(spark, tmp_path_factory):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash with inner ones."""
    long = "One long line of words that goes on and on, number %d. " * 40
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "Released under the MIT License."),
        (6, long.replace("%d", "7")), (6, long.replace("%d", "7")), (7, long.replace("%d", "7")),
        (None, "No id here, write to a.b@c.example or +1 (555) 123-4567."), (8, "é" * 500), (9, "ß ж 日本 \U0001f600 \x1c x"),
        (10, " ".join(f"w{k}" for k in range(60_000))), (11, "same same same same same same same"), (12, None),
    ]
    rows = [(d, t, None, None if k % 3 else f"s{k % 2}", None, k, 1, "x", 2) for k, (d, t) in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("nasty") / "documents")
    spark.createDataFrame(rows, NASTY).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(nasty):
    return nasty.limit(0)
