import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def words(text):
    return WORD.findall(text or "")


def passage(seed, n):
    """``n`` words that differ by seed."""
    return " ".join(f"w{seed}x{i * 7 % 101}y{i}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and very long texts, copies, near copies, shared passages,
    hot words, repeated lines and short texts."""
    long = passage(1, 9000) + " " + "z" * 30000
    shared = passage(2, 60)
    rows = [
        (0, None, "en", "a", 0), (1, "", "en", None, 0), (2, " \t\n\x0b ", None, "a", 5),
        (3, long, "en", "b", None), (4, "one two", "en", "b", 7), (5, "ONE two", "de", "b", 7),
        (6, shared + " " + passage(3, 80), "en", "a", 1), (7, passage(4, 70) + "\n" + shared, "en", "c", 1),
        (8, passage(5, 120), "en", "c", 1), (9, passage(5, 120), "fr", "a", 1),
        (10, passage(5, 117) + " changed the end", "en", "a", 1),
        (11, "the the the the the the the the the the the the the the the the", "en", "a", 1),
        (12, "same line here ok\nsame line here ok\n" + passage(6, 200), "en", "a", 1),
        (13, "é" * 50 + " ### $$$ " * 40, "fr", "b", 1), (14, shared, "en", "b", 1),
        (15, passage(7, 13), "en", "a", 1), (16, passage(7, 13) + " x", "en", "a", 1),
        (17, passage(8, 5) + " <|endoftext|> " + passage(8, 6), "en", "d", 1),
    ]
    rows += [(100 + i, passage(9, 40), "en", "hot", 1) for i in range(30)]
    rows += [(200 + i, passage(9, 40).replace("y3 ", f"q{i} "), "en", "hot", 1) for i in range(20)]
    return rows


@pytest.fixture(scope="session")
def documents(spark, odd_docs):
    return spark.createDataFrame(odd_docs, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
