import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, size int, row string, spans string, host string, ids string"
)


def words(random_, n, choices=400):
    return " ".join(f"w{random_.randrange(choices)}" for _ in range(n))


def document_rows():
    """NULLs in every column, empty, blank and long texts, equal rows, equal ids, near copies."""
    r = random.Random(5)
    texts = [words(r, r.randrange(25, 120)) for _ in range(30)]
    texts[3] = texts[2]
    edited = texts[4].split()
    edited[10] = "changed"
    texts[5] = " ".join(edited)
    texts[6] = " ".join([words(r, 12)] * 9)
    texts[7] = "same line here\n" * 6 + texts[7]
    texts[8] = "### $$$ " * 30 + texts[8]
    texts[9] = texts[9].upper() + "\n\n\tx"
    texts[10] = words(r, 9000)
    texts[11] = "mail bob.jones@mail.example.com or +1 (269) 555-3296 and 192.168.1.77 now " + texts[11]
    texts[12] = "é" * 50 + " 中文 \u2581 😀 " + texts[12]
    rows = [
        (i, t, "en", f"s{i % 4}", len(t), True, 7, "r", "s", "h", "i") for i, t in enumerate(texts)
    ]
    rows += [
        (100, None, None, None, None, None, None, None, None, None, None),
        (101, "", "en", "s1", 0, False, 0, "", "", "", ""),
        (102, " \t\n\r ", "en", None, 5, True, 1, "r", "s", "h", "i"),
        (103, "one two", "en", "s1", 7, True, 1, "r", "s", "h", "i"),
        (None, "a row without an id " + words(r, 30), "en", "s2", 9, True, 1, "r", "s", "h", "i"),
        rows[1],
        rows[1],
        (2, words(r, 40), "de", "s9", 3, True, 1, "r", "s", "h", "i"),
    ]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
