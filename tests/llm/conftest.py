import random

import pytest

SF = "/root/testdata/sf0.001"
#: columns whose names the operators use themselves
EXTRA = ["key", "row", "size", "part", "score", "component_id", "bits", "_kept", "n", "mark", "range", "set", "words", "c0", "target", "removed", "_removed"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    base = words(60, 1)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", "b"), (4, words(80, 2), "fr", None), (5, None, "fr", "b"), (6, "", None, "a"),
        (7, " \t\n \r\x0b", "en", "c"), (8, "one", "en", None), (9, "Été über ñandú " + words(5, 3), "de", "é"), (10, "first line\n" + words(12, 4) + "\n\nfirst line\n", "en", "b"),
        (11, words(12, 4) + " more\nfirst  LINE", "en", "b"), (12, words(20000, 5), "en", "a"), (None, words(30, 6), "en", "a"), (None, None, None, None),
        (13, words(30, 7), "en", "a"), (13, words(30, 7), "en", "a"), (14, words(30, 8), "en", "a"), (14, words(30, 9), "en", "a"), (15, "   nbsp word 😀 <|endoftext|> it's 1234", "es", "c"),
        (-(2**63), "least id", "en", "a"), (2**63 - 1, "largest id", "en", "a"), (16, "123 456 --- !!", "en", "a"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), *["x"] * len(EXTRA)) for r in rows]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
