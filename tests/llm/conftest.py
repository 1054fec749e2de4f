import random

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, row string, "
          "h string, masked string, block int, score double, bucket string, size string, features string")
EXTRA = (9, "slot", None, "h", "masked", 3, 0.5, "bucket", None, "features")
WORDS = "stone river cloud maple ember quiet lantern harbor signal meadow copper violet winter orchard".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 99)) for _ in range(n))


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    base = prose(1, 60)
    return [
        document(1, base), document(2, None), document(3, ""), document(None, prose(2, 40)), document(4, prose(3, 60_000)),
        document(5, base), document(6, base), document(6, base), document(7, " \n\t\r\x0b\f "), document(8, "ÄÖ ß 😀 中文 é   x y"),
        document(9, base + " tail"), document(10, "a" * 30_000), document(11, None, None, None), document(12, "one\n" * 50, None),
        document(13, "12345 67890 !!"), document(2, None), document(14, prose(4, 30), "de"),
    ]


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(hard_rows):
    return [r[1] or "" for r in hard_rows]
