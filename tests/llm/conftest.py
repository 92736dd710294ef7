import pytest

LONG = " ".join(f"word{i % 7919} {'x' * (i % 11)}" for i in range(30_000))
BASE = " ".join(f"token{i}" for i in range(120))
ROWS = [
    (1, "Hello world"), (2, None), (3, ""), (4, "Hello \t\n world"), (5, "a b c d e f"), (None, "no id"), (7, LONG), (1, "Hello world"), (8, "tie"), (9, "tie"), (10, LONG),
    (11, BASE), (12, BASE.replace("token60", "other")), (13, BASE + " end"), (14, "ééé 日本語 \U0001f600 \n\n two  spaces"), (15, "\x00 odd \x01"), (16, "   "), (17, "##$$ %% && ** ||| <<>> " * 20),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(*r, "uid", 1, True, 2.5, None, "h") for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, uid string, shard int, kept boolean, score double, _uid long, rep string").cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter("false")
