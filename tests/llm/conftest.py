import pytest

LONG = " ".join(f"word{i} grows." for i in range(30_000))
PROSE = "\n".join(" ".join(f"w{(i * 7 + j * j) % 97}x" for j in range(12)) for i in range(9))
TEXTS = [
    None, "", " ", "\n", "one", PROSE, PROSE, PROSE + " end", LONG, "A\x00b é 日本 🙂 \u00a0 x\u2003y",
    "Shared Line\nown one\n shared line ", "SHARED LINE\nown two", "<|endoftext|> </s>[INST]", "x" * 5000,
]


def rows():
    """(doc_id, text): nulls, ties, repeated rows, empty and long texts."""
    listed = list(enumerate(TEXTS))
    return [*listed, (None, "no id"), (None, "no id"), (5, PROSE), (5, "same id, other text")]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with extra columns whose names clash with results and helpers."""
    given = [(i, t, None if i is None else f"src{i % 2}", "a", "b", "c", 1, 2, "d") for i, t in rows()]
    return spark.createDataFrame(
        given, "doc_id long, text string, source string, row string, k1 string, kept string,"
        " n_lines long, sequence_id long, `odd name` string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
