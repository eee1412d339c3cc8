import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and column names the operators use themselves."""
    prose = " ".join(f"word{i} thing{i % 7}" for i in range(120))
    rows = [
        (1, prose), (2, prose), (2, prose), (None, prose + " end"), (None, None), (None, None),
        (3, ""), (4, None), (5, " \n\t "), (6, "short text"), (7, "a" * 50_000), (8, "x y z " * 20_000),
        (9, "é ß 😀 \x1c \x85 <|endoftext|> don't"),
    ]
    names = ("row_number", "key", "score", "item_ids", "leaky_id", "removed_runs", "first_row", "piece", "hash", "words")
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([r + ("clash",) * len(names) for r in rows], schema)
