import pytest

from tablewright.llm.common import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, no two alike by chance."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "A quiet text about rivers and hills", "en", "a", 35),
        (2, "A quiet\ttext about  rivers and hills", "en", "a", 36),
        (2, "A quiet\ttext about  rivers and hills", "en", "a", 36),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n\x0b\x0c\r", "en", "b", 6),
        (6, long, "en", "c", len(long)),
        (7, long + " end", "en", "c", None),
        (None, "A quiet text about rivers and hills", "en", None, 35),
        (None, None, "de", "a", None),
        (8, "über Straße ΣΑΣ 日本語 <|endoftext|> é", "de", "c", 10),
        (8, "another text under the same id", "en", "c", 10),
        (9, "x" * 5000, "en", "a", 5000),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
