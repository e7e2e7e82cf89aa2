import pytest

from barproof.llm.registry import importable

DOCUMENT = "doc_id long, text string, lang string, source string"
#: Columns whose names the operators use themselves.
CLASHING = "size int, kept string, n int, digest string, key string, block int, anchor int, stack string"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text[, lang[, source]]), with extra columns of clashing names."""

    def make(rows):
        padded = [(*row, *[None] * (4 - len(row)), 1, "x", 2, "y", "z", 3, 4, "w") for row in rows]
        return spark.createDataFrame(padded, f"{DOCUMENT}, {CLASHING}")

    return make
