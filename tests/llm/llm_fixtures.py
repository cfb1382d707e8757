"""Fixtures that the operators' tests import by name."""
import pytest

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names the operators use themselves."""
    from pulsehouse.llm.common import prepare
    prepare(spark)
    long = " ".join(f"word{i % 977} idiot{i % 7}" for i in range(120_000))
    rows = [(1, "A small text, said once.", "en", "a", 24), (1, "A small text, said once.", "en", "a", 24),
            (2, None, "en", "b", None), (3, "", None, None, 0), (4, long, "en", "a", len(long)),
            (None, "no id here but words enough to count as one", "en", "b", 10), (None, None, None, None, None),
            (5, "é ß 漢字   \t\n x", "fr", "", 3), (6, "...", "en", "c", 3), (7, "two words", "en", "c", 9)]
    return spark.createDataFrame(
        [(*r, 0.5, 1, "x", 9, "y", "z") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, size long, "
        "id string, node int, label string, s string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
