import pytest

from clickloom.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def workers_can_import(spark):
    importable(spark)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, very long and repeated texts, null and repeated ids, and columns whose
    names the operators use themselves."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, "Hello World", "x"),
        (2, "hello world", "y"),
        (3, None, None),
        (4, "", "z"),
        (5, "HELLO WORLD", None),
        (5, "HELLO WORLD", None),
        (None, "no id", "w"),
        (6, "Äpfel", "w"),
        (7, "äpfel", "w"),
        (8, " ".join(f"w{i}" for i in range(30_000)), "long"),
        (9, "x" * 50_000, "long"),
        (10, base, "n"),
        (11, base.upper() + "!", "n"),
        (12, "😀 " * 40 + "😀", "emoji"),
    ]
    return spark.createDataFrame(
        [(i, t, None, s, 7, s, "q") for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score string, hash string",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
