import pytest

from skyrisk.llm.queries import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, score double, start long, bucket int, fp string"


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    importable(spark)


def odd(spark, texts):
    """A documents table with columns that clash with the operators' own, also by case."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", 0.5, 1, 2, "f") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, equal texts, one very long text."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    return odd(spark, [(1, None), (2, ""), (3, " \n\t "), (4, "same text here."), (5, "same text here."), (5, "same text here."),
                       (None, "no id"), (None, None), (7, long), (8, "é" * 50 + " 😀 中文 字"), (9, 'token = "0123456789abcdef0123456789"')])


@pytest.fixture(scope="session")
def empty_docs(spark):
    return odd(spark, [])


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/labels.parquet")


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, None, 1), (None, 1, 1), (5, 0, None), (5, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
