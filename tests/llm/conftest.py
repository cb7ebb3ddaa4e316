import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (None, "a text without an id, said twice", None, None, None),
        (None, "a text without an id, said twice", None, None, None),
        (1, None, "en", None, 0),
        (2, "", None, "s", 0),
        (3, " \n\t ", "en", "s", 4),
        (4, long, "en", "s", len(long)),
        (5, long, "en", "s", len(long)),
        (6, "one two", "en", "s", 7),
        (6, "one two", "en", "s", 7),
        (7, "One\x0bTWO", "en", "s", 7),
        (8, "Ünïcode ЖЖ 漢字 🙂 it's 3.14 <|endoftext|>", "xx", "s", 9),
        (9, "!!! ??? ...", "en", "s", 11),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.selectExpr("*", "1 as row", "'x' as doc", "2L as `key`", "0.5 as score", "'h' as hash", "7 as print", "8 as part")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
