import pytest

from tanimart.llm.common import ship

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and long texts, ties, repeated rows,
    columns whose names the operators use themselves."""
    words = " ".join(f"w{i * 7919 % 1009}" for i in range(4000))
    near = words.replace("w5 ", "x5 ", 1)
    rows = [
        (1, words, "en", "a", 1), (2, near, "en", "a", 2), (3, words, "en", "b", 3), (4, None, None, None, None), (5, "", "de", "b", 0),
        (6, "  \t\n ", "de", "b", 4), (7, "one two", "fr", "c", 7), (8, "ONE two", "fr", "c", 7), (9, "été über größe Привет", "fr", "c", 9),
        (10, "same row", "en", "a", 8), (10, "same row", "en", "a", 8), (None, "no id here at all", "en", "a", 17), (None, None, None, None, None),
        (11, "la " * 300, "es", "d", 900), (12, "la " * 310, "es", "d", 930), (13, "\x00 zero \x00 bytes", "en", "a", 14),
    ]
    df = llm.createDataFrame(rows, DOC)
    from pyspark.sql import functions as F
    for name in ("shard", "slot", "score", "size", "key", "cls", "th", "mix_copy", "__id", "tie", "h", "component"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOC)
