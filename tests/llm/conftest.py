import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use themselves."""
    long_text = " ".join(f"word{i % 977} thing{i % 89}," for i in range(30_000)) + "."
    rows = [(1, "Hello there, this is a text. It has two lines.\nAnd one more line of words here.", "en"), (1, "Hello there, this is a text. It has two lines.\nAnd one more line of words here.", "en"), (2, None, None), (3, "", "de"), (None, "no id here at all", "en"), (4, long_text, "en"), (5, "123 456 !!! ---", None), (6, long_text, "de"), (7, "été à là où — ñandú 日本語 🙂", "fr"), (8, "\x00\r\n\t  mixed   white\n\n\nspace ", "en"), (1, "another text of the same id", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names = ["score", "fp", "rep", "doc", "tie", "places", "spans", "part", "entries", "n", "label", "home", "fingerprint", "component_id", "sequence_id", "key"]
    return df.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
