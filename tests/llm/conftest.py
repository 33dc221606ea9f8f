import pytest

TEXTS = [
    (1, "The idiot of the town and a clown in the house", "en", "a"),
    (2, "The idiot of the town and a clown in the house", "en", "a"),   # exact copy
    (3, None, "en", "a"),                                                # null text
    (4, "", None, None),                                                 # empty, null columns
    (5, "   \n\t ", "en", "b"),                                          # blanks only
    (6, "word", "fr", "b"),                                              # shorter than a shingle
    (7, "é ß ñ 12 3.5 kg 1,000 " * 40, "de", "b"),
    (8, "lorem " * 3000, "en", "b"),                                     # long, one word
    (8, "lorem " * 3000, "en", "b"),                                     # repeated row
    (None, "a text without an id that is long enough", "en", "a"),
    (9, "!!! ??? ...", "en", "a"),                                       # no letter
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, copies, repeated rows, clashing extra columns."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(TEXTS, SCHEMA)
    for clash in ("fp", "score", "spans", "copy", "items", "bucket", "grp", "n", "rank"):
        df = df.withColumn(clash, F.lit("kept"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
