import pytest

# Null ids, texts, languages and sources; empty and blank texts; a very long text; repeated ids and
# rows; copies; and column names that the operators use inside.
LONG = "lorem ipsum dolor sit amet " * 20_000
COPY = " ".join(f"word{i}" for i in range(80))
ROWS = [
    (1, COPY, "en", "a"),
    (2, COPY, "en", "a"),
    (3, COPY + " more", "en", None),
    (4, None, "en", "b"),
    (5, "", None, "b"),
    (6, " \t\n", "fr", "b"),
    (7, "une seule phrase", "fr", "c"),
    (7, "another text with the same id", "en", "c"),
    (8, LONG, "fr", "c"),
    (None, "a row without an id, of some words", "en", "c"),
    (9, "twice the same row", "en", "d"),
    (9, "twice the same row", "en", "d"),
    (10, "call +1 (319) 555-5132 or 10.2.3.4 é😀", None, None),
]
CLASHES = ("key0", "row", "size", "class", "bucket", "block", "group", "label", "_size", "text_", "n_words", "_found", "held_out")


def odd_documents(spark, rows=ROWS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return odd_documents(spark, [])
