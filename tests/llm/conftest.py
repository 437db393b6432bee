import pytest

#: Names that the operators use inside.
CLASHES = ["found", "text_hash", "row_hash", "kept_text", "words", "id", "token", "n", "w", "root", "shard", "hash", "bad_id", "lost_id", "html_", "turns", "line", "seed", "entry", "cut"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall old tree near the quiet river bank"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(120_000))
    return [
        (1, None, "en", "web", 0), (2, "", "en", "web", 0), (3, " \n\t ", None, None, None), (4, "word", "en", "web", 4), (None, SENTENCE, "en", "web", None), (None, None, None, None, None),
        (5, SENTENCE, "en", "web", 5), (5, SENTENCE, "en", "web", 5), (6, SENTENCE + " indeed", "de", None, 6), (7, long, "en", "books", len(long)), (8, SENTENCE.upper(), "en", "web", 8), (9, "é" * 50 + "\u0000 \U0001f600", "fr", "web", 9),
        (10, "one two three four", "en", "web", 10), (11, "one two three four", "en", "web", 11), (12, "\n".join([SENTENCE] * 4), "en", "web", 12),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing():
    from pyspark.sql import functions as F

    def add(d):
        return d.withColumns({c: F.lit("clash") for c in CLASHES})

    return add


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
