import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, piece string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, extra columns with clashing names."""
    long_text = " ".join(f"word{i % 700}x{i % 13}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 1, 1, "x"),
        (2, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 1, 1, "x"),
        (2, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "a", 1, 1, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 2, "y"),
        (5, " \n\t ", None, "b", 0, 2, "y"),
        (6, long_text, "de", "c", 9, 3, "z"),
        (7, "12345 !!! ###", "fr", "c", 9, 3, "z"),
        (None, "no id here but some words of text that are long enough to count as words for all the rules there are", "en", "c", 9, 3, "z"),
        (8, "é你好 🙂 <|endoftext|> naïve  spaced\r\nlines\x0b\x0cend ", "fr", "c", 9, 3, "z"),
        (9, "one", "fr", "c", 9, 3, "z"),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
