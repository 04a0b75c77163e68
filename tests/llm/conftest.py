import duckdb
import pytest

DIR = "/root/testdata/sf0.001"
#: Awkward rows: nulls, empties, white space, repeats, ties, other scripts.
ODD = [(1, "one two three four five six seven eight", "en", "a"), (2, None, "en", "a"), (3, "", None, "b"),
       (4, " \t\n\x0b\x0c\r ", "en", None), (5, "ONE two three four five six seven eight", "en", "a"),
       (6, "日本語 の テキスト。\n" * 30, "ja", "é"), (7, "x" * 50_000, "en", "a"), (8, "12 34 !!", None, None),
       (None, "no id " * 20, "en", "a"), (9, "same row twice", "en", "b"), (9, "same row twice", "en", "b"),
       (10, "ab " * 20_000, "en", "a"), (11, "ab " * 20_000, "fr", "a"), (12, "short", "en", "b")]


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the small documents table, in order."""
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{DIR}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents with extra columns whose names clash with the operators' own."""
    rows = [(*r, 0, "x", 1.5) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int, z string, key double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
