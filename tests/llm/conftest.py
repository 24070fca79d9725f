import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

WORDS = [f"w{i}x{i * 7 % 13}" for i in range(4000)]


def words(start, count):
    return " ".join(WORDS[start : start + count])


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def given():
    """The given documents as (doc_id, text)."""
    return duckdb.connect().sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, an empty text, a very long one, repeated rows, and ties of ids and texts."""
    long = words(0, 3000) + " " + "q" * 20_000
    return [
        (None, None), (None, "no id"), (None, "no id"), (1, None), (2, ""), (3, "  \n "), (4, long), (5, "same text"),
        (5, "same text"), (6, "same text"), (5, "other text"), (7, words(10, 80)), (8, words(10, 80)), (9, "<|endoftext|>"),
    ]


@pytest.fixture(scope="session")
def odd(docs_of, odd_rows):
    """The odd rows with further columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    names = ("node", "size", "bucket", "part", "score", "shard", "bytes", "start", "rank", "_spans", "toxicity")
    return docs_of(odd_rows).withColumns({name: F.lit("clash") for name in names})


@pytest.fixture(scope="session")
def no_rows(docs_of):
    return docs_of([])
