import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, repeated rows, ties and columns named like results."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    plain = "This is a plain line of prose that ends with a full stop.\nIt has another line of ten words or so.\n" * 3
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, long_text), (None, plain), (None, None), (5, plain), (5, plain)]
    rows += [(6, plain), (7, "one two"), (8, "\x00 odd\x1fchars éß ok. 你好"), (9, "12 34 56")]
    docs = make_docs(rows)
    for clash in ("n_words", "kept", "score", "key", "clean_text", "chunk", "piece", "cls", "n"):
        docs = docs.withColumn(clash, F.lit("x"))
    return docs


SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Writes tables to a folder that a registered query can read."""

    def write(**tables):
        path = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return str(path)

    return write
