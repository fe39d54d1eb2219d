"""What the operators of this folder share: words, folds, shared tables, Arrow helpers."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.filters import LEAST_BITS, SKETCH_BITS, _filters, filter_bits, may_be_in, membership, release_filters
from quernstone.sources.scratch import materialize
from quernstone.sources.tables import read_table

__all__ = [
    "LEAST_BITS", "SKETCH_BITS", "WORD", "_filters", "documents", "filter_bits", "fold", "lower_ascii", "materialize",
    "may_be_in", "membership", "read_table", "release_filters", "text_udf", "words_of",
]

# A word is a run of characters other than blank, tab, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

# Rows and bytes of one Arrow batch: whole texts can be long, so few of them travel together.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches where the cluster has not done so."""
    launched = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in BATCH.items():
        if key not in launched:
            spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    release_filters()  # what earlier queries have broadcast
    return read_table(small_batches(spark), sf_dir, "documents")


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, mod n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(n)


def words_of(text: str) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() cuts at exactly the six characters WORD leaves out."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_ascii(data: bytes) -> bytes:
    return data.translate(_LOWER)


def text_udf(of_text: Callable[[str | None], tuple], fields: list[tuple[str, pa.DataType]], schema: str):
    """An Arrow UDF giving a struct per text from a function of one whole text."""
    names, kinds = [n for n, _ in fields], [t for _, t in fields]

    def run(texts: pa.Array) -> pa.Array:
        columns = list(zip(*(of_text(t.as_py()) for t in texts), strict=True)) or [[] for _ in names]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    # Plain annotations: the names of a module that defers them cannot be resolved from here.
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, schema)


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


_LETTER = re.compile("[A-Za-z]")


SALTS = 64


def join_by_counts(left: DataFrame, right: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """Inner join of ``left`` with a table of one row per key that knows the key's rows ``n`` in ``left``.

    Keys with over a thousandth of the ``total`` rows are fewer than 1000 (none is hot in a small
    table). Their rows are dealt to ``SALTS`` tasks each, and their row of ``right`` is repeated as
    often; all other keys have one salt. Of a key of several columns the first tells hot ones.
    """
    keys = [key] if isinstance(key, str) else key
    hot = [r[0] for r in right.filter(F.col(n) > max(1000, total // 1000)).select(keys[0]).distinct().collect()]
    salts = F.when(F.col(keys[0]).isin(hot), SALTS).otherwise(1)
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def salted_join(pairs: DataFrame, table: DataFrame, key: str, other: str) -> DataFrame:
    """Inner join of ``pairs`` with wide rows of ``table`` (one per key), hot keys dealt to many tasks.

    A key with over a thousandth of the pairs (fewer than 1000 keys) is salted by the other side of
    the pair; its wide row is repeated once per salt, at most once per thousandth of the pairs.
    """
    total = pairs.count()
    step = max(64, total // 1000)
    hot = pairs.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > step)
    hot = materialize(hot.select(key, F.ceil(F.col("__n") / step).cast("int").alias("__salts")), "hot-keys")
    left = pairs.join(F.broadcast(hot), key, "left")
    left = left.withColumn("__salt", F.pmod(F.xxhash64(other), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts")
    right = table.join(F.broadcast(hot), key, "left")
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return left.join(right, [key, "__salt"]).drop("__salt")
