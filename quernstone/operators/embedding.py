"""Text embeddings.

The default model hashes tokens into a fixed number of dimensions (Weinberger et al., 2009),
weighs them by inverse document frequency and scales to unit length. It needs no download and
gives the same vector for the same text anywhere: the dimension of a token comes from its md5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions import text as tx
from quernstone.sources.scratch import materialize

DIMENSIONS = 1024
# Texts whose vectors a task fills in at a time.
SLICE = 256


@dataclass
class Embedder:
    """The weight of each dimension."""

    idf: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(n, float(w)) for n, w in enumerate(self.idf)]
        materialize(spark.createDataFrame(rows, "dimension int, idf double"), "embedder", path)


def open_embedder(spark: SparkSession, path: str) -> Embedder:
    return Embedder(np.array([r["idf"] for r in spark.read.parquet(path).orderBy("dimension").collect()]))


def token_dimensions(text_col: str, dimensions: int) -> Column:
    """The dimension of each token of a text, as often as the token occurs; each token of a batch is hashed once."""

    def hashed(tokens: pa.Array) -> pa.Array:
        words = tokens.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        places = np.array([int(md5(w).hexdigest()[:7], 16) % dimensions for w in distinct], np.int32)
        ends = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(places[words.indices.to_numpy()], pa.int32()))

    hashed.__annotations__ = {"tokens": pa.Array, "return": pa.Array}
    none = F.array().cast("array<string>")
    return F.arrow_udf(hashed, "array<int>")(F.coalesce(tx.tokens(text_col), none))


def fit_embedder(
    df: DataFrame, text_col: str = "page_content", dimensions: int = DIMENSIONS
) -> Embedder:
    """Fit the default model: texts are counted per dimension, combined before the shuffle."""
    # For ``explode`` Spark would first ask each list whether it is empty, and so make it twice.
    own = df.select(F.explode_outer(F.array_distinct(token_dimensions(text_col, dimensions))).alias("d")).where("d is not null")
    found = {r["d"]: r["count"] for r in own.groupBy("d").count().collect()}  # one row per dimension
    texts = np.array([found.get(d, 0) for d in range(dimensions)])
    return Embedder(np.log((df.count() + 1) / (texts + 1)))


def embed(df: DataFrame, text_col: str, model: Embedder, sparse: bool = False) -> DataFrame:
    """Add ``embedding array<float>``. A text without tokens gets the zero vector.

    With ``sparse`` it has the entries that are not zero, ``array<struct<dimension int, weight float>>``.
    """
    idf = model.idf

    def vectors(dimensions: pa.Array) -> Iterator[np.ndarray]:
        lengths = dimensions.value_lengths().to_numpy(zero_copy_only=False)
        ends, flat = np.concatenate([[0], np.cumsum(lengths)]), dimensions.flatten().to_numpy(zero_copy_only=False)
        for low in range(0, len(lengths), SLICE):
            some = lengths[low : low + SLICE]
            place = np.repeat(np.arange(len(some)) * len(idf), some) + flat[ends[low] : ends[low + len(some)]]
            out = np.bincount(place, minlength=len(some) * len(idf)).reshape(len(some), -1) * idf
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            np.divide(out, norms, out=out, where=norms > 0)
            yield out.astype(np.float32)

    def weigh(dimensions: pa.Array) -> pa.Array:
        flat = np.concatenate([np.empty(0, np.float32), *(v.ravel() for v in vectors(dimensions))])
        ends = pa.array(np.arange(len(dimensions) + 1) * len(idf), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(flat, pa.float32()))

    def entries(dimensions: pa.Array) -> pa.Array:
        counts, places, weights = [np.zeros(1, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]
        for v in vectors(dimensions):
            row, place = np.nonzero(v)
            counts.append(np.bincount(row, minlength=len(v)))
            places.append(place)
            weights.append(v[row, place])
        flat = [pa.array(np.concatenate(places), pa.int32()), pa.array(np.concatenate(weights), pa.float32())]
        ends = pa.array(np.cumsum(np.concatenate(counts)), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, ["dimension", "weight"]))

    weigh.__annotations__ = entries.__annotations__ = {"dimensions": pa.Array, "return": pa.Array}
    run = F.arrow_udf(entries, "array<struct<dimension int, weight float>>") if sparse else F.arrow_udf(weigh, "array<float>")
    return df.withColumn("embedding", run(token_dimensions(text_col, len(idf))))


def embed_with(
    df: DataFrame, text_col: str, make_predict: Callable, batch_size: int = 256
) -> DataFrame:
    """Add ``embedding`` from a user's model.

    ``make_predict()`` loads the model once per worker and returns a function from an array of
    texts to a matrix.
    """
    run = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return df.withColumn("embedding", run(text_col))
