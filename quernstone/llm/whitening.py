"""Embedding whitening on distinct vectors, weighted by how often each occurs.

Each entry c of a vector becomes the whole number x = floor(1024 * c) + 100000. Rows with equal x
vectors are one row of the distinct table (grouped by the md5 of their bytes), with their number as
weight; with ``weights="one"`` each distinct vector counts once in the fit.

1. Sums per dimension are exact whole numbers, combined in tasks and added as decimals.
2. Each task multiplies its centred, weighted vectors into one partial covariance; partials are added
   row by row in two steps. The driver sees one matrix of dimension x dimension.
3. Components are its unit eigenvectors by falling eigenvalue. Each distinct vector is whitened once,
   and rows get the result by a join whose hot vectors are salted by their counts.
4. The whitened vectors' own covariance is measured and compared with the identity.

Left out: rows whose vector is null or empty, holds an entry that is null, not finite or of 2^42 or
more in size (its x would not be exact), or has another length than most vectors (the longer one of
two lengths equally common). Components whose eigenvalue is zero to double precision are left out too,
so one vector, or one repeated, gives no rows; neither does an empty table. Null and repeated
ids are rows like others. Equal eigenvalues come in the order of the solver. Columns other than id and
vector are ignored.

``deviation``, the sum over dimensions of (n * x - sum)^2, is an exact decimal of 38 digits, null
beyond them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import join_by_counts, materialize

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 42)
FAN_IN = 64
DIGITS = 10**38


def _x(embedding: pa.Array, dimension: int) -> np.ndarray:
    flat = embedding.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, dimension) + SHIFT


def _packed(dimension: int):
    """An Arrow UDF: the x vector as bytes, four for each entry where they suffice, else eight."""

    def run(embedding: pa.Array) -> pa.Array:
        x = _x(embedding, dimension)
        small = (np.abs(x) < 1 << 31).all(axis=1) if len(x) else []
        return pa.array([(r.astype("<i4") if s else r.astype("<i8")).tobytes() for r, s in zip(x, small, strict=True)], pa.binary())

    run.__annotations__ = {"embedding": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "binary")


def _unpacked(x: pa.Array, dimension: int) -> np.ndarray:
    rows = x.to_pylist()
    if rows and all(len(r) == 4 * dimension for r in rows):
        return np.frombuffer(b"".join(rows), "<i4").reshape(-1, dimension).astype(np.int64)
    each = [np.frombuffer(r, "<i4" if len(r) == 4 * dimension else "<i8") for r in rows]
    return np.array(each, np.int64).reshape(-1, dimension)


@dataclass
class Fit:
    """What whitening needs of the fit list: its size, exact sums, eigenvalues, components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean: the whole part is subtracted exactly, the rest as a fraction."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exact."""
        low, high = ((x.min(axis=0), x.max(axis=0)) if len(x) else (0, 0))
        most = max((abs(self.n * int(v) - s) for b in (low, high) for v, s in zip(np.atleast_1d(b), self.sums, strict=False)), default=0)
        if most * most * len(self.sums) >= 1 << 63 or self.n * int(np.abs(x).max(initial=0)) >= 1 << 63:
            return [sum((self.n * v - s) ** 2 for v, s in zip(r, self.sums, strict=True)) for r in x.tolist()]
        apart = self.n * x - np.array(self.sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that remain, and their dimension (0: none remain)."""
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[embedding].cast("array<double>").alias("embedding"))
    # A null entry makes forall null, a NaN is larger than every number.
    rows = rows.filter((F.size("embedding") > 0) & F.forall("embedding", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))))
    size = F.size("embedding")
    common = rows.groupBy(size.alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dimension = common.d if common else 0
    return rows.filter(size == dimension), dimension


def _sums(distinct: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = _unpacked(batch.column(0), dimension), batch.column(1).to_numpy()
            if len(x) and int(np.abs(x).max()) * int(n.sum()) >= 1 << 62:
                x, n = x.astype(object), n.astype(object)
            sums = [str(s) for s in (x * n[:, None]).sum(axis=0).tolist()] if len(x) else []
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.string())], ["d", "s"])

    parts = distinct.select("x", "weight").mapInArrow(part, "d int, s string")
    rows = parts.groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one row a dimension
    n = distinct.agg(F.sum("weight")).first()[0] or 0
    return n, [int(r.s) for r in sorted(rows, key=lambda r: r.d)]


def _covariance(distinct: DataFrame, fit: Fit) -> np.ndarray:
    dimension = len(fit.sums)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((dimension, dimension)), False
        for batch in batches:
            c = fit.centred(_unpacked(batch.column(0), dimension))
            total += (c * batch.column(1).to_numpy()[:, None]).T @ c
            some = some or len(c) > 0
        if some:
            rows = pa.array([r.tobytes() for r in total], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), rows], ["d", "row"])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(r, np.float64) for r in rows["row"]], axis=0)
        return pd.DataFrame({"d": rows["d"].iloc[:1], "row": [total.tobytes()]})

    parts = distinct.select("x", "weight").mapInArrow(part, "d int, row binary")
    parts = materialize(parts.withColumn("part", F.spark_partition_id() % FAN_IN), "partial-covariances")
    parts = parts.groupBy("d", "part").applyInPandas(added, "d int, row binary")
    rows = parts.groupBy("d").applyInPandas(added, "d int, row binary").collect()  # one row a dimension
    return np.array([np.frombuffer(r.row, np.float64) for r in sorted(rows, key=lambda r: r.d)]) / fit.n


def fit_whitening(distinct: DataFrame, dimension: int, components: int) -> Fit | None:
    """From a written table (x, weight); None without rows."""
    n, sums = _sums(distinct, dimension)
    if not n:
        return None
    fit = Fit(n, sums, np.empty(0), np.empty((dimension, 0)), 0.0)
    covariance = _covariance(distinct, fit)
    values, columns = np.linalg.eigh((covariance + covariance.T) / 2)
    values, columns = values[::-1], columns[:, ::-1]
    fit.trace = float(np.trace(covariance))
    fit.values, fit.components = values[:components], columns[:, :components]
    real = fit.values > values[0] * dimension * 1e-13
    fit.values, fit.components = fit.values[real], np.ascontiguousarray(fit.components[:, real])
    return fit


def identity_error(whitened: DataFrame, fit: Fit) -> float:
    """The largest entry of the whitened vectors' covariance less the identity; ``whitened`` has (z, weight)."""
    k, weight = len(fit.values), F.col("weight")
    mean = whitened.agg(*(F.sum(weight * F.col("z")[c]) for c in range(k))).first()
    z = [F.col("z")[c] - F.lit(m / fit.n) for c, m in enumerate(mean)]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    sums = whitened.agg(*(F.sum(weight * z[a] * z[b]) for a, b in pairs)).first()
    return max(abs(s / fit.n - (a == b)) for (a, b), s in zip(pairs, sums, strict=True))


_ROWS = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 8, weights: str = "counts") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per remaining row and component."""
    spark = vectors.sparkSession
    rows, dimension = usable(vectors, vec_id, embedding)
    kind = vectors.select(vectors[vec_id].alias("vec_id")).schema["vec_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, {_ROWS}")
    if not dimension:
        return empty
    rows = rows.select("vec_id", _packed(dimension)("embedding").alias("x")).withColumn("key", F.unhex(F.md5("x")))
    distinct = rows.groupBy("key").agg(F.first("x").alias("x"), F.count("*").alias("n"))
    distinct = distinct.withColumn("weight", F.col("n") if weights == "counts" else F.lit(1).cast("long"))
    distinct = materialize(distinct, "distinct-vectors")
    fit = fit_whitening(distinct, dimension, components)
    if fit is None or not len(fit.values):
        return empty

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column(1), dimension)
            z = pa.array(list(fit.whiten(x)), pa.list_(pa.float64()))
            apart = pa.array([Decimal(d) if d < DIGITS else None for d in fit.deviations(x)], pa.decimal128(38, 0))
            columns = [batch.column(0), batch.column(2), batch.column(3), z, apart]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_rows", "weight", "z", "deviation"])

    schema = "key binary, n_rows long, weight long, z array<double>, deviation decimal(38,0)"
    done = materialize(distinct.select("key", "x", "n", "weight").mapInArrow(whitened, schema), "whitened")
    error = identity_error(done, fit)
    of_key = done.select("key", "n_rows", "z", "deviation")
    total = done.agg(F.sum("n_rows")).first()[0]
    joined = join_by_counts(rows.select("vec_id", "key"), of_key, "key", "n_rows", total)
    explained = F.array(*(F.lit(float(v) / fit.trace) for v in fit.values))
    out = joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
