"""Vector index and similarity search by cosine.

The index assigns each vector to the nearest of a fixed number of k-means centres (inverted file,
Jégou et al., 2011) and stores it by that cell. A search probes the nearest cells first. In exact
mode it then also visits each cell that, by the triangle inequality, may hold a better vector than
the k-th found so far, so nothing is missed; otherwise the result is approximate and its recall
should be reported together with the share of pairs scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import topk
from quernstone.operators.joins import salted_join
from quernstone.sources.scratch import materialize, scratch_path

MAX_CENTRE_BYTES = 64 << 20
# Half a unit of the last place scores are rounded to, and what double arithmetic may lose.
HALF_PLACE = 0.5 * 10.0**-topk.PLACES
EPSILON = 1e-9
MARGIN = 1e-6
TRAIN_PER_CELL = 256
# Queries looked at, and the share of vectors above which visiting cells cannot pay off.
LOOKED_AT = 64
# The share of entries that are not zero, up to which many queries are scored by these alone.
SPARSE = 1 / 8
MANY_QUERIES = 1024
TOO_MUCH = 0.5


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    vectors = column.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(vectors):
        return np.zeros((0, 0))
    if np.unique(pc.list_value_length(vectors).to_numpy(zero_copy_only=False)).size > 1:
        raise ValueError("vectors of unequal length")
    return _unit(flat.reshape(len(vectors), -1))


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def cosine_kernel(queries: pa.Table):
    """Scores of all items; many queries that are mostly zeros only meet the entries of their own dimensions."""
    asked = _matrix(queries.column("embedding"))
    owner, dimension = np.nonzero(asked)
    weight, begin = asked[owner, dimension], np.searchsorted(owner, np.arange(len(asked) + 1))
    # Zero times a value that is not finite is none, which only whole vectors tell; so for items below.
    sparse = len(asked) >= MANY_QUERIES and len(owner) <= SPARSE * asked.size and np.isfinite(weight).all()

    def prepared(items: pa.Table) -> topk.Scores:
        vectors = _matrix(items.column("embedding"))
        if asked.size and vectors.size and asked.shape[1] != vectors.shape[1]:
            raise ValueError("vectors of unequal length")
        return (by_entry(vectors) if sparse else None) or (lambda lo, hi: asked[lo:hi] @ vectors.T)

    def by_entry(vectors: np.ndarray) -> topk.Scores | None:
        n, width = vectors.shape
        at = np.flatnonzero(vectors)
        value = vectors.ravel()[at]
        if at.size > SPARSE * vectors.size or not np.isfinite(value).all():
            return None
        item, of = np.divmod(at, width)
        order = np.argsort(of, kind="stable")
        item, value, cuts = item[order], value[order], np.searchsorted(of[order], np.arange(1, width))
        item, value = np.split(item, cuts), np.split(value, cuts)

        def scores(lo: int, hi: int) -> Iterator[np.ndarray]:
            for q in range(lo, hi):
                own = slice(begin[q], begin[q + 1])
                held = dimension[own].tolist()
                worth = np.concatenate([np.empty(0), *(w * value[d] for w, d in zip(weight[own], held, strict=True))])
                yield np.bincount(np.concatenate([np.empty(0, int), *(item[d] for d in held)]), worth, n)

        return scores

    return prepared


def _shaped(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where("embedding is not null").select(F.col(key).alias(name), "embedding")


def knn_exact(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 2,
    block_rows: int = topk.BLOCK_ROWS,
    broadcast_bytes: int = topk.BROADCAST_BYTES,
) -> DataFrame:
    """``qid, rank, id, score``: the ``k`` most similar of ``vectors(id, embedding)`` for each of
    ``queries(qid, embedding)``."""
    asked = _shaped(queries, "qid", "qkey")
    vector_bytes = F.sum(F.size("embedding").cast("long") * 4)
    rows, size = asked.agg(F.count("*"), F.coalesce(vector_bytes, F.lit(0))).first()
    return topk.block_topk(
        asked,
        _shaped(vectors, "id", "item"),
        cosine_kernel,
        k,
        query_size=(rows, size),
        block_rows=block_rows,
        broadcast_bytes=broadcast_bytes,
        item_bytes=F.size("embedding").cast("long") * 8,
    ).select(F.col("qkey").alias("qid"), "rank", F.col("item").alias("id"), "score")


@dataclass
class VectorIndex:
    """vectors: id, embedding, gap, cell (written by cell); cells: cell, radius, n."""

    vectors: DataFrame
    cells: DataFrame
    centres: np.ndarray


def small_kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centres of a sample that fits a task."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        cell = _distances(points, centres).argmin(axis=1)
        n = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fitted_centres(known: DataFrame, cells: int | None, seed: int) -> np.ndarray:
    """Centres of ``known(embedding)``, placed by a sample of about ``TRAIN_PER_CELL`` rows per cell."""
    rows, width = known.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    if cells is None:
        cells = max(1, min(round(rows**0.5), MAX_CENTRE_BYTES // (8 * width)))
    training = known.select(array_to_vector("embedding").alias("vector"))
    if rows > TRAIN_PER_CELL * cells:
        training = training.sample(TRAIN_PER_CELL * cells / rows, seed=seed)
    unit = Normalizer(inputCol="vector", outputCol="features").transform(training)
    training = materialize(unit.select("features"), "training")
    if cells == 1 or rows <= 2 * cells:  # too few for the distributed fit
        some = training.limit(TRAIN_PER_CELL * cells).collect()
        return small_kmeans(np.array([r.features.toArray() for r in some]), cells, seed)
    centres = np.array(KMeans(k=cells, seed=seed, maxIter=20).fit(training).clusterCenters())
    if centres.nbytes > MAX_CENTRE_BYTES:
        raise ValueError("too many cells: the centres are kept by every task")
    return centres


def nearest_udf(centres: np.ndarray, reach: np.ndarray | None = None):
    """``cell, gap`` of a vector: the nearest centre (of those in ``reach``) and its distance."""

    @F.pandas_udf("cell int, gap double")
    def nearest(embeddings: pd.Series) -> pd.DataFrame:
        if not len(embeddings):
            return pd.DataFrame({"cell": [], "gap": []})
        away = _distances(_unit(np.stack(embeddings).astype(np.float64)), centres)
        if reach is not None:
            away[:, ~reach] = np.inf
        cell = away.argmin(axis=1)
        return pd.DataFrame({"cell": cell, "gap": away[np.arange(len(cell)), cell]})

    return nearest


def build_index(
    vectors: DataFrame,
    cells: int | None = None,
    seed: int = 7,
    path: str | None = None,
) -> VectorIndex:
    """Index ``vectors(id, embedding)``; other columns are kept.

    The number of cells defaults to the root of the number of vectors, as far as their centres fit
    every task. About ``TRAIN_PER_CELL`` rows per cell, sampled, place the centres; every row is
    assigned to a cell.
    """
    path = path or scratch_path(vectors.sparkSession, "vectors")
    known = vectors.where("embedding is not null")
    centres = fitted_centres(known, cells, seed)
    nearest = nearest_udf(centres)
    assigned = known.withColumn("_at", nearest("embedding")).select(
        *vectors.columns, "_at.gap", "_at.cell"
    )
    # Rebalancing gathers small cells into few files and splits large ones.
    placed = f"{path}/centres"
    known.sparkSession.createDataFrame(
        [(n, [float(x) for x in c]) for n, c in enumerate(centres)], "cell int, centre array<double>"
    ).write.mode("overwrite").parquet(placed)
    target = f"{path}/vectors"
    assigned.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(target)
    stored = vectors.sparkSession.read.schema(assigned.schema).parquet(target)
    sizes = materialize(
        stored.groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n")),
        "cells",
        f"{path}/cells",
    )
    return VectorIndex(stored, sizes, centres)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """The index that ``build_index`` wrote to ``path``, in this or another session."""
    placed = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # bounded by MAX_CENTRE_BYTES
    return VectorIndex(
        spark.read.parquet(f"{path}/vectors"),
        spark.read.parquet(f"{path}/cells"),
        np.array([row["centre"] for row in placed]),
    )


def build_if_absent(
    spark: SparkSession, path: str, vectors: Callable[[], DataFrame], **how
) -> VectorIndex:
    """Open the index at ``path``, or build it there from ``vectors()`` if there is none.

    The sizes of the cells are written last, so an index cut off while building counts as absent.
    """
    try:
        return open_index(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return build_index(vectors(), path=path, **how)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = (
        (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
    )
    return np.sqrt(np.maximum(squared, 0))


_VISITS = "array<struct<cell:int,n:long>>"


def _cell_bounds(index: VectorIndex) -> tuple[np.ndarray, np.ndarray]:
    """Radius and number of vectors per cell."""
    radius, size = np.zeros(len(index.centres)), np.zeros(len(index.centres), dtype=np.int64)
    for row in index.cells.collect():  # one row per cell
        radius[row["cell"]], size[row["cell"]] = row["radius"], row["n"]
    return radius, size


def _ordered(embeddings: pd.Series, centres: np.ndarray, size: np.ndarray):
    """Distances of the centres, and the cells with vectors from near to far, query by query."""
    for embedding in embeddings:
        away = _distances(_unit(np.asarray(embedding, dtype=np.float64)[None]), centres)[0]
        order = np.argsort(away, kind="stable")
        yield away, order[size[order] > 0]


def probes(index: VectorIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """``qid, embedding, cells``: per query its ``nprobe`` nearest cells and their sizes."""
    centres, (_, size) = index.centres, _cell_bounds(index)

    @F.pandas_udf(_VISITS)
    def nearest(embeddings: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"cell": int(c), "n": int(size[c])} for c in cells[:nprobe]]
                for _, cells in _ordered(embeddings, centres, size)
            ]
        )

    known = queries.where("embedding is not null")
    return known.select("qid", "embedding", nearest("embedding").alias("cells"))


def _beyond(index: VectorIndex, nprobe: int):
    """The cells after the first ``nprobe`` that may hold a vector within ``reach`` (null: any)."""
    centres, (radius, size) = index.centres, _cell_bounds(index)

    @F.pandas_udf(_VISITS)
    def within(embeddings: pd.Series, reach: pd.Series) -> pd.Series:
        out = []
        for (away, cells), most in zip(_ordered(embeddings, centres, size), reach, strict=True):
            rest = cells[nprobe:]
            if not np.isnan(most):
                rest = rest[away[rest] - radius[rest] <= most]
            out.append([{"cell": int(c), "n": int(size[c])} for c in rest])
        return pd.Series(out)

    return within


def visited_share(index: VectorIndex, queries: DataFrame, k: int) -> float:
    """The share of vectors that an exact search by cells visits, estimated on some queries.

    The k-th score of each is found by one pass over the vectors, which few queries share; a cell has
    to be visited if its ball reaches as near.
    """
    radius, size = _cell_bounds(index)
    some = queries.where("embedding is not null").limit(LOOKED_AT)
    some = materialize(some.select(F.monotonically_increasing_id().alias("qid"), "embedding"), "looked-at")
    kth = knn_exact(some, index.vectors, k).groupBy("qid").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    rows = some.join(kth, "qid").collect()  # LOOKED_AT at most
    if not rows or not size.sum():
        return 0.0
    away = _distances(_unit(np.array([r["embedding"] for r in rows], dtype=np.float64)), index.centres)
    least = np.array([r["least"] if r["n"] == k else -1.0 for r in rows]) - HALF_PLACE
    reach = np.sqrt(np.maximum(0, 2 - 2 * least)) + MARGIN
    return float(((away - radius <= reach[:, None]) @ size).mean() / size.sum())


def knn_cells(
    index: VectorIndex, queries: DataFrame, k: int = 2, nprobe: int = 4, exact: bool = True
) -> DataFrame:
    """``qid, rank, id, score, pairs``: search by cells. ``pairs`` is the number of vectors that
    were scored for the query.

    An exact search that, by some of its queries, would visit most vectors anyway is one pass over
    all of them instead; the result is the same. A search of hardly more queries than that goes by cells.
    """
    if exact and queries.limit(4 * LOOKED_AT + 1).count() > 4 * LOOKED_AT and visited_share(index, queries, k) > TOO_MUCH:
        total = index.cells.agg(F.sum("n")).first()[0]
        return knn_exact(queries, index.vectors, k).withColumn("pairs", F.lit(total).cast("long"))
    near = materialize(probes(index, queries, nprobe), "probes")

    def within(visits: DataFrame) -> DataFrame:
        """Search the listed cells only; a query is repeated once per cell it visits."""
        visit = visits.select(
            F.col("qid").alias("qkey"), "embedding", F.explode("cells").alias("at")
        ).select("qkey", "embedding", "at.cell")
        # at most one value per cell; folders of other cells are not read
        wanted = [row["cell"] for row in visit.select("cell").distinct().collect()]
        stored = index.vectors.where(F.col("cell").isin(wanted))
        return topk.block_topk(
            visit,
            stored.select(F.col("id").alias("item"), "embedding", "cell"),
            cosine_kernel,
            k,
            query_size=(0, 0),
            cell="cell",
            item_bytes=F.size("embedding").cast("long") * 8,
        )

    found = materialize(within(near), "near")
    visited = near.select("qid", "cells")
    if exact:
        # The k-th score is rounded: every vector that rounds to as much may still belong in front.
        least = F.col("score") - HALF_PLACE - EPSILON
        kth = found.where(F.col("rank") == k).select(
            F.col("qkey").alias("qid"),
            (F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * least)) + MARGIN).alias("reach"),
        )
        beyond = _beyond(index, nprobe)
        far = materialize(
            near.join(kth, "qid", "left").select(
                "qid", "embedding", beyond("embedding", "reach").alias("cells")
            ),
            "far",
        )
        found = topk.best_per_query(
            found.drop("rank").unionByName(within(far).drop("rank")), k
        )
        visited = visited.unionByName(far.select("qid", "cells"))
    sizes = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["n"])
    scored = visited.groupBy("qid").agg(F.sum(sizes).alias("pairs"))
    return found.select(
        F.col("qkey").alias("qid"), "rank", F.col("item").alias("id"), "score"
    ).join(scored, "qid")


def recall_report(found: DataFrame, truth: DataFrame, n_vectors: int) -> DataFrame:
    """Share of the true hits found, and share of all pairs that were scored."""
    hits = truth.select("qid", "id").join(
        found.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left"
    )
    recall = hits.agg(
        F.count("*").alias("true_hits"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall")
    )
    work = found.groupBy("qid").agg(F.max("pairs").alias("pairs"))
    share = work.agg((F.sum("pairs") / (F.count("*") * n_vectors)).alias("share_scored"))
    return recall.select(
        "true_hits",
        F.round("recall", 6).alias("recall"),
        F.round(share.select("share_scored").scalar(), 6).alias("share_scored"),
    )


def probes_for_recall(
    index: VectorIndex, queries: DataFrame, truth: DataFrame, k: int, least: float, nprobe: int = 1
) -> int:
    """The first number of cells from ``nprobe`` on, in steps of a fifth, whose search finds ``least`` of ``truth``."""
    cells = index.cells.count()
    while nprobe < cells:
        found = knn_cells(index, queries, k, nprobe=nprobe, exact=False).select("qid", "id", F.lit(1).alias("hit"))
        hits = truth.join(queries.select("qid"), "qid", "left_semi").join(found, ["qid", "id"], "left")
        recall = hits.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
        if recall is None or recall >= least:
            break
        nprobe = min(cells, nprobe + max(1, nprobe // 5))
    return nprobe


def describe_index(index: VectorIndex) -> DataFrame:
    """One row: size, dimensions, null and repeated keys, and how uneven the cells are."""
    per_key = index.vectors.groupBy("id").agg(
        F.count("*").alias("n"),
        F.min(F.size("embedding")).alias("low"),
        F.max(F.size("embedding")).alias("high"),
    )
    sizes = index.cells.agg(
        F.count("*").alias("cells"),
        F.max("n").alias("largest_cell"),
        F.round(F.max("n") / F.avg("n"), 6).alias("cell_skew"),
    )
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.min("low").alias("min_dimensions"),
        F.max("high").alias("max_dimensions"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.sum(F.when(F.col("id").isNotNull() & (F.col("n") > 1), 1).otherwise(0)).alias(
            "repeated_keys"
        ),
    ).select(
        "*",
        *[sizes.select(c).scalar().alias(c) for c in ("cells", "largest_cell", "cell_skew")],
    )


def similarity_search(
    index: VectorIndex,
    queries: DataFrame,
    columns: Sequence[str] = ("id", "page_content"),
    k: int = 2,
    nprobe: int = 4,
    exact: bool = True,
) -> DataFrame:
    """Search ``queries(qid, embedding)`` and return the chosen ``columns`` of the index rows."""
    hits = materialize(knn_cells(index, queries, k, nprobe, exact).drop("pairs"), "hits")
    rest = [c for c in columns if c not in ("id", "score")]
    if rest:
        hits = salted_join(hits, index.vectors.select("id", *rest), "id")
    return hits.select("qid", "rank", *columns, *([] if "score" in columns else ["score"]))
