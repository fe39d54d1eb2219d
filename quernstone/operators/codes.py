"""Vector search by short codes: two levels of centres, product-quantised residuals, exact re-ranking.

A vector belongs to the nearest top centre and, under it, to the nearest of its own centres (cell).
What is left of it is cut into pieces of equal length, each replaced by the nearest of 256 code
words (Jégou et al., 2011). A search visits the cells nearest to a query, scores their codes by
sums from a table of the query's products with all centres and code words, and scores the full
vectors of the best ``survivors`` only. The result is approximate; ``knn_exact`` over ``vectors`` is
the exact way. Report recall with the share of full vectors scored (``recall_report``).

Centres and code words are fitted on samples of bounded size; every vector is coded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import search, topk
from quernstone.sources.scratch import materialize, scratch_path

CODE_SAMPLE = 8192  # vectors that place the code words
WORDS = 256


@dataclass
class CodedIndex:
    """vectors: id, embedding, cell, code (written by cell); centres (cells by dimensions) with the
    number of their top centre; words: pieces by 256 by length of a piece."""

    vectors: DataFrame
    sizes: dict[int, int]
    top: np.ndarray
    centres: np.ndarray
    parent: np.ndarray
    words: np.ndarray


def _assigned(points: np.ndarray, top: np.ndarray, centres: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The cell of each point: the nearest centre under its nearest top centre."""
    above, cell = search._distances(points, top).argmin(axis=1), np.empty(len(points), np.int64)
    for t in np.unique(above):
        at, under = np.flatnonzero(above == t), np.flatnonzero(parent == t)
        cell[at] = under[search._distances(points[at], centres[under]).argmin(axis=1)]
    return cell


def _coded(rest: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per point and piece the number of the nearest code word."""
    pieces, _, length = words.shape
    cut = rest.reshape(len(rest), pieces, length)
    return np.stack([search._distances(cut[:, m], words[m]).argmin(axis=1) for m in range(pieces)], axis=1).astype(np.uint8)


def _unit_rows(embeddings: pd.Series) -> np.ndarray:
    return search._unit(np.stack(embeddings).astype(np.float64))


def _second_level(known: DataFrame, top: np.ndarray, under: int, rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres under each top centre, fitted on at most about ``TRAIN_PER_CELL`` sampled vectors for each."""
    placed = known.select("id", "embedding", search.nearest_udf(top)("embedding")["cell"].alias("cell"))
    share = min(1.0, search.TRAIN_PER_CELL * under * len(top) / max(1, rows))
    # A part of the rows by a hash of the id, so a repeated task takes the same; crowded cells give less of theirs.
    draw = (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(1 << 20)).alias("draw")
    placed = placed.select("cell", "embedding", draw).where(F.col("draw") < min(1.0, 4 * share))
    placed = materialize(placed, "second-level")
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a top centre
    most = 2 * search.TRAIN_PER_CELL * under
    limits = F.create_map(*(F.lit(v) for c, n in counts.items() for v in (c, min(1.0, 4 * share) * min(1.0, most / n)))) if counts else None
    some = placed.where(F.col("draw") < F.element_at(limits, F.col("cell"))) if counts else placed

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        made = search.small_kmeans(_unit_rows(frame["embedding"]), under, seed)
        return pd.DataFrame({"cell": int(frame["cell"].iloc[0]), "centre": [c.tolist() for c in made]})

    made = some.select("cell", "embedding").groupBy("cell").applyInPandas(fit, "cell int, centre array<double>").collect()
    made = sorted(((r.cell, r.centre) for r in made), key=lambda r: (r[0], r[1]))  # bounded by MAX_CENTRE_BYTES
    missing = [(t, top[t].tolist()) for t in range(len(top)) if t not in counts]
    made = sorted([*made, *missing], key=lambda r: r[0])
    return np.array([c for _, c in made]), np.array([t for t, _ in made])


def _code_words(rest: DataFrame, pieces: int, seed: int) -> np.ndarray:
    """Code words of each piece of ``rest(rest)``, one task a piece."""
    each = rest.select(F.posexplode("rest").alias("piece", "part"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(frame["part"]).astype(np.float64)
        made = search.small_kmeans(points, WORDS, seed)
        made = np.concatenate([made, np.repeat(made[:1], WORDS - len(made), axis=0)])
        return pd.DataFrame({"piece": int(frame["piece"].iloc[0]), "words": [made.ravel().tolist()]})

    found = each.groupBy("piece").applyInPandas(fit, "piece int, words array<double>").collect()  # one row a piece
    return np.array([r["words"] for r in sorted(found, key=lambda r: r["piece"])]).reshape(pieces, WORDS, -1)


def build_codes(
    vectors: DataFrame,
    cells: int | None = None,
    pieces: int | None = None,
    seed: int = 7,
    path: str | None = None,
) -> CodedIndex:
    """Code ``vectors(id, embedding)``; vectors are of one length, which ``pieces`` divides."""
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "codes")
    known = vectors.where("embedding is not null")
    rows, width = known.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    if pieces is None:
        pieces = next(p for p in range(min(width, max(1, width // 4)), 0, -1) if width % p == 0)
    if cells is None:
        cells = max(1, min(round(rows**0.5), search.MAX_CENTRE_BYTES // (8 * width)))
    n_top = max(1, round(cells**0.5))
    top = search.fitted_centres(known, n_top, seed)
    centres, parent = _second_level(known, top, max(1, -(-cells // len(top))), rows, seed)
    if centres.nbytes > search.MAX_CENTRE_BYTES:
        raise ValueError("too many cells: the centres are kept by every task")

    @F.pandas_udf("array<array<double>>")
    def rest_of(embeddings: pd.Series) -> pd.Series:
        points = _unit_rows(embeddings) if len(embeddings) else np.empty((0, width))
        rest = points - centres[_assigned(points, top, centres, parent)]
        return pd.Series(rest.reshape(len(points), pieces, -1).tolist())

    some = known.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, rows // CODE_SAMPLE))) == 0)
    words = _code_words(some.select(rest_of("embedding").alias("rest")), pieces, seed)

    @F.pandas_udf("cell int, code binary")
    def code_of(embeddings: pd.Series) -> pd.DataFrame:
        points = _unit_rows(embeddings) if len(embeddings) else np.empty((0, width))
        cell = _assigned(points, top, centres, parent)
        codes = _coded(points - centres[cell], words) if len(points) else []
        return pd.DataFrame({"cell": cell, "code": [c.tobytes() for c in codes]})

    coded = known.withColumn("_at", code_of("embedding")).select(*vectors.columns, "_at.code", "_at.cell")
    coded.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    levels = [(int(t), [float(x) for x in c]) for t, c in zip(parent, centres, strict=True)]
    numbered = [(n, t, c) for n, (t, c) in enumerate(levels)]
    spark.createDataFrame(numbered, "cell int, parent int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")
    tops = [(n, c.tolist()) for n, c in enumerate(top)]
    spark.createDataFrame(tops, "parent int, centre array<double>").write.mode("overwrite").parquet(f"{path}/top")
    lists = [(m, w.ravel().tolist()) for m, w in enumerate(words)]
    # Written last: an index without code words counts as absent.
    spark.createDataFrame(lists, "piece int, words array<double>").write.mode("overwrite").parquet(f"{path}/words")
    return open_codes(spark, path)


def open_codes(spark: SparkSession, path: str) -> CodedIndex:
    """The index that ``build_codes`` wrote to ``path``, in this or another session."""
    words = sorted(spark.read.parquet(f"{path}/words").collect(), key=lambda r: r["piece"])
    low = sorted(spark.read.parquet(f"{path}/centres").collect(), key=lambda r: r["cell"])  # bounded by MAX_CENTRE_BYTES
    top = sorted(spark.read.parquet(f"{path}/top").collect(), key=lambda r: r["parent"])
    vectors = spark.read.parquet(f"{path}/vectors")
    sizes = {r["cell"]: r["n"] for r in vectors.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a cell
    return CodedIndex(
        vectors,
        sizes,
        np.array([r["centre"] for r in top]),
        np.array([r["centre"] for r in low]),
        np.array([r["parent"] for r in low]),
        np.array([r["words"] for r in words]).reshape(len(words), WORDS, -1),
    )


def code_kernel(centres: np.ndarray, words: np.ndarray) -> topk.Kernel:
    pieces, _, length = words.shape

    def kernel(queries: pa.Table):
        asked = search._matrix(queries.column("embedding"))

        def prepared(items: pa.Table) -> topk.Scores:
            code = np.frombuffer(b"".join(items.column("code").to_pylist()), np.uint8).reshape(-1, pieces)
            cell, at = np.unique(items.column("place").to_numpy(), return_inverse=True)

            def scores(lo: int, hi: int) -> np.ndarray:
                part = asked[lo:hi]
                out = (part @ centres[cell].T)[:, at]
                cut = part.reshape(len(part), pieces, length)
                for m in range(pieces):
                    out += (cut[:, m] @ words[m].T)[:, code[:, m]]
                return out

            return scores

        return prepared

    return kernel


def nearest_cells(index: CodedIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """``qid, embedding, cells``: the nearest cells under the nearest top centres."""
    held = np.zeros(len(index.centres), np.int64)
    for c, n in index.sizes.items():
        held[c] = n
    top, centres, parent = index.top, index.centres, index.parent

    @F.pandas_udf("array<int>")
    def nearest(embeddings: pd.Series) -> pd.Series:
        out = []
        for embedding in embeddings:
            point = search._unit(np.asarray(embedding, dtype=np.float64)[None])
            found = np.empty(0, np.int64)
            for t in np.argsort(search._distances(point, top)[0], kind="stable"):
                found = np.concatenate([found, np.flatnonzero((parent == t) & (held > 0))])
                if len(found) >= 2 * nprobe:
                    break
            away = search._distances(point, centres[found])[0]
            out.append(found[np.argsort(away, kind="stable")[:nprobe]].tolist())
        return pd.Series(out)

    known = queries.where("embedding is not null")
    return known.select("qid", "embedding", nearest("embedding").alias("cells"))


def knn_codes(index: CodedIndex, queries: DataFrame, k: int = 2, nprobe: int = 8, survivors: int = 50) -> DataFrame:
    """``qid, rank, id, score, pairs``: the ``k`` best by exact score among the ``survivors`` best by code.

    ``pairs`` is the number of full vectors scored for the query. A search that visits all cells is one pass over
    all codes: no query is repeated for its cells.
    """
    kernel, code_bytes = code_kernel(index.centres, index.words), F.octet_length("code").cast("long") + 16
    if nprobe >= len(index.sizes):
        near, stored = queries.where("embedding is not null").select("qid", "embedding"), index.vectors
        rows, size = near.agg(F.count("*"), F.coalesce(F.sum(F.size("embedding").cast("long") * 4), F.lit(0))).first()
        found = topk.block_topk(
            near.withColumnRenamed("qid", "qkey"),
            stored.select(F.col("id").alias("item"), "code", F.col("cell").alias("place")),
            kernel,
            survivors,
            query_size=(rows, size),
            item_bytes=code_bytes,
        )
    else:
        near = materialize(nearest_cells(index, queries, nprobe), "code-probes")
        visit = near.select(F.col("qid").alias("qkey"), "embedding", F.explode("cells").alias("cell"))
        wanted = [r["cell"] for r in visit.select("cell").distinct().collect()]  # one value a cell
        stored = index.vectors.where(F.col("cell").isin(wanted))
        found = topk.block_topk(
            visit,
            stored.select(F.col("id").alias("item"), "code", F.col("cell").alias("place"), "cell"),
            kernel,
            survivors,
            query_size=(0, 0),
            cell="cell",
            item_bytes=code_bytes,
        )
    left = materialize(found.select(F.col("qkey").alias("qid"), F.col("item").alias("id")), "survivors")
    asked = near.select("qid", F.col("embedding").alias("q"))
    full = left.join(stored.select("id", F.col("embedding").alias("v")), "id").join(asked, "qid")

    @F.pandas_udf("double")
    def cosine(q: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series(np.round((_unit_rows(q) * _unit_rows(v)).sum(axis=1), topk.PLACES) if len(q) else [], dtype="float64")

    scored = full.select(F.col("qid").alias("qkey"), F.col("id").alias("item"), cosine("q", "v").alias("score"))
    best = topk.best_per_query(materialize(scored, "re-ranked"), k)
    counts = left.groupBy("qid").agg(F.count("*").alias("pairs"))
    return best.select(F.col("qkey").alias("qid"), "rank", F.col("item").alias("id"), "score").join(counts, "qid")
