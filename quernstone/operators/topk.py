"""Best ``k`` items per query for a pairwise score, without forming rows for pairs.

Items and queries are cut into blocks of bounded size by a hash of their keys. Each task scores one
block of items against one block of queries with array arithmetic and keeps ``k`` results per
query, so what is shuffled afterwards is ``k`` rows per query and block, however the keys, terms or
vectors are distributed. Few queries are broadcast after a check of their size, and then the items
are scanned where they lie. More queries travel in blocks, with the items repeated once per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# kernel(queries) -> prepared; prepared(items) -> scores; scores(lo, hi) -> matrix of the scores
# of queries lo..hi-1 with every item, or one row of it after another
Scores = Callable[[int, int], Iterable[np.ndarray]]
Kernel = Callable[[pa.Table], Callable[[pa.Table], Scores]]

BLOCK_ROWS = 16_384
BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 128 << 20
SLICE = 128
PLACES = 6
# Rounding moves a score by half a place at most.
HALF_PLACE = 0.5 * 10.0**-PLACES + 1e-9
GROUP = 64


class Best:
    """Running best ``k`` per query, by score and then by smaller item key."""

    def __init__(self, n: int, k: int, floor: float | None):
        self.k, self.floor = k, floor
        self.items: list = [np.empty(0, np.int64)] * n
        self.scores: list = [np.empty(0)] * n
        self.bar = np.full(n, -np.inf)

    def add(self, q: int, row: np.ndarray, keys: np.ndarray) -> None:
        at = np.flatnonzero(row >= self.bar[q])
        if self.floor is not None:
            at = at[row[at] > self.floor]
        if at.size == 0:
            return
        if at.size > 4 * self.k:
            least = np.partition(row[at], at.size - self.k)[at.size - self.k]
            at = at[row[at] >= least]
        scores = np.concatenate([self.scores[q], row[at]])
        items = np.concatenate([self.items[q], keys[at]])
        order = np.lexsort((items, -scores))[: self.k]
        self.scores[q], self.items[q] = scores[order], items[order]
        if order.size == self.k:
            self.bar[q] = self.scores[q][-1]

    def table(self, names: pa.Array) -> pa.Table:
        counts = [s.size for s in self.scores]
        at = np.repeat(np.arange(len(counts)), counts)
        return pa.table(
            {
                "qkey": names.take(pa.array(at)),
                "item": pa.array(np.concatenate([*self.items, np.empty(0, np.int64)])),
                "score": pa.array(np.concatenate([*self.scores, np.empty(0)])),
            }
        )


class BestOfMany:
    """``Best`` for items that come for many queries at a time."""

    def __init__(self, n: int, k: int, floor: float):
        self.n, self.k, self.floor = n, k, floor
        self.queries, self.scores, self.items = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.bar = np.full(n, -np.inf)

    def add(self, queries: np.ndarray, scores: np.ndarray, items: np.ndarray) -> None:
        able = (scores >= self.bar[queries]) & (scores > self.floor)
        queries, scores, items = queries[able], scores[able], items[able]
        met = np.zeros(self.n, bool)
        met[queries] = True
        again = met[self.queries]
        q, s, i = (np.concatenate([a[again], b]) for a, b in zip((self.queries, self.scores, self.items), (queries, scores, items), strict=True))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        self.bar[q[place == self.k - 1]] = s[place == self.k - 1]
        kept = place < self.k
        self.queries = np.concatenate([self.queries[~again], q[kept]])
        self.scores = np.concatenate([self.scores[~again], s[kept]])
        self.items = np.concatenate([self.items[~again], i[kept]])

    def table(self, names: pa.Array) -> pa.Table:
        return pa.table({"qkey": names.take(pa.array(self.queries)), "item": pa.array(self.items), "score": pa.array(self.scores)})


def _scan(best: Best, prepared, items: pa.Table, n_queries: int) -> None:
    if items.num_rows == 0:
        return
    keys = items.column("item").to_numpy()
    scores = prepared(items)
    for lo in range(0, n_queries, SLICE):
        hi = min(lo + SLICE, n_queries)
        for q, row in enumerate(scores(lo, hi), lo):
            near = np.flatnonzero(row >= max(best.bar[q], _reached(row, best.k)) - HALF_PLACE)
            if near.size:
                best.add(q, np.round(row[near], PLACES), keys[near])


def _reached(row: np.ndarray, k: int) -> float:
    """A score, less what rounding may move it, that ``k`` values of ``row`` reach: the k-th largest of the largest of each group."""
    groups = len(row) // GROUP
    if groups < k:
        return -np.inf
    most = np.fmax.reduce(row[: groups * GROUP].reshape(GROUP, groups))
    kth = np.partition(np.where(np.isnan(most), -np.inf, most), groups - k)[groups - k]
    return kth - HALF_PLACE


def _names(queries: pa.Table) -> pa.Array:
    return queries.column("qkey").combine_chunks()


def _broadcast_topk(
    queries: DataFrame, items: DataFrame, kernel: Kernel, k: int, floor: float | None
) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(queries.toArrow())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        if not asked.num_rows:
            return
        prepared = kernel(asked)
        best = Best(asked.num_rows, k, floor)
        for batch in batches:
            _scan(best, prepared, pa.Table.from_batches([batch]), asked.num_rows)
        yield from best.table(_names(asked)).to_batches()

    return items.mapInArrow(scan, _result_type(queries))


def _result_type(queries: DataFrame) -> str:
    return f"qkey {queries.schema['qkey'].dataType.simpleString()}, item long, score double"


def _blocks(df: DataFrame, cell: Column, rows: int, size: Column | None = None) -> DataFrame:
    """``cell, blocks``: into how many blocks each cell's rows are cut, by their number and, where
    a row's ``size`` is given, by their bytes. One row per cell."""
    size = F.lit(0) if size is None else size
    sums = df.groupBy(cell.alias("cell")).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")
    )
    blocks = F.greatest(F.col("rows") / rows, F.col("bytes") / BLOCK_BYTES)
    return sums.select("cell", F.ceil(blocks).cast("int").alias("blocks"))


def _paired_topk(
    queries: DataFrame,
    items: DataFrame,
    kernel: Kernel,
    k: int,
    floor: float | None,
    cell: str | None,
    block_rows: int,
    item_bytes: Column | None,
) -> DataFrame:
    at = F.col(cell) if cell else F.lit(0)
    # One row per cell, and each task of a cell search holds all centres anyway.
    grid = F.broadcast(
        _blocks(items, at, block_rows, item_bytes)
        .withColumnRenamed("blocks", "item_blocks")
        .join(_blocks(queries, at, block_rows).withColumnRenamed("blocks", "query_blocks"), "cell")
    )

    def spread(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        placed = df.drop("cell").withColumn("cell", at) if not cell else df
        return (
            placed.join(grid, "cell")
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .drop("item_blocks", "query_blocks")
        )

    place = ["cell", "item_block", "query_block"]
    # Queries and items may come from one table, whose columns Spark could not tell apart.
    items = items.select(*(F.col(c).alias(c) for c in items.columns))

    def score(asked: pa.Table, block: pa.Table) -> pa.Table:
        best = Best(asked.num_rows, k, floor)
        if asked.num_rows:
            _scan(best, kernel(asked), block, asked.num_rows)
        return best.table(_names(asked))

    return (
        spread(queries, "qkey", "query_block", "item_block")
        .groupBy(*place)
        .cogroup(spread(items, "item", "item_block", "query_block").groupBy(*place))
        .applyInArrow(score, _result_type(queries))
    )


def best_per_query(scored: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("qkey").orderBy(F.desc("score"), "item")
    return scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def block_topk(
    queries: DataFrame,
    items: DataFrame,
    kernel: Kernel,
    k: int,
    query_size: tuple[int, int],
    floor: float | None = None,
    cell: str | None = None,
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    item_bytes: Column | None = None,
) -> DataFrame:
    """``qkey, item, score, rank``: the ``k`` best items per query.

    ``queries`` has a unique ``qkey`` (unique per cell with ``cell``), ``items`` a unique long
    ``item``. Only items scoring above ``floor`` count. With ``cell`` a query only meets the items
    of its own cells. ``query_size`` is the measured number of queries and of their bytes,
    ``item_bytes`` the size of an item, by which blocks are bounded besides their rows.
    """
    if k < 1:
        raise ValueError("k must be positive")
    rows, size = query_size
    if cell is None and rows <= block_rows and size <= broadcast_bytes:
        scored = _broadcast_topk(queries, items, kernel, k, floor)
    else:
        scored = _paired_topk(queries, items, kernel, k, floor, cell, block_rows, item_bytes)
    return best_per_query(scored, k)
