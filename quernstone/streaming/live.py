"""Search indexes that follow their table by increments.

An index is a folder of tables, each with one folder per batch. A batch adds the rows of its
documents and lists the earlier rows they replace (tombstones: the row's id and the batch it came
with); nothing written is changed. A batch counts once its commit, written last, exists: readers take
the committed batches they find when they open the index, so they see whole batches only, and a batch
that failed is written again from the same state. Work per batch is that of its documents and of the
rows they replace, found by a join on keys.

- ``LiveBm25``: blocks of posting lists of the new texts, lists of texts that are gone for the blocks they
  lie in, and changes of document frequencies and lengths, so scores are those of a fresh index.
- ``LiveVectors``: new vectors go to existing centres. A cell that outgrows its share is split: new
  centres are fitted on a sample of it and its vectors move to them.

Ids are unique among the current rows. Rows without an id are not indexed; documents without a key
are never replaced. ``rebuilt`` writes the current state as the first batch of a new folder.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions import text as tx
from quernstone.operators import bm25, search
from quernstone.operators.joins import salted_join
from quernstone.sources.scratch import CODEC, materialize


class _Batches:
    """The tables of an index folder, read as of the batches before ``until``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self, until: int | None = None) -> list[int]:
        try:
            found = self.spark.read.parquet(f"{self.path}/commits").select("number").distinct().collect()
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []
        return sorted(r.number for r in found if until is None or r.number < until)

    def write(self, df: DataFrame, table: str, number: int, by: str | None = None, options: Mapping | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").options(compression=CODEC, **(options or {}))
        target = f"{self.path}/{table}/written={number}"
        (writer.partitionBy(by) if by else writer).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def read(self, table: str, batches: list[int], schema: str) -> DataFrame:
        """The rows of some batches; a table that a batch did not write to has none of it."""
        names = T.StructType.fromDDL(schema).names  # a folder by cell gives that column last
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{table}/written={n}").select(names) for n in batches]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema)

    def commit(self, number: int, totals: dict[str, int]) -> None:
        row = self.spark.createDataFrame([(number, *totals.values())], "number int, " + ", ".join(f"{k} long" for k in totals))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/written={number}")

    def totals(self, batches: list[int], *names: str) -> list[int]:
        commits = self.spark.read.parquet(f"{self.path}/commits").where(F.col("number").isin(batches))
        return [v or 0 for v in commits.agg(*(F.sum(n) for n in names)).first()]


_GONE = "id long, batch int, rep long, block int"


def _current(rows: DataFrame, gone: DataFrame) -> DataFrame:
    return rows.join(gone.select("id", "batch"), ["id", "batch"], "left_anti")


def _of_keys(rows: DataFrame, touched: DataFrame) -> DataFrame:
    return rows.join(touched.where("key is not null").distinct(), "key", "left_semi")


class LiveBm25:
    """A BM25 index under ``path`` that takes batches of changed documents."""

    TEXTS = "rep long, copies long, n_tokens int, page_content string, batch int, block int"
    COPIES = "id long, key {key}, rep long, batch int, block int"
    TERMS = "term string, df long"
    BLOCKS = "batch int, block int, lists array<struct<term string, df long, most int, least int, docs array<struct<rep long, n_tokens int, tf int>>>>"
    FALLEN = "batch int, block int, docs array<struct<rep long, n_tokens int, tf int>>"

    def __init__(self, spark: SparkSession, path: str, key_type: str = "long", k1: float = bm25.K1, b: float = bm25.B):
        self.tables = _Batches(spark, path)
        self.k1, self.b, self.copies_schema = k1, b, self.COPIES.format(key=key_type)

    def _copies(self, batches: list[int]) -> DataFrame:
        return _current(self.tables.read("copies", batches, self.copies_schema), self.tables.read("gone", batches, _GONE))

    def apply(self, chunks: DataFrame, touched: DataFrame, number: int) -> None:
        """Take ``chunks(id, key, page_content)`` in place of all rows of the keys in ``touched(key)``."""
        tables = self.tables
        batches = tables.committed(number)
        texts = tables.read("texts", batches, self.TEXTS)
        copies = self._copies(batches)
        dead = materialize(_of_keys(copies, touched), "dead-rows")
        # A text is named by the smallest id of its copies. Where that one goes and others stay,
        # the others are indexed anew.
        headless = dead.where("id = rep").select("rep", "batch")
        group = copies.join(headless, ["rep", "batch"], "left_semi")
        moved = group.join(dead.select("id", "batch"), ["id", "batch"], "left_anti")
        moved = materialize(moved.join(texts.select("rep", "batch", "page_content"), ["rep", "batch"]), "moved-rows")
        gone = dead.select("id", "batch", "rep", "block").unionByName(moved.select("id", "batch", "rep", "block"))
        gone = tables.write(gone, "gone", number)

        incoming = chunks.where("id is not null and page_content is not null").select("id", "key", "page_content")
        incoming = materialize(incoming.unionByName(moved.select("id", "key", "page_content")), "incoming")
        made = bm25.named_texts(incoming, bm25.may_repeat(incoming)).withColumn("n_tokens", F.size(tx.tokens("page_content")))
        made = materialize(made, "made-texts")
        n_texts = made.count()
        block = bm25.block_of(n_texts)
        made = made.select("rep", "copies", "n_tokens", "page_content", F.lit(number).alias("batch"), block.alias("block"))
        made = tables.write(made, "texts", number)
        named = made.select("rep", "block", F.md5("page_content").alias("text_key"))
        keyed = incoming.select("id", "key", F.md5("page_content").alias("text_key"))
        joined = salted_join(materialize(keyed, "keyed"), named, "text_key")
        tables.write(joined.select("id", "key", "rep", F.lit(number).alias("batch"), "block"), "copies", number)

        blocks = tables.write(bm25.blocks_of(made, n_texts, number), "blocks", number, options=bm25.BLOCK_ROWS)
        fallen = gone.where("id = rep").groupBy("batch", "block").agg(
            F.collect_list(F.struct("rep", F.lit(0).alias("n_tokens"), F.lit(None).cast("int").alias("tf"))).alias("docs")
        )
        tables.write(fallen, "fallen", number)

        less = gone.groupBy("rep", "batch").agg(F.count("*").alias("n"))
        less = materialize(less.join(texts, ["rep", "batch"]).select("n", "n_tokens", "page_content"), "lost-texts")
        lost = less.select("n", F.explode(F.array_distinct(tx.tokens("page_content"))).alias("term"))
        lost = lost.groupBy("term").agg((-F.sum("n")).alias("df"))
        gained = bm25.lists_in(blocks).select("term", "df")
        changed = gained.unionByName(lost).groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")
        tables.write(changed, "terms", number)
        more = made.agg(F.sum("copies"), F.sum(F.col("copies") * F.col("n_tokens"))).first()
        fewer = less.agg(F.sum("n"), F.sum(F.col("n") * F.col("n_tokens"))).first()
        n, size = ((a or 0) - (c or 0) for a, c in zip(more, fewer, strict=True))
        tables.commit(number, {"n_chunks": n, "n_tokens": size})

    def open(self, until: int | None = None) -> bm25.Bm25Index:
        """The index as of the batches committed now (or of those before ``until``)."""
        tables = self.tables
        batches = tables.committed(until)
        gone = tables.read("gone", batches, _GONE)
        lost = gone.where("id = rep").select("rep", "batch")
        texts = tables.read("texts", batches, self.TEXTS).join(lost, ["rep", "batch"], "left_anti")
        copies = self._copies(batches).select("rep", "id")
        n, size = tables.totals(batches, "n_chunks", "n_tokens") if batches else (0, 0)
        terms = tables.read("terms", batches, self.TERMS).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        terms = materialize(terms.withColumn("idf", bm25.idf(n, F.col("df"))), "terms")
        blocks = tables.read("blocks", batches, self.BLOCKS)
        places = blocks.rdd.getNumPartitions()
        # The texts that are gone become one more list of their block, without a term; a block stays one row.
        fallen = tables.read("fallen", batches, self.FALLEN).groupBy("batch", "block").agg(F.flatten(F.collect_list("docs")).alias("docs"))
        none, zero = F.lit(None).cast("string"), F.lit(0)
        less = F.struct(none.alias("term"), zero.cast("long").alias("df"), zero.alias("most"), zero.alias("least"), "docs")
        blocks = blocks.join(fallen, ["batch", "block"], "left").select(
            "batch", "block", F.when(F.col("docs").isNull(), F.col("lists")).otherwise(F.concat("lists", F.array(less))).alias("lists")
        )
        return bm25.Bm25Index(texts, copies, terms, bm25.lists_in(blocks), n, size / n if n else 0.0, self.k1, self.b, places)

    def rows(self) -> DataFrame:
        """``id, key, page_content`` of all current chunks."""
        batches = self.tables.committed()
        texts = self.tables.read("texts", batches, self.TEXTS).select("rep", "batch", "page_content")
        return self._copies(batches).join(texts, ["rep", "batch"]).select("id", "key", "page_content")

    def rebuilt(self, path: str) -> LiveBm25:
        fresh = LiveBm25(self.tables.spark, path, "long", self.k1, self.b)
        fresh.copies_schema = self.copies_schema
        rows = materialize(self.rows(), "live-rows")
        fresh.apply(rows, rows.select("key").limit(0), 0)
        return fresh


class LiveVectors:
    """A vector index under ``path`` that takes batches of changed rows.

    ``outgrown``: a cell with more than so many times the mean of all cells is split.
    """

    ROWS = "id long, key {key}, embedding array<float>, gap double, cell int, batch int"
    CELLS = "cell int, radius double, n long"
    CENTRES = "cell int, centre array<double>"

    def __init__(self, spark: SparkSession, path: str, key_type: str = "long", cells: int | None = None, outgrown: float = 4.0, seed: int = 7):
        self.tables = _Batches(spark, path)
        self.cells, self.outgrown, self.seed = cells, outgrown, seed
        self.schema = self.ROWS.format(key=key_type)

    def _rows(self, batches: list[int]) -> DataFrame:
        return _current(self.tables.read("vectors", batches, self.schema), self.tables.read("gone", batches, _GONE))

    def _centres(self, batches: list[int]) -> np.ndarray:
        found = self.tables.read("centres", batches, self.CENTRES).orderBy("cell").collect()  # bounded: see search
        return np.array([r.centre for r in found])

    def apply(self, vectors: DataFrame, touched: DataFrame, number: int) -> None:
        """Take ``vectors(id, key, embedding)`` in place of all rows of the keys in ``touched(key)``."""
        tables, seed = self.tables, self.seed
        batches = tables.committed(number)
        known = vectors.where("id is not null and embedding is not null").select("id", "key", F.col("embedding").cast("array<float>").alias("embedding"))
        known = materialize(known, "incoming")
        live = self._rows(batches)
        dead = materialize(_of_keys(live, touched).select("id", "batch", "cell"), "dead-rows")
        centres = self._centres(batches) if batches else np.empty((0, 0))
        new: list[tuple[int, list[float]]] = []
        if not len(centres) and not known.isEmpty():
            centres = search.fitted_centres(known, self.cells, seed)
            new = [(n, c.tolist()) for n, c in enumerate(centres)]
        added = materialize(_placed(known, centres), "placed")
        sizes = added.groupBy("cell").agg(F.count("*").alias("n"))
        old = tables.read("cells", batches, self.CELLS).select("cell", "n")
        less = dead.groupBy("cell").agg((-F.count("*")).alias("n"))
        sizes = old.unionByName(sizes).unionByName(less).groupBy("cell").agg(F.sum("n").alias("n")).collect()  # one row a cell
        sizes = {r.cell: r.n for r in sizes if r.n > 0}
        mean = sum(sizes.values()) / max(1, len(sizes))
        split = {c: int(np.ceil(n / mean)) for c, n in sizes.items() if n > self.outgrown * mean and n > 1}
        gone = dead
        if split:
            inside = F.col("cell").isin(list(split))
            stay = live.where(inside).join(dead.select("id", "batch"), ["id", "batch"], "left_anti")
            both = stay.select(*known.columns, "cell", "batch").unionByName(added.where(inside).select(*known.columns, "cell", F.lit(None).cast("int").alias("batch")))
            both = materialize(both, "outgrown-cells")
            fresh = _split_centres(both, split, sizes, seed)
            new += [(len(centres) + k, c) for k, c in enumerate(fresh)]
            # The old centre stays in its place without vectors.
            reach = np.full(len(centres) + len(fresh), True)
            reach[list(split)] = False
            centres = np.concatenate([centres, np.array(fresh).reshape(len(fresh), -1)])
            moved = _placed(both.select(*known.columns), centres, reach)
            gone = gone.unionByName(both.where("batch is not null").select("id", "batch", "cell"))
            added = materialize(added.where(~inside).unionByName(moved), "placed-anew")
        gone = tables.write(gone.select("id", "batch", F.col("id").alias("rep"), F.col("cell").alias("block")), "gone", number)
        rows = added.withColumn("batch", F.lit(number)).select(*known.columns, "gap", "cell", "batch")
        tables.write(rows.hint("rebalance", "cell"), "vectors", number, by="cell")
        come = rows.groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n"))
        went = gone.groupBy(F.col("block").alias("cell")).agg(F.lit(0.0).alias("radius"), (-F.count("*")).alias("n"))
        tables.write(come.unionByName(went).select("cell", "radius", "n"), "cells", number)
        tables.write(tables.spark.createDataFrame(new, self.CENTRES), "centres", number)
        tables.commit(number, {"n_rows": known.count()})

    def open(self, until: int | None = None) -> search.VectorIndex:
        """The index as of the batches committed now (or of those before ``until``)."""
        batches = self.tables.committed(until)
        cells = self.tables.read("cells", batches, self.CELLS)
        cells = cells.groupBy("cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).where("n > 0")
        return search.VectorIndex(self._rows(batches), materialize(cells, "cells"), self._centres(batches))

    def rebuilt(self, path: str) -> LiveVectors:
        fresh = LiveVectors(self.tables.spark, path, "long", self.cells, self.outgrown, self.seed)
        fresh.schema = self.schema
        rows = materialize(self._rows(self.tables.committed()), "live-rows")
        fresh.apply(rows, rows.select("key").limit(0), 0)
        return fresh


def _placed(vectors: DataFrame, centres: np.ndarray, reach: np.ndarray | None = None) -> DataFrame:
    """``vectors`` with the nearest centre (``cell``) and its distance (``gap``)."""
    return vectors.withColumn("_at", search.nearest_udf(centres, reach)("embedding")).select(
        *vectors.columns, "_at.gap", "_at.cell"
    )


def _split_centres(rows: DataFrame, parts: dict[int, int], sizes: dict[int, int], seed: int) -> list[list[float]]:
    """New centres for each of some cells, fitted on a bounded sample of the cell's vectors."""
    wanted = F.create_map(*(F.lit(v) for c, p in parts.items() for v in (c, min(1.0, search.TRAIN_PER_CELL * p / sizes[c]))))
    share = F.element_at(wanted, F.col("cell"))
    # A part of the rows by a hash of the id, so a repeated task takes the same.
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        points = search._unit(np.stack(frame["embedding"]).astype(np.float64))
        made = search.small_kmeans(points, parts[int(frame["cell"].iloc[0])], seed)
        return pd.DataFrame({"cell": int(frame["cell"].iloc[0]), "centre": [c.tolist() for c in made]})

    made = some.select("cell", "embedding").groupBy("cell").applyInPandas(fit, "cell int, centre array<double>")
    return [r.centre for r in sorted(made.collect(), key=lambda r: (r.cell, r.centre))]  # bounded by the centres
