"""Exact BM25 retrieval for many questions at once (Robertson and Zaragoza, 2009).

Distinct texts are dealt to blocks by a hash. The index holds one posting list per term and block,
with the largest count and the smallest length in it: together they bound what the term can add to a
score there, whatever the average length becomes. A block's lists are written as one row, so a search
scans them where they lie; only lists too few to keep all cores busy move to their tasks. No text's tokens move. A task goes through its blocks with a running k-th
score per question and skips each block whose bound stays below it (block-max pruning, Ding and Suel, 2011).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.functions import text as tx
from quernstone.operators import topk
from quernstone.operators.filters import may_be_in, release_filters
from quernstone.operators.joins import salted_join
from quernstone.sources.scratch import materialize, scratch_path

K1 = 1.2
B = 0.75
BLOCK_TEXTS = 1024
# Blocks of texts whose lists a task reads, where questions travel in parts.
BLOCKS_TOGETHER = 64
# Questions that a task holds at a time.
BLOCK_QUESTIONS = 65_536
# Scores of one round of the kernel; pairs of a question and a text scored exactly at a time.
CELLS = 1 << 20
EXACT_PAIRS = 1 << 15
# Lists whose postings, counted once for each question that asks for them, are this share of all pairs of a question and a
# text are scored as a matrix, up to so many.
COMMON = 300
MOST_COMMON = 256
HALF_PLACE = 0.5 * 10.0**-topk.PLACES + 1e-9


@dataclass
class Bm25Index:
    """Written tables of an index.

    texts: rep, copies, n_tokens, page_content (one row per distinct chunk text)
    copies: rep, id (one row per chunk)
    terms: term, df, idf
    postings: batch, block, term, df, most, least, docs(rep, n_tokens, tf); a row without a term
        lists texts of its block that are gone
    places: in how many partitions ``postings`` has the lists, those of a block behind each other; 0: in any order
    """

    texts: DataFrame
    copies: DataFrame
    terms: DataFrame
    postings: DataFrame
    n_chunks: int
    avg_tokens: float
    k1: float
    b: float
    places: int = 0


def idf(n_chunks: float, df: Column) -> Column:
    return F.log(1 + (F.lit(float(n_chunks)) - df + 0.5) / (df + 0.5))


def distinct_texts(chunks: DataFrame) -> DataFrame:
    """One row per distinct text, named by its smallest id; texts are combined before the shuffle."""
    return (
        chunks.groupBy("page_content")
        .agg(F.count("*").alias("copies"), F.min("id").alias("rep"))
        .select("rep", "copies", "page_content")
    )


def may_repeat(chunks: DataFrame) -> Column:
    """Whether another row of ``chunks`` may have a row's ``page_content``: false only for texts that stand alone.

    Hashes are counted, so no text is moved for it.
    """
    key = F.xxhash64("page_content")
    again = chunks.groupBy(key.alias("text_hash")).count().where("count > 1").select("text_hash")
    return may_be_in(materialize(again, "repeated-texts"), "text_hash")(F.xxhash64(key))


def named_texts(chunks: DataFrame, maybe: Column) -> DataFrame:
    """``rep, copies, page_content`` as ``distinct_texts`` gives them; texts that stand alone stay where they are."""
    alone = chunks.where(~maybe).select(F.col("id").alias("rep"), F.lit(1).cast("long").alias("copies"), "page_content")
    return alone.unionAll(distinct_texts(chunks.where(maybe)))


def _smallest_copies(copies: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """``rep, ids``: the ``k`` smallest ids of each of the distinct ``reps``, cut before the shuffle."""
    by_text = Window.partitionBy("rep").orderBy("id")
    return (
        salted_join(copies, reps, "rep")
        .withColumn("nth", F.row_number().over(by_text))
        .where(F.col("nth") <= k)
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )


def block_of(n_texts: int) -> Column:
    return F.pmod(F.xxhash64("rep"), F.lit(max(1, -(-n_texts // BLOCK_TEXTS)))).cast("int")


_LISTS = "term string, df long, most int, least int, docs array<struct<rep:long,n_tokens:int,tf:int>>"
_POSTINGS = f"block int, {_LISTS}"
# How blocks are written: a reader unpacks a row group at a time, in which a block's lists take a few MB.
BLOCK_ROWS = {"parquet.block.row.count.limit": 8}


def _lists_of_block(rows: pa.Table) -> pa.RecordBatch:
    """The posting lists of the texts of one block, sorted by term; texts by ``rep``."""
    rows = rows.sort_by("rep").combine_chunks()
    tokens = rows.column("tokens").combine_chunks()
    words = tokens.flatten().dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    owner = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).to_numpy())
    met, tf = np.unique(place[words.indices.to_numpy()] * len(tokens) + owner, return_counts=True)
    term, text = np.divmod(met, max(1, len(tokens)))
    first = np.searchsorted(term, np.arange(len(order) + 1))
    starts = first[:-1]
    copies, length = (rows.column(c).combine_chunks() for c in ("copies", "n_tokens"))
    tf = tf.astype(np.int32)
    docs = pa.StructArray.from_arrays(
        [rows.column("rep").combine_chunks().take(pa.array(text)), length.take(pa.array(text)), pa.array(tf)], ["rep", "n_tokens", "tf"]
    )
    made = {
        "block": pa.array(np.full(len(order), rows.column("block")[0].as_py(), np.int32)),
        "term": words.dictionary.take(order),
        "df": pa.array(np.add.reduceat(copies.to_numpy()[text], starts)),
        "most": pa.array(np.maximum.reduceat(tf, starts)),
        "least": pa.array(np.minimum.reduceat(length.to_numpy()[text], starts)),
        "docs": pa.ListArray.from_arrays(pa.array(first, pa.int32()), docs),
    }
    return pa.RecordBatch.from_arrays(list(made.values()), list(made))


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each run of equal ``keys``, which may come in pieces of any size."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        place = np.stack([table.column(c).to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            if held and tuple(place[lo]) != last:
                yield pa.concat_tables(held)
                held = []
            last = tuple(place[lo])
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def _one_row(lists: pa.RecordBatch) -> pa.RecordBatch:
    """The lists of a block as one row ``block, lists``."""
    columns = lists.schema.names[1:]
    flat = pa.StructArray.from_arrays([lists.column(c) for c in columns], columns)
    packed = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
    return pa.RecordBatch.from_arrays([lists.column("block").slice(0, 1), packed], ["block", "lists"])


def _counted(texts: DataFrame, n_texts: int, made: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``made`` makes of the lists of each block.

    The texts move once, to their blocks, and are sorted as texts; the tokens of one block at a time
    are counted in arrays, so no row per token is sorted or spilled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ("block",)):
            if pc.sum(pc.list_value_length(rows.column("tokens"))).as_py():
                yield made(_lists_of_block(rows))

    placed = texts.select("rep", "copies", "n_tokens", "page_content", block_of(n_texts).alias("block"))
    placed = placed.repartition("block").sortWithinPartitions("block")
    split = placed.select("block", "rep", "copies", "n_tokens", tx.tokens("page_content").alias("tokens"))
    return split.mapInArrow(count, schema)


def postings_of(texts: DataFrame, n_texts: int, batch: int = 0) -> DataFrame:
    """The posting lists of ``texts(rep, copies, n_tokens, page_content)``, a row each."""
    lists = _counted(texts, n_texts, lambda block: block, _POSTINGS)
    return lists.select(F.lit(batch).alias("batch"), "block", "term", "df", "most", "least", "docs")


def blocks_of(texts: DataFrame, n_texts: int, batch: int = 0) -> DataFrame:
    """The same lists, one row per block: ``batch, block, lists``. A reader never splits a row, so a block stays whole."""
    return _counted(texts, n_texts, _one_row, f"block int, lists array<struct<{_LISTS}>>").select(F.lit(batch).alias("batch"), "block", "lists")


def lists_in(blocks: DataFrame) -> DataFrame:
    """The posting lists of written blocks, those of a block behind each other."""
    return blocks.select("batch", "block", F.explode("lists").alias("one")).select("batch", "block", "one.*")


def build_bm25(
    chunks: DataFrame, k1: float = K1, b: float = B, path: str | None = None
) -> Bm25Index:
    """Index ``chunks(id, page_content)``; pass a saved table, as it is read more than once."""
    path = path or scratch_path(chunks.sparkSession, "bm25")
    known = chunks.where("page_content is not null").select("id", "page_content")
    release_filters()  # what earlier queries have broadcast
    maybe = may_repeat(known)
    texts = materialize(
        named_texts(known, maybe).withColumn("n_tokens", F.size(tx.tokens("page_content"))), "texts", f"{path}/texts"
    )
    keyed = materialize(known.where(maybe).select("id", F.md5("page_content").alias("text_key")), "keyed")
    reps = texts.where(maybe).select("rep", F.md5("page_content").alias("text_key"))
    alone = known.where(~maybe).select(F.col("id").alias("rep"), "id")
    copies = alone.unionAll(salted_join(keyed, reps, "text_key").select("rep", "id"))
    copies = materialize(copies, "copies", f"{path}/copies")
    totals = texts.agg(
        F.count("*").alias("texts"),
        F.sum("copies").alias("n"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"),
    ).first()
    n_chunks = totals["n"] or 0
    avg_tokens = (totals["tokens"] or 0) / n_chunks if n_chunks else 0.0
    blocks = materialize(blocks_of(texts, totals["texts"]), "blocks", f"{path}/blocks", BLOCK_ROWS)
    postings = lists_in(blocks)
    terms = postings.groupBy("term").agg(F.sum("df").alias("df"))
    terms = materialize(terms.withColumn("idf", idf(n_chunks, F.col("df"))), "terms", f"{path}/terms")
    totals_row = [(n_chunks, float(avg_tokens), k1, b)]
    materialize(
        chunks.sparkSession.createDataFrame(totals_row, "n_chunks long, avg_tokens double, k1 double, b double"),
        "totals",
        f"{path}/totals",
    )
    return Bm25Index(texts, copies, terms, postings, n_chunks, avg_tokens, k1, b, blocks.rdd.getNumPartitions())


def open_bm25(spark: SparkSession, path: str) -> Bm25Index:
    """The index that ``build_bm25`` wrote to ``path``, in this or another session."""
    totals = spark.read.parquet(f"{path}/totals").first()
    texts, copies, terms, blocks = (spark.read.parquet(f"{path}/{name}") for name in ("texts", "copies", "terms", "blocks"))
    return Bm25Index(texts, copies, terms, lists_in(blocks), *totals, blocks.rdd.getNumPartitions())


def question_terms(questions: DataFrame) -> DataFrame:
    """``qid, qkey, q_terms``; questions with the same terms share ``qkey``."""
    return questions.select("qid", tx.terms("questions").alias("q_terms")).select(
        "qid", F.md5(F.array_join("q_terms", " ")).alias("qkey"), "q_terms"
    )


def term_weights(index: Bm25Index, asked: DataFrame) -> DataFrame:
    """``qkey, q_weights``: the distinct terms of each question with their idf, sorted by term.

    A term that no chunk contains gets the idf of frequency 0.
    """
    qterms = materialize(
        asked.select("qkey", F.explode("q_terms").alias("term")).distinct(), "qterms"
    )
    unseen = idf(index.n_chunks, F.lit(0.0))
    return (
        salted_join(qterms, index.terms.select("term", "idf"), "term", "left")
        .groupBy("qkey")
        .agg(
            # one question's own terms
            F.array_sort(
                F.collect_list(F.struct("term", F.coalesce("idf", unseen).alias("idf")))
            ).alias("q_weights")
        )
    )


class _Block:
    """The posting lists of a block by term code: ``size`` postings from ``first`` on, of the text ``at`` with the ``gain`` of a term of idf 1."""

    def __init__(self, reps: np.ndarray, at: np.ndarray, gain: np.ndarray, gone: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.reps, self.at, self.gain, self.gone, self.first, self.size = reps, at, gain, gone, first, size
        self.known: tuple[np.ndarray, np.ndarray] | None = None

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The places of the postings of ``codes``, one list after another."""
        n = self.size[codes]
        places = np.repeat(self.first[codes] - np.cumsum(n) + n, n)
        places += np.arange(len(places))
        return places

    def gain_of(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """The gain of each term in each text, 0 where it is not in it."""
        if self.known is None:
            terms = np.flatnonzero(self.size)
            place = self.places(terms)
            keys = np.repeat(terms, self.size[terms]) * len(self.reps) + self.at[place]
            order = np.argsort(keys)
            self.known = np.append(keys[order], -1), np.append(self.gain[place][order], 0.0)
        keys, gains = self.known
        wanted = codes * len(self.reps) + texts
        place = np.searchsorted(keys[:-1], wanted)
        return np.where(keys[place] == wanted, gains[place], 0.0)


def _alike_together(queries: pa.Table) -> pa.Table:
    """Questions by their two commonest terms: those scored together then share more of their terms."""
    weights = queries.column("q_weights").combine_chunks()
    flat, counts = weights.flatten(), pc.list_value_length(weights).to_numpy()
    owner, begin = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
    code = flat.field("term").dictionary_encode().indices.to_numpy()[np.lexsort((flat.field("idf").to_numpy(), owner))]
    code = np.append(code, [-1, -1])
    first, second = (np.where(counts > i, code[np.minimum(begin + i, len(code) - 1)], -1) for i in (0, 1))
    return queries.take(pa.array(np.lexsort((second, first)))).combine_chunks()


class _Scorer:
    """Questions against blocks of posting lists, with the best ``k`` texts per question so far.

    All texts of a block are scored in single precision first: lists that many questions ask for and many texts
    are in as one matrix product, the others posting by posting. Only texts that may belong in front, by a
    bound of what single precision loses, are scored exactly.
    """

    def __init__(self, queries: pa.Table, k: int, k1: float, b: float, avg_tokens: float):
        queries = _alike_together(queries)
        weights = queries.column("q_weights").combine_chunks()
        flat = weights.flatten()
        self.names = queries.column("qkey").combine_chunks()
        self.n, self.k = queries.num_rows, k
        self.vocabulary = flat.field("term").unique()
        self.codes = pc.index_in(flat.field("term"), value_set=self.vocabulary).to_numpy()
        self.idfs = flat.field("idf").to_numpy()
        counts = pc.list_value_length(weights).to_numpy()
        self.owner = np.repeat(np.arange(self.n), counts)
        self.begin = np.concatenate([[0], np.cumsum(counts)])
        self.common_first = np.lexsort((self.idfs, self.owner))
        self.most_terms = int(counts.max(initial=0))
        self.best = topk.BestOfMany(self.n, k, 0.0)
        self.k1, self.b, self.avg = k1, b, avg_tokens or 1.0
        self.scored = self.skipped = 0  # (question, block) pairs
        self.exact = 0  # pairs of a question and a text

    def _added(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.avg))

    def add(self, lists: pa.Table) -> None:
        """Score the lists of one block, those of terms not asked for included."""
        code = pc.index_in(lists.column("term"), value_set=self.vocabulary).combine_chunks()
        docs = lists.column("docs").combine_chunks()
        flat, sizes = docs.flatten(), pc.list_value_length(docs).to_numpy()
        if not len(flat):
            return
        reps, at = np.unique(flat.field("rep").to_numpy(), return_inverse=True)
        gone = np.zeros(len(reps), bool)
        gone[at[np.repeat(lists.column("term").combine_chunks().is_null().to_numpy(zero_copy_only=False), sizes)]] = True
        asked = np.flatnonzero(code.is_valid().to_numpy(zero_copy_only=False))
        v = len(self.vocabulary)
        first, size, bound = np.zeros(v, np.int64), np.zeros(v, np.int64), np.zeros(v)
        here = code.take(pa.array(asked)).to_numpy()
        starts = np.cumsum(sizes) - sizes
        first[here], size[here] = starts[asked], sizes[asked]
        gain = self._added(flat.field("tf").fill_null(0).to_numpy().astype(np.float64), flat.field("n_tokens").to_numpy())
        largest = np.zeros(len(sizes))
        largest[sizes > 0] = np.maximum.reduceat(gain, starts[sizes > 0])
        bound[here] = largest[asked]
        reach = np.bincount(self.owner, self.idfs * bound[self.codes], self.n)
        alive = (reach > 0) & (reach >= self.best.bar - HALF_PLACE)
        self.scored += int(alive.sum())
        self.skipped += int((reach > 0).sum() - alive.sum())
        self._score(_Block(reps, at, gain, gone, first, size), alive)

    def _score(self, block: _Block, alive: np.ndarray) -> None:
        n = len(block.reps)
        gain, at = block.gain.astype(np.float32), block.at.astype(np.int32)
        questions, together = np.flatnonzero(alive), max(1, CELLS // n)
        slot = (np.cumsum(alive) - 1).astype(np.int32)
        found = [(np.empty(0, np.int64),) * 2]
        for low in range(0, len(questions), together):
            some = questions[low : low + together]
            mine = self.common_first[self.begin[some[0]] : self.begin[some[-1] + 1]]
            mine = mine[(block.size[self.codes[mine]] > 0) & alive[self.owner[mine]]]
            code, row, idf = self.codes[mine], slot[self.owner[mine]] - np.int32(low), self.idfs[mine]
            common, column = self._common(block, code, len(some))
            shared, other = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
            weights = np.zeros((len(some), len(common)), np.float32)
            weights[row[shared], column[shared]] = idf[shared]
            gains = np.zeros((len(common), n), np.float32)
            place = block.places(common)
            gains[np.repeat(np.arange(len(common)), block.size[common]), at[place]] = gain[place]
            near = weights @ gains

            code, row, idf = code[other], row[other] * np.int32(n), idf[other].astype(np.float32)
            counts = block.size[code]
            place = block.places(code)
            worth = np.repeat(idf, counts)
            worth *= gain[place]
            cell = np.repeat(row, counts)
            cell += at[place]
            np.add.at(near.reshape(-1), cell, worth)
            near[:, block.gone] = 0

            # All parts of a score are positive, so each of its sums and products loses this share of it at most.
            slack = 2.0**-23 * (len(common) + self.most_terms + 8)
            least = np.maximum(self.best.bar[some] - HALF_PLACE, 0)
            fresh = np.flatnonzero(least == 0)
            if len(fresh) and n > self.k:
                kth = np.partition(near[fresh], n - self.k, axis=1)[:, n - self.k].astype(np.float64)
                least[fresh] = np.maximum(kth * (1 - slack) - 2 * HALF_PLACE, 0)
            least = np.maximum(least * (1 - slack), np.finfo(np.float32).tiny).astype(np.float32)
            reached = np.flatnonzero(near.max(axis=1) >= least)
            q, text = np.nonzero(near[reached] >= least[reached, None])
            found.append((some[reached[q]], text))
        asked, texts = (np.concatenate(part) for part in zip(*found, strict=True))
        self._add_exact(block, asked, texts)

    def _common(self, block: _Block, code: np.ndarray, n_questions: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms to score as a matrix, and the place among them of each of ``code``, or -1."""
        worth = np.bincount(code, minlength=len(block.size)) * block.size
        common = np.flatnonzero(worth * COMMON >= n_questions * len(block.reps))
        common = common[np.argsort(-worth[common], kind="stable")[:MOST_COMMON]]
        rank = np.full(len(worth), -1, np.int32)
        rank[common] = np.arange(len(common))
        return common, rank[code]

    def _add_exact(self, block: _Block, asked: np.ndarray, texts: np.ndarray) -> None:
        """Score pairs of a question and a text of the block, the terms in order."""
        self.exact += len(asked)
        scores = np.zeros(len(asked))
        for low in range(0, len(asked), EXACT_PAIRS):
            some, text = asked[low : low + EXACT_PAIRS], texts[low : low + EXACT_PAIRS]
            n = self.begin[some + 1] - self.begin[some]
            pair = np.repeat(np.arange(len(some)), n)
            entry = np.repeat(self.begin[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            worth = self.idfs[entry] * block.gain_of(self.codes[entry], text[pair])
            scores[low : low + EXACT_PAIRS] = np.bincount(pair, worth, len(some))
        self.best.add(asked, np.round(scores, topk.PLACES), block.reps[texts])

    def add_sorted(self, batches: Iterator[pa.RecordBatch]) -> None:
        """Rows sorted by batch and block, in pieces of any size; a block's rows are scored together."""
        for lists in runs(batches, ("batch", "block")):
            self.add(lists)

    def table(self) -> pa.Table:
        return self.best.table(self.names)


_LIST = ("batch", "block", "term", "most", "least", "docs")


def _bytes_of(asked_terms: DataFrame) -> int:
    return asked_terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0


def _asked_lists(index: Bm25Index, asked_terms: DataFrame, tasks: int) -> DataFrame:
    """The lists of the asked terms and of texts that are gone, whole blocks in a task.

    Lists that lie whole in at least one partition per core are scanned there, and none is moved or written for it.
    Terms of over ``topk.BROADCAST_BYTES`` then only tell most lists that are not asked for, which the scorer passes over.
    """
    lists = index.postings
    if index.places < lists.sparkSession.sparkContext.defaultParallelism:
        return _dealt_lists(index, asked_terms, tasks)
    if _bytes_of(asked_terms) <= topk.BROADCAST_BYTES:
        gone = asked_terms.sparkSession.range(1).select(F.lit(None).cast("string").alias("term"))
        kept = F.broadcast(asked_terms.select("term").unionAll(gone))
        lists = lists.join(kept, lists["term"].eqNullSafe(kept["term"]), "left_semi")
    else:
        lists = lists.where(F.col("term").isNull() | may_be_in(asked_terms, "term")(F.xxhash64("term")))
    return lists.select(*_LIST)


def _dealt_lists(index: Bm25Index, asked_terms: DataFrame, tasks: int, most: int = topk.BROADCAST_BYTES) -> DataFrame:
    """The lists of the asked terms and of texts that are gone, whole blocks in a task.

    ``asked_terms`` is a written table. Up to ``most`` bytes of terms go to the lists, which then move once; beyond
    that a join moves the lists by their terms first, those that a filter of the terms lets through.
    """
    size = _bytes_of(asked_terms)
    lists = index.postings
    if size <= most:
        asked_terms = F.broadcast(asked_terms)
    else:
        lists = lists.where(may_be_in(asked_terms, "term")(F.xxhash64("term")))
    lists = lists.join(asked_terms, "term", "left_semi")
    lists = lists.unionByName(index.postings.where("term is null")).select(*_LIST)
    return lists.repartition(tasks, "batch", "block").sortWithinPartitions("batch", "block")


def _scored(index: Bm25Index, lists: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The questions go to every task, which keeps its best of all its blocks."""
    shared = queries.sparkSession.sparkContext.broadcast(queries.toArrow())
    how = (k, index.k1, index.b, index.avg_tokens)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared.value.num_rows:
            return
        scorer = _Scorer(shared.value, *how)
        scorer.add_sorted(batches)
        yield from scorer.table().to_batches()

    return lists.mapInArrow(scan, "qkey string, item long, score double")


def _few_questions(index: Bm25Index, queries: DataFrame, asked_terms: DataFrame, k: int) -> DataFrame:
    spark = queries.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _scored(index, _asked_lists(index, asked_terms, tasks), queries, k)


def _many_questions(index: Bm25Index, queries: DataFrame, n_queries: int, block_rows: int, k: int) -> DataFrame:
    """Questions travel in parts, one at a time through the driver; lists that are dealt are dealt once, for all parts.

    Every part scans the written lists, or the same exchange of them, so what is moved and kept on disk grows
    with the lists alone, and a task holds one part of the questions and one block of lists.
    """
    parts = max(1, -(-n_queries // block_rows))
    wanted = materialize(queries.select(F.explode("q_weights.term").alias("term")).distinct(), "bm25_terms")
    blocks = index.postings.select("batch", "block").distinct().count()
    tasks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-blocks // BLOCKS_TOGETHER))
    lists = _asked_lists(index, wanted, tasks)
    of_part = F.pmod(F.xxhash64("qkey"), F.lit(parts))
    scored = (_scored(index, lists, queries.where(of_part == part), k) for part in range(parts))
    return reduce(DataFrame.unionAll, scored)


def bm25_search(
    index: Bm25Index,
    questions: DataFrame,
    k: int = 4,
    block_rows: int = BLOCK_QUESTIONS,
    broadcast_bytes: int = topk.BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` best chunks per question: ``qid, rank, id, page_content, score``.

    Questions with equal terms are searched once, and equal chunk texts are scored once. Chunks
    without any question term are no hits. Ties go to the smaller id.
    """
    if k < 1:
        raise ValueError("k must be positive")
    release_filters()  # what earlier searches have broadcast
    asked = materialize(question_terms(questions), "asked")
    queries = materialize(term_weights(index, asked), "bm25_queries")
    term_bytes = F.aggregate(
        "q_weights", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w["term"]) + 16
    )
    rows, size = queries.agg(F.count("*"), F.coalesce(F.sum(term_bytes), F.lit(0))).first()
    if rows <= block_rows and size <= broadcast_bytes:
        asked_terms = materialize(queries.select(F.explode("q_weights.term").alias("term")).distinct(), "bm25_terms")
        scored = _few_questions(index, queries, asked_terms, k)
    else:
        parts = max(-(-rows // block_rows), -(-size // (broadcast_bytes or topk.BROADCAST_BYTES)))
        scored = _many_questions(index, queries, rows, -(-rows // parts), k)
    best = topk.best_per_query(scored, k)
    found = materialize(best.select("qkey", F.col("item").alias("rep"), "score"), "bm25_found")
    # Texts and copies that no question found stay where they are.
    reps = materialize(found.select("rep").distinct(), "bm25_reps")
    wanted = may_be_in(reps, "rep")(F.xxhash64("rep"))
    ids = _smallest_copies(index.copies.where(wanted), reps, k)
    texts = ids.join(index.texts.where(wanted).select("rep", "page_content"), "rep")
    ranked = Window.partitionBy("qkey").orderBy(F.desc("score"), "id")
    hits = (
        salted_join(found, texts, "rep")
        .select("qkey", "score", "page_content", F.explode("ids").alias("id"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )
    return salted_join(asked.select("qid", "qkey"), hits, "qkey").select(
        "qid", "rank", "id", "page_content", "score"
    )


def question_idf(index: Bm25Index, questions: DataFrame) -> DataFrame:
    """``qid, q_weights``: see ``term_weights``; a question without terms gets an empty list."""
    asked = materialize(question_terms(questions), "asked")
    none = F.array().cast("array<struct<term:string,idf:double>>")
    return salted_join(
        asked.select("qid", "qkey"), term_weights(index, asked), "qkey", "left"
    ).select("qid", F.coalesce("q_weights", none).alias("q_weights"))
