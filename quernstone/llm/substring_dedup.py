"""Substring dedup by difference-cover anchors.

A window is ``width`` consecutive words of one document. A word goes if a window covers it whose word
sequence also starts in a document with a smaller id; windows are judged on the input.

Rows whose whole text a row of a smaller id has too lose everything (from ``width`` words on) and add no
window; they are told by the md5 of their text and take no part in what follows.

1. Anchors. Positions of a text are taken modulo ``period``; a difference cover is a set of residues
   whose differences give every residue. Only at the cover's positions the next ``anchor`` words are
   hashed (of 13 words: 7, at 3 of 7 positions). Two equal windows at any two positions have cover
   positions at the same distance from their starts, within ``period``, so they share an anchor there.
   Counting anchors once per document, combined in tasks, gives those that occur in two or more.
2. Extension. Around each shared anchor the windows that contain it are spelled out by a hash of 96
   bits, and the smallest id is found per window. No pair of occurrences is ever formed.
3. Windows whose smallest id is below their own document's are gathered per document, and its words
   are dropped. Only texts that lose something are moved.

Which anchors are shared is told to the scan by a bitmap of up to 32 MB as long as they are few against its
bits (``few``); beyond that each text's anchors are joined with the shared ones. Both ways name
every shared anchor and the result is the same. Joins are salted by counts (``join_by_counts``), so a
passage in a third of all documents is spread over tasks.

- Null and empty texts have no words and lose none. Rows without an id neither lose nor remove words.
- Rows sharing an id are one document; equal ones are treated alike. Ties do not occur: a window's
  first id is one value. A text repeating itself loses nothing by that.
- An empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import filter_bits, join_by_counts, materialize, may_be_in, membership, words_of
from quernstone.llm.shingles import mix

WIDTH = 13
GROUP = 200_000  # words hashed together
ANCHOR_BITS = 1 << 28
ANCHOR_BITS_PER_KEY = 16
FEW = ANCHOR_BITS // 12

_digest = xxhash.xxh3_128_digest


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest first set of residues whose differences give all; up to 16 by search, above by a rule of about 2 roots."""
    if period <= 16:
        for size in range(1, period + 1):
            for rest in combinations(range(1, period), size - 1):
                cover = (0, *rest)
                if len({(a - b) % period for a in cover for b in cover}) == period:
                    return cover
    root = isqrt(period - 1) + 1
    return tuple(sorted({*range(root), *range(root - 1, period, root), period - 1}))


@dataclass
class Group:
    """Texts one after another: their sizes, where each begins, and two 64-bit hashes per word."""

    sizes: np.ndarray
    first: np.ndarray
    words: np.ndarray


class Anchors:
    """The cover's positions and the hashes of anchors and windows of one width."""

    def __init__(self, width: int):
        self.width = width
        self.period = (width + 1) // 2
        self.size = width - self.period + 1
        self.cover = np.array(difference_cover(self.period))
        rng = np.random.default_rng(1729)
        self.factors = rng.integers(1, 1 << 63, (width, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def groups(self, texts: pa.Array) -> Iterator[Group]:
        """The texts in groups of about ``GROUP`` words; a longer text is a group of its own."""
        held, size = [], 0
        for t in texts:
            words = words_of(t.as_py() or "")
            if held and size + len(words) > GROUP:
                yield self._group(held)
                held, size = [], 0
            held.append(words)
            size += len(words)
        if held:
            yield self._group(held)

    @staticmethod
    def _group(each: list[list[bytes]]) -> Group:
        sizes = np.array([len(words) for words in each], np.int64)
        digests = b"".join(_digest(w) for words in each for w in words)
        return Group(sizes, np.cumsum(sizes) - sizes, np.frombuffer(digests, "<u8").reshape(-1, 2))

    def at_cover(self, group: Group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in the group, hash) of the anchors of texts with a window, in order."""
        n = np.where(group.sizes >= self.width, group.sizes - self.size + 1, 0)
        owner = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        chosen = np.isin(np.arange(self.period), self.cover)[inside % self.period]
        owner, place = owner[chosen], (group.first[owner] + inside)[chosen]
        total = np.zeros(len(place), np.uint64)
        lane = group.words[:, 0]
        for k in range(self.size):
            total += lane[place + k] * self.factors[k, 0]
        return owner, place, mix(total)

    def windows_around(self, group: Group, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start in the text, two hashes) of the windows that hold an anchor at one of the places."""
        first, sizes = group.first[owner], group.sizes[owner]
        change = np.zeros(len(group.words) + 1, np.int32)
        change += np.bincount(np.maximum(place - (self.width - self.size), first), minlength=len(change)).astype(np.int32)
        change -= np.bincount(np.minimum(place + 1, first + sizes - self.width + 1), minlength=len(change)).astype(np.int32)
        start = np.flatnonzero(np.cumsum(change)[:-1])
        total = np.zeros((len(start), 2), np.uint64)
        for k in range(self.width):
            total += group.words[start + k] * self.factors[k]
        text = np.searchsorted(group.first, start, side="right") - 1
        # Texts without words begin where the next one does; the last of equal beginnings has the words.
        return text, start - group.first[text], mix(total)


def _annotated(function, kind: str):
    names = function.__code__.co_varnames[: function.__code__.co_argcount]
    function.__annotations__ = dict.fromkeys(names, pa.Array) | {"return": pa.Array}
    return F.arrow_udf(function, kind)


def _anchors_udf(width: int):
    def run(texts: pa.Array) -> pa.Array:
        of, found = Anchors(width), []
        for group in of.groups(texts):
            owner, _, hashes = of.at_cover(group)
            cuts = np.searchsorted(owner, np.arange(len(group.sizes) + 1))
            found += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.array(found, pa.list_(pa.int64()))

    return _annotated(run, "array<long>")


_WINDOW = pa.struct([("w1", pa.int64()), ("w2", pa.int32()), ("start", pa.int32())])
_WINDOWS = "array<struct<w1 long, w2 int, start int>>"


def _windows(texts: pa.Array, width: int, shared) -> pa.Array:
    """The windows around the anchors that ``shared(rows, hashes)`` marks; rows are in order."""
    of, parts, sizes, row = Anchors(width), [], [np.zeros(1, np.int64)], 0
    for group in of.groups(texts):
        owner, place, hashes = of.at_cover(group)
        marked = shared(row + owner, hashes.view(np.int64))
        text, start, two = of.windows_around(group, owner[marked], place[marked])
        parts.append((start, two))
        sizes.append(np.bincount(text, minlength=len(group.sizes)))
        row += len(group.sizes)
    start = np.concatenate([p[0] for p in parts] or [np.empty(0)]).astype(np.int32)
    two = np.concatenate([p[1] for p in parts] or [np.empty((0, 2), np.uint64)])
    w1, w2 = two[:, 0].copy().view(np.int64), two[:, 1].astype(np.uint32).view(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(w1), pa.array(w2), pa.array(start)], ["w1", "w2", "start"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), flat)


def candidate_windows(rows: DataFrame, width: int, few: int) -> DataFrame:
    """(doc_id, digest, w1, w2, start) of every window with an anchor that two or more rows hold."""
    anchors = _anchors_udf(width)
    each = rows.select(F.explode(anchors("text")).alias("h"))
    shared = each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(shared, "shared-anchors")
    n_shared = shared.count()
    if n_shared <= few:
        known = membership(shared, F.col("h"), filter_bits(n_shared, ANCHOR_BITS, ANCHOR_BITS_PER_KEY))

        def by_bitmap(texts: pa.Array) -> pa.Array:
            return _windows(texts, width, lambda rows, hashes: known(hashes))

        near = rows.withColumn("w", _annotated(by_bitmap, _WINDOWS)("text"))
    else:
        # Beyond a bitmap's reach: each text's own anchors among the shared ones, by a join.
        own = rows.select("doc_id", "digest", F.explode(anchors("text")).alias("h"))
        met = join_by_counts(own, shared, "h", "n", shared.agg(F.sum("n")).first()[0])
        lists = met.groupBy("doc_id", "digest").agg(F.collect_set("h").alias("known"))

        def by_list(texts: pa.Array, known: pa.Array) -> pa.Array:
            lists = [k.values.to_numpy(zero_copy_only=False) for k in known]

            def shared(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
                cuts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1], [True]])) if len(rows) else []
                parts = [np.isin(hashes[a:b], lists[rows[a]]) for a, b in zip(cuts, cuts[1:], strict=False)]
                return np.concatenate([*parts, np.empty(0, bool)])

            return _windows(texts, width, shared)

        joined = rows.dropDuplicates(["doc_id", "digest"]).join(lists, ["doc_id", "digest"])
        near = joined.withColumn("w", _annotated(by_list, _WINDOWS)("text", "known"))
    return near.select("doc_id", "digest", F.explode("w").alias("w")).select("doc_id", "digest", "w.*")


def copied_rows(named: DataFrame) -> DataFrame:
    """(doc_id, digest) of the rows whose text a row of a smaller id has too."""
    texts = named.select("doc_id", "digest", F.unhex(F.md5("text")).alias("cls"))
    classes = texts.groupBy("cls").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    copied = materialize(classes.filter("first_doc < last_doc").drop("last_doc"), "copied-texts")
    total = copied.agg(F.sum("n")).first()[0] or 0
    maybe = texts.filter(may_be_in(copied, "cls")(F.xxhash64("cls")))
    hit = join_by_counts(maybe, copied, "cls", "n", total).filter("doc_id > first_doc")
    return materialize(hit.select("doc_id", "digest").distinct(), "copied-rows")


def _rewritten_udf(width: int):
    kinds = [("clean_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())]

    def run(texts: pa.Array, starts: pa.Array, copies: pa.Array) -> pa.Array:
        rows = []
        for t, s, copy in zip(texts, starts, copies, strict=True):
            words = kept = words_of(t.as_py() or "")
            if copy.as_py() and len(words) >= width:
                kept = []
            elif s.is_valid:
                change = np.zeros(len(words) + 1, np.int64)
                at = np.unique(s.values.to_numpy(zero_copy_only=False))
                change[at] += 1
                change[at + width] -= 1
                kept = [words[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
            rows.append((b" ".join(kept).decode("utf-8", "surrogatepass"), len(words), len(words) - len(kept)))
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    return _annotated(run, "clean_text string, n_words long, n_removed long")


def remove_repeated(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", few: int = FEW) -> DataFrame:
    """(doc_id, clean_text, n_words, n_removed) per row; clean_text holds the kept words joined by one blank."""
    # The digest tells rows of one id apart.
    digest = F.pmod(F.xxhash64("text"), F.lit((1 << 31) - 1)).cast("int").alias("digest")
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).select("doc_id", "text", digest)
    named = rows.filter("doc_id is not null and text is not null")
    key = F.xxhash64("doc_id", "digest")

    copies = copied_rows(named)
    maybe_copy = may_be_in(copies, "doc_id", "digest")(key)
    others = materialize(named.filter(maybe_copy).join(copies, ["doc_id", "digest"], "left_anti"), "taken-for-copies")
    firsts = named.filter(~maybe_copy).unionByName(others)

    found = materialize(candidate_windows(firsts, width, few), "candidate-windows")
    windows = found.groupBy("w1", "w2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )
    repeated = materialize(windows.filter("first_doc < last_doc").drop("last_doc"), "repeated-windows")
    maybe = found.filter(may_be_in(repeated, "w1")(F.xxhash64("w1")))
    total = repeated.agg(F.sum("n")).first()[0] or 0
    hit = join_by_counts(maybe, repeated, ["w1", "w2"], "n", total).filter("doc_id > first_doc")
    gone = hit.groupBy("doc_id", "digest").agg(F.collect_set("start").alias("gone")).withColumn("copy", F.lit(False))
    lost = gone.unionByName(copies.withColumn("gone", F.lit(None).cast("array<int>")).withColumn("copy", F.lit(True)))
    lost = materialize(lost, "rows-that-lose")

    concerned = F.coalesce(may_be_in(lost, "doc_id", "digest")(key) & F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.lit(False))
    some = rows.filter(concerned).join(lost, ["doc_id", "digest"], "left").select("doc_id", "text", "gone", "copy")
    none = F.lit(None).cast("array<int>").alias("gone"), F.lit(False).alias("copy")
    every = some.unionAll(rows.filter(~concerned).select("doc_id", "text", *none))
    return every.select("doc_id", _rewritten_udf(width)("text", "gone", "copy").alias("r")).select("doc_id", "r.*")
