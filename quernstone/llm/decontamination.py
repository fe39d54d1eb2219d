"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index, exact similarity.

Words are runs of non-blank characters with A-Z lower-cased. A fingerprint has 64 bits: bit b is set
where more than half of a window's words have it set in their own hash.

- Every item gets a window size, the largest size of a geometric ladder below its number of words,
  and all its windows of that size are fingerprinted.
- Every text is fingerprinted at each size in use, at a step (a sixth of the size) small enough that
  a full copy of an item puts some window exactly on one of the item's windows.
- Fingerprints are cut into 4 blocks of 16 bits. Two that differ in at most ``RADIUS`` = 11 bits
  differ in at most 2 bits of some block, so looking every block up among the item blocks and their
  neighbours within 2 bits finds all pairs within the radius. Their full distance is then measured.
- What is within the radius is verified: the window of the item's length best placed around the hit
  must share 5-word shingles, counted as often as they occur: 100 * common >= 75 * union.

A text with fewer words than a window is one window. An item with fewer than five words has one
shingle, all its words; items without a word, or null, match nothing, and so do empty and null texts.
Equal items each report their matches, a repeated item row with the same id once. Rows of documents
are searched one by one: repeated rows and null ids are reported like any other row. Without items
or documents the result is empty. Extra columns are ignored.

Items are dealt to blocks of about ``ITEMS`` and at most ``ITEM_BYTES`` of text on average; the index
of a block is built once in each worker and every block sees every document, so a benchmark of any
size is searched with bounded memory. No text is shuffled.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.shingles import WIDTH, mix, shingle_hashes, word_hashes

SIMILAR = 75  # per cent
RADIUS = 11
BLOCKS, BLOCK_BITS = 4, 16
LADDER = 1.35
ITEMS = 1000
ITEM_BYTES = 4 << 20
STRETCH = 8192  # windows of a text fingerprinted at a time

_NEAR = np.array(
    [sum(1 << b for b in bits) for r in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), r)],
    np.uint64,
)


def step_of(size: int) -> int:
    return max(1, size // 6)


def window_size(n_words: int) -> int:
    """The largest rung with room for a whole step inside the item."""
    best, rung = 1, 1.0
    while True:
        rung = max(rung + 1, rung * LADDER)
        if int(rung) + step_of(int(rung)) - 1 > n_words:
            return min(best, n_words)
        best = int(rung)


def window_starts(sizes: np.ndarray, first: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of the windows of texts lying one after another; a text's last window ends with it."""
    room = np.maximum(sizes - size, 0)
    n = -(-room // step) + 1
    owner = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return first[owner] + np.minimum(nth * step, room[owner]), owner


def fingerprints(words: np.ndarray, windows: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Fingerprints of several lists of windows (starts in order, ends), a stretch of words at a time."""
    out = [np.empty(len(starts), np.uint64) for starts, _ in windows]
    longest = max((int((ends - starts).max()) for starts, ends in windows if len(starts)), default=0)
    for low in range(0, len(words), STRETCH):
        stretch = words[low : low + STRETCH + longest]
        bits = np.unpackbits(stretch.view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((len(bits) + 1, 64), np.int16 if longest < 1 << 14 else np.int64)  # differences survive overflow
        np.cumsum(bits, axis=0, dtype=sums.dtype, out=sums[1:])
        for (starts, ends), prints in zip(windows, out, strict=True):
            a, b = np.searchsorted(starts, (low, low + STRETCH))
            if a < b:
                half = ((ends[a:b] - starts[a:b]) // 2).astype(sums.dtype)
                more = sums[ends[a:b] - low] - sums[starts[a:b] - low] > half[:, None]
                prints[a:b] = np.packbits(more, axis=1).view(np.uint64)[:, 0]
    return out


class ItemIndex:
    """Items by window size, each size with its multi-index."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        self.ids, self.words, self.counts, by_size = [], [], [], {}
        for item, text in items:
            words = word_hashes(text)
            if not len(words):
                continue
            size = window_size(len(words))
            starts = np.arange(len(words) - size + 1)
            (prints,) = fingerprints(words, [(starts, starts + size)])
            k = len(self.ids)
            self.ids.append(item)
            self.words.append(len(words))
            self.counts.append(Counter(shingle_hashes(words).tolist()))
            by_size.setdefault(size, []).append((prints, np.full(len(prints), k), starts))
        self.tables = {size: self._table(*map(np.concatenate, zip(*rows, strict=True))) for size, rows in by_size.items()}

    @staticmethod
    def _table(prints: np.ndarray, item: np.ndarray, start: np.ndarray):
        blocks = []
        for b in range(BLOCKS):
            part = (prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
            value = (part[:, None] ^ _NEAR).ravel().astype(np.int64)
            owner = np.repeat(np.arange(len(prints)), len(_NEAR))
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1))
            blocks.append((first, owner[order]))
        return prints, item, start, blocks

    @staticmethod
    def near(table: tuple, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item window) within the radius."""
        own, _, _, blocks = table
        found = []
        for b, (first, owner) in enumerate(blocks):
            part = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            n = first[part + 1] - first[part]
            window = np.repeat(np.arange(len(prints)), n)
            at = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(len(window))
            mine = owner[at]
            close = np.bitwise_count(prints[window] ^ own[mine]) <= RADIUS
            found.append(window[close] * len(own) + mine[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(own), pairs % len(own)

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text (item_id, similarity in per cent, start word, words) of each item found, best place first."""
        each = [word_hashes(t) for t in texts]
        sizes = np.array([len(w) for w in each], np.int64)
        first = np.cumsum(sizes) - sizes
        some = np.flatnonzero(sizes)
        out: list[list[tuple]] = [[] for _ in texts]
        if not len(some) or not self.tables:
            return out
        windows, owners = [], []
        for size in self.tables:
            starts, owner = window_starts(sizes[some], first[some], size, step_of(size))
            owners.append(some[owner])
            windows.append((starts, starts + np.minimum(size, sizes[owners[-1]])))
        places: dict[tuple[int, int], set[int]] = {}
        prints = fingerprints(np.concatenate(each), windows)
        for table, (starts, _), owner, found in zip(self.tables.values(), windows, owners, prints, strict=True):
            _, item, start, _ = table
            for low in range(0, len(found), 4 * STRETCH):
                window, mine = self.near(table, found[low : low + 4 * STRETCH])
                window += low
                at = starts[window] - first[owner[window]] - start[mine]
                for key in zip(owner[window].tolist(), item[mine].tolist(), at.tolist(), strict=True):
                    places.setdefault(key[:2], set()).add(key[2])
        shingles: dict[int, list[int]] = {}
        for (t, k), around in sorted(places.items()):
            if t not in shingles:
                shingles = {t: shingle_hashes(each[t]).tolist()}
                anywhere = set(shingles[t])
            wanted, n_words = self.counts[k], len(each[t])
            n = min(self.words[k], n_words)
            best = (-1.0, 0, 0)
            # What the text has nowhere, no window has.
            if n < WIDTH or 100 * sum(c for h, c in wanted.items() if h in anywhere) >= SIMILAR * wanted.total():
                for at in sorted({min(max(0, a), n_words - n) for a in around}):
                    few = shingle_hashes(each[t][at : at + n]).tolist() if n < WIDTH else None
                    have = Counter(few or shingles[t][at : at + n - WIDTH + 1])
                    common = sum((have & wanted).values())
                    best = max(best, (100 * common / (have.total() + wanted.total() - common), -at, n))
            if best[0] >= SIMILAR:
                out[t].append((self.ids[k], best[0], -best[1], best[2]))
        return out


@lru_cache(maxsize=2)
def _index(items: tuple[tuple[int, str], ...]) -> ItemIndex:
    return ItemIndex(items)


_FOUND = [("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())]


def _search_udf(items: tuple[tuple[int, str], ...]):
    def run(texts: pa.Array) -> pa.Array:
        search = _index(items).search
        names = [n for n, _ in _FOUND]
        rows = [[dict(zip(names, hit, strict=True)) for hit in hits] for hits in search(texts.to_pylist())]
        return pa.array(rows, pa.list_(pa.struct(_FOUND)))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<item_id long, similarity double, start_word long, n_words long>>")


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text"):
    """The items in blocks of bounded size, one at a time."""
    named = items.select(items[item_id].cast("long").alias("item_id"), items[text].alias("text"))
    named = named.filter("item_id is not null and text is not null").distinct()
    n, size = named.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // ITEMS), -(-size // ITEM_BYTES))
    for block in range(blocks):
        rows = named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield tuple(sorted((r.item_id, r.text) for r in rows))


def find_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words) of every item found in every row of ``docs``."""
    out = None
    for block in item_blocks(items):
        hits = docs.select(docs[doc_id].alias("doc_id"), F.explode(_search_udf(block)(docs[text])).alias("h"))
        hits = hits.select("doc_id", "h.*")
        out = hits if out is None else out.unionAll(hits)
    if out is None:
        none = [F.lit(0).cast(t).alias(c) for c, t in (("item_id", "long"), ("similarity", "double"), ("start_word", "long"), ("n_words", "long"))]
        out = docs.select(docs[doc_id].alias("doc_id"), *none).limit(0)
    return out


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item is found; columns as in ``documents``."""
    for block in item_blocks(items):
        docs = docs.filter(F.size(_search_udf(block)(docs["text"])) == 0)
    return docs
