"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at
least ``max(LEAST, 2 * q)`` words that no neighbouring word extends keeping the period.

- The dictionary names the factors of every power-of-two length: a factor of length 2f is the pair of
  the names of its halves. Only factors that occur again in their text get a name, so a level
  without a repetition ends the dictionary, and levels above the first are small in ordinary prose.
- Occurrences of a factor of length f that follow each other at most f / 2 apart form an arithmetic
  progression. From the last member of each progression every successor at least f and less than 2f
  words on proposes its distance as a period. Each run with f <= q < 2f is proposed so: either some
  factor of the run has no period of f / 2 and is a progression of its own, or the last
  factor of the run's first period ends a progression.
- Proposals of one period at neighbouring words belong to one run; the first of them is extended to
  both sides by the dictionary, one comparison of names per level. Equal stretches are one run, of
  the smallest period proposed.

Words are compared by a dictionary of their bytes, not by hashes. Texts are handled in groups of about
``GROUP`` words, each text on its own; a longer text makes a group alone, so memory is that of the
longest text: four bytes a word and level.

A null or empty text, or one without words, has no runs and an empty collapsed text. Rows are
handled one by one, so repeated rows, null ids and ties change nothing. An empty table gives an empty
result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import words_of

LEAST = 12
GROUP = 250_000  # words

RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """A number per word of texts lying one after another: equal for equal words of one text, -1 for words met once."""
    names, base = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        names += [base + seen.setdefault(w, len(seen)) for w in words]
        base += len(seen)
    found = np.array(names, np.int64)
    return _numbered(found, np.arange(len(found)), len(found))


def _numbered(keys: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Names of the keys that occur twice or more at their places, -1 elsewhere; one more place for the end."""
    out = np.full(n + 1, -1, np.int32)
    if len(keys):
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        names = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)
        out[places] = names[inverse]
    return out


def dictionary(names: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of length 1, 2, 4, ... at every place, as long as one is repeated."""
    levels, n = [names], len(names) - 1
    while True:
        last, f = levels[-1], 1 << (len(levels) - 1)
        at = np.flatnonzero(last[: max(0, n - f)] >= 0)
        at = at[last[at + f] >= 0]
        keys = last[at].astype(np.int64) << 32 | last[at + f]
        names = _numbered(keys, at, n)
        if not (names >= 0).any():
            return levels
        levels.append(names)


def proposals(names: np.ndarray, f: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that the factors of length ``f`` propose, one of each row of neighbours."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name = names[at]
    last = np.ones(len(at), bool)
    last[:-1] = (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > f)
    here, found = np.flatnonzero(last), []
    for step in range(1, len(at)):
        here = here[here + step < len(at)]
        apart = at[here + step] - at[here]
        near = (name[here + step] == name[here]) & (apart < 2 * f)
        here, apart = here[near], apart[near]
        if not len(here):
            break
        far = apart >= f
        found.append((apart[far], at[here[far]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    period, place = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((place, period))
    period, place = period[order], place[order]
    first = np.ones(len(place), bool)
    first[1:] = (period[1:] != period[:-1]) | (place[1:] != place[:-1] + 1)
    return place[first], period[first]


def extend(levels: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of the longest stretches around the places that keep the periods."""
    n = len(levels[0]) - 1
    right, left = place + period, place.copy()
    for k in reversed(range(len(levels))):
        names, f = levels[k], 1 << k
        same = names[np.minimum(right, n)]
        right = right + f * ((same >= 0) & (same == names[right - period]))
        same = np.where(left >= f, names[np.maximum(left - f, 0)], -1)
        left = left - f * ((same >= 0) & (same == names[left + period - f]))
    return left, right - left


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    levels = dictionary(word_names(texts))
    found = []
    for k, names in enumerate(levels):
        place, period = proposals(names, 1 << k)
        start, length = extend(levels, place, period)
        enough = length >= np.maximum(LEAST, 2 * period)
        found.append(np.stack([start, length, period], axis=1)[enough])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(first + sizes, runs[:, 0], side="right")
    runs[:, 0] -= first[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [runs[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    return [words[k] for k in kept]


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail in the documents that a checksum of the id chooses; no id, no tail."""
    h = crc32(doc_id.encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def find_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Callable[[str | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """(doc_id, runs, collapsed_text) per row; ``change`` may alter the words (of the id as text) first."""

    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        runs, kept, held, size = [], [], [], 0

        def done() -> None:
            for words, found in zip(held, runs_of(held), strict=True):
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()])
                kept.append(b" ".join(collapsed(words, found)).decode("utf-8", "surrogatepass"))

        for one, text in zip(ids, texts, strict=True):
            words = words_of(text.as_py() or "")
            if change is not None:
                words = change(one.as_py(), words)
            held.append(words)
            size += len(words)
            if size >= GROUP:
                done()
                held, size = [], 0
        done()
        return pa.StructArray.from_arrays([pa.array(runs, pa.list_(_RUN)), pa.array(kept, pa.string())], ["runs", "collapsed_text"])

    run.__annotations__ = {"ids": pa.Array, "texts": pa.Array, "return": pa.Array}
    described = F.arrow_udf(run, f"struct<runs: {RUNS}, collapsed_text: string>")(docs[doc_id].cast("string"), docs[text])
    return docs.select(docs[doc_id].alias("doc_id"), described.alias("r")).select("doc_id", "r.*")
