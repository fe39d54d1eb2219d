"""Supervised subword embeddings: hashed word and n-gram vectors, averaged, with a softmax.

Each word has a vector, and so have each of its character n-grams (``GRAMS`` code points, over the
whole word, boundary marks included) and each pair of neighbouring words. All are hashed to one
table of ``BUCKETS`` vectors. A document is the average of these vectors over all its words, and
a softmax layer gives the probability of label 1. Table and layer are learned by plain stochastic
gradient descent in numpy, one document a step.

The table is linear up to the softmax, so a word adds a fixed amount to a document's logit. Workers
hash the words they meet for the first time together, as arrays, and remember their amounts (for
about ``KEPT`` words); a text is scored by sums over its words and pairs, in one scan without a shuffle.

Learning uses the whole texts of at most ``max_rows`` labelled documents, taken by hash order. This is
the only sample; every document is scored whole.

- A document with several labels counts by the smallest; labels without id or value are left out.
- Empty and null texts, and texts without words, have the average of nothing: their score is that
  of the softmax bias. If there is nothing to learn from, every score is 0.5.
- Repeated rows and null ids are scored like others; a null id is never held out. Ties in the hash
  order are broken by the id. Input columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import materialize, words_of
from quernstone.llm.shingles import mix

BUCKETS = 1 << 18
WIDTH = 16
GRAMS = (2, 3, 4)
EPOCHS = 4
RATE = 100.0  # of the table: a vector moves by its small share of the document
LAYER_RATE = 0.5
MAX_ROWS = 4000
KEPT = 300_000
STRETCH = 1 << 20  # code points hashed at a time

_FACTORS = np.random.default_rng(3).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of some words, and a hash per word.

    The words' code points lie one after another; n-grams that reach over an edge are left out.
    """
    marked = [f"<{w.decode('utf-8', 'surrogatepass')}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    spelled = np.zeros(len(words), np.uint64)
    np.add.at(spelled, owner, mix(points * _FACTORS[5] + place.astype(np.uint64) * _FACTORS[6]))
    spelled = mix(spelled)
    found = [(np.arange(len(words)), _buckets(spelled))]
    for n in GRAMS:
        for low in range(0, len(points) - n + 1, STRETCH):
            high = min(low + STRETCH, len(points) - n + 1)
            inside = owner[low:high] == owner[low + n - 1 : high + n - 1]
            total = np.full(high - low, n, np.uint64)
            for k in range(n):
                total += points[low + k : high + k] * _FACTORS[k]
            found.append((owner[low:high][inside], _buckets(mix(total[inside]))))
    owners, buckets = (np.concatenate(c) for c in zip(*found, strict=True))
    return owners, buckets, spelled


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of neighbours in a row of word hashes."""
    return _buckets(mix(hashes[:-1] * _FACTORS[0] + hashes[1:] * _FACTORS[1]))


@dataclass
class Model:
    """Per bucket the part of the logit that its vector gives, and the bias."""

    logit: np.ndarray
    bias: float
    _known: dict[bytes, int] = field(default_factory=dict)
    _values: np.ndarray = field(default_factory=lambda: np.empty(0))  # a word's part of the logit
    _counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # its features
    _hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))

    def _learn(self, words: list[bytes]) -> None:
        owners, buckets, hashes = word_features(words)
        at = len(self._known)
        self._known.update(zip(words, range(at, at + len(words)), strict=True))
        values = np.bincount(owners, self.logit[buckets].astype(np.float64), len(words))
        self._values = np.concatenate([self._values, values])
        self._counts = np.concatenate([self._counts, np.bincount(owners, minlength=len(words))])
        self._hashes = np.concatenate([self._hashes, hashes])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if len(self._known) > KEPT:
            self.__setstate__(self.__getstate__())
        each = [words_of(t) if t else [] for t in texts]
        new = {w for words in each for w in words}.difference(self._known)
        if new:
            self._learn(list(new))
        out = np.full(len(texts), self.bias)
        known = self._known
        for k, words in enumerate(each):
            if words:
                at = np.array([known[w] for w in words])
                total = self._values[at].sum() + self.logit[pair_buckets(self._hashes[at])].sum(dtype=np.float64)
                out[k] += total / (self._counts[at].sum() + len(words) - 1)
        return 1 / (1 + np.exp(-out))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])

    def __getstate__(self):
        return {"logit": self.logit, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(**state)


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> Model:
    """Fit on (buckets, weights of sum 1, label) rows, one document at a time in a shuffled order."""
    if not docs:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps = EPOCHS * len(docs)
    for step in range(steps):
        if step % len(docs) == 0:
            order = rng.permutation(len(docs))
        ids, weights, label = docs[order[step % len(docs)]]
        left = np.float32(1 - step / steps)
        hidden = weights @ table[ids]
        logits = hidden @ layer + bias
        p = np.exp(logits - logits.max())
        error = p / p.sum()
        error[label] -= 1
        back = layer @ error
        layer -= LAYER_RATE * left * np.outer(hidden, error)
        bias -= LAYER_RATE * left * error
        table[ids] -= RATE * left * weights[:, None] * back
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text and their weights, of sum 1."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    number: dict[bytes, int] = {}
    at = np.array([number.setdefault(w, len(number)) for w in words])
    owners, buckets, hashes = word_features(list(number))
    times = np.bincount(at)
    every = np.concatenate([buckets, pair_buckets(hashes[at])])
    weights = np.concatenate([times[owners], np.ones(len(at) - 1, np.int64)])
    total = np.bincount(every, weights, BUCKETS) if len(every) > BUCKETS else None
    if total is None:
        found, inverse = np.unique(every, return_inverse=True)
        counts = np.bincount(inverse, weights)
    else:
        found = np.flatnonzero(total)
        counts = total[found]
    return found.astype(np.int32), (counts / counts.sum()).astype(np.float32)


def _features(texts: pa.Array) -> pa.Array:
    rows = [document_features(t.as_py()) for t in texts]
    parts = [pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1)]
    return pa.StructArray.from_arrays(parts, ["ids", "weights"])


_features.__annotations__ = {"texts": pa.Array, "return": pa.Array}


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = MAX_ROWS) -> list[tuple]:
    """Features and label of at most ``max_rows`` documents; ``learn`` is a condition on doc_id."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    chosen = known.filter(learn).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = materialize(chosen, "chosen-labels")  # max_rows pairs of numbers: small enough to broadcast
    run = F.arrow_udf(_features, "ids binary, weights binary")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "label", F.xxhash64("text").alias("h"), run("text").alias("f"))
    # One row per document, and of several texts under an id the first by hash.
    first = rows.groupBy("doc_id", "label").agg(F.min_by("f", "h").alias("f")).select("doc_id", "label", "f.*")
    found = first.toArrow().sort_by("doc_id")  # max_rows rows of at most BUCKETS features
    columns = (found.column(c).to_pylist() for c in ("ids", "weights", "label"))
    return [(np.frombuffer(i, np.int32), np.frombuffer(w, np.float32), k) for i, w, k in zip(*columns, strict=True) if i]


def score_udf(model: Model):
    shared = {"model": model}

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(shared["model"].scores(texts.to_pylist()), pa.float64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double")
