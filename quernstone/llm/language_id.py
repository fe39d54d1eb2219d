"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes. One unit reads a window forwards, one backwards;
from both states at a byte a softmax layer labels that byte with a probability for every language.
A document's probabilities are the averages over all its bytes, and its language is the likeliest.
The network is trained in numpy by backpropagation through time.

Learning uses the whole texts of at most ``max_rows`` documents of known language, the same number of
each language as far as there are that many (by hash order), all their windows ``EPOCHS`` times.
This is the only sample; every byte of every text is labelled when documents are scored.

- ``und`` with score 0 stands for null texts and texts without a letter, or if nothing was learned.
- Rows are scored one by one, so repeated rows and null ids change nothing; a null id is never held
  out and never learned from. Ties between languages go to the first in order of their names.
- An empty table gives an empty result. Input columns other than id, text and language are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import has_letter, materialize
from quernstone.llm.gru import Adam, back, new_cell, run

WIDTH = 8
WINDOW = 128
MAX_ROWS = 1000
EPOCHS = 2
BATCH = 128
SPARE = 4  # documents of a language looked at for each one wanted
RATE = 0.02
TOGETHER = 2048  # windows labelled at a time
PAD = 256  # the symbol behind the end of a text


@dataclass
class Model:
    names: list[str]
    params: dict[str, np.ndarray]

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """(time, batch, language) for windows of symbols (time, batch)."""
        return _label(self.params, symbols)[0]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        some = [k for k, t in enumerate(texts) if t and self.names and has_letter(t)]
        data = [texts[k].encode("utf-8", "surrogatepass") for k in some]
        owners = np.repeat(np.arange(len(some)), [-(-len(d) // WINDOW) for d in data])
        rows = (d[at : at + WINDOW] for d in data for at in range(0, len(d), WINDOW))
        sums = np.zeros((len(some), len(self.names)))
        for low in range(0, len(owners), TOGETHER):
            part = [next(rows) for _ in range(min(TOGETHER, len(owners) - low))]
            sizes = np.array([len(p) for p in part])
            symbols = padded(part, WINDOW)
            labels = self.probabilities(symbols)
            labels *= (np.arange(WINDOW)[:, None] < sizes)[:, :, None]
            np.add.at(sums, owners[low : low + TOGETHER], labels.sum(axis=0))
        for k, total, d in zip(some, sums, data, strict=True):
            best = int(total.argmax())
            out[k] = self.names[best], min(1.0, float(total[best] / len(d)))
        return out


def padded(parts: list[bytes], size: int) -> np.ndarray:
    """Windows as symbols (time, batch)."""
    joined = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts), np.uint8).reshape(len(parts), size)
    symbols = joined.T.astype(np.int64)
    sizes = np.array([len(p) for p in parts])
    symbols[np.arange(size)[:, None] >= sizes] = PAD
    return symbols


def _label(params: dict, symbols: np.ndarray, keep: bool = False):
    zero = np.zeros((symbols.shape[1], WIDTH), np.float32)
    ahead, kept_a = run({"table": params["table_a"], "u": params["u_a"]}, symbols, zero, keep)
    behind, kept_b = run({"table": params["table_b"], "u": params["u_b"]}, symbols[::-1], zero, keep)
    logits = ahead.reshape(-1, WIDTH) @ params["out"][:WIDTH]
    logits += behind[::-1].reshape(-1, WIDTH) @ params["out"][WIDTH:]
    logits += params["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits.reshape(*symbols.shape, -1), ahead, behind, kept_a, kept_b


def train(rows: list[tuple[list[bytes], str]], seed: int = 3) -> Model:
    """Fit on (windows, language) rows."""
    names = sorted({name for _, name in rows})
    parts = [(p, names.index(name)) for windows, name in rows for p in windows if p]
    if not parts:
        return Model([], {})
    rng = np.random.default_rng(seed)
    a, b = new_cell(rng, 257, WIDTH), new_cell(rng, 257, WIDTH)
    params = {"table_a": a["table"], "u_a": a["u"], "table_b": b["table"], "u_b": b["u"]}
    params["out"] = rng.normal(0, 0.3, (2 * WIDTH, len(names))).astype(np.float32)
    params["bias"] = np.zeros(len(names), np.float32)
    adam = Adam(params, RATE)
    order = np.concatenate([rng.permutation(len(parts)) for _ in range(EPOCHS)])
    for low in range(0, len(order), BATCH):
        adam.rate = RATE * (1 - 0.9 * low / len(order))
        chosen = [parts[k] for k in order[low : low + BATCH]]
        symbols = padded([p for p, _ in chosen], WINDOW)
        labels = np.array([k for _, k in chosen])
        p, ahead, behind, kept_a, kept_b = _label(params, symbols, True)
        error = p.copy()
        error[:, np.arange(len(chosen)), labels] -= 1
        error *= (symbols != PAD)[:, :, None] / max(1, int((symbols != PAD).sum()))
        flat = error.reshape(-1, len(names)).astype(np.float32)
        gradients = {
            "out": np.concatenate([ahead.reshape(-1, WIDTH).T @ flat, behind[::-1].reshape(-1, WIDTH).T @ flat]),
            "bias": flat.sum(axis=0),
        }
        d_states = (flat @ params["out"].T).reshape(*symbols.shape, 2 * WIDTH)
        for name, read, kept, d in (("a", symbols, kept_a, d_states[..., :WIDTH]), ("b", symbols[::-1], kept_b, d_states[::-1, :, WIDTH:])):
            found = back({"table": params[f"table_{name}"], "u": params[f"u_{name}"]}, read, kept, d)
            gradients |= {f"table_{name}": found["table"], f"u_{name}": found["u"]}
        adam.step(gradients)
    return Model(names, params)


def _windows(texts: pa.Array) -> pa.Array:
    data = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
    return pa.array([[d[at : at + WINDOW] for at in range(0, len(d), WINDOW)] for d in data], pa.list_(pa.binary()))


_windows.__annotations__ = {"texts": pa.Array, "return": pa.Array}


def training_rows(docs: DataFrame, learn: Column, max_rows: int = MAX_ROWS) -> list[tuple[list[bytes], str]]:
    """Windows and language of at most ``max_rows`` documents; ``learn`` is a condition on doc_id."""
    known = docs.select("doc_id", F.col("lang").alias("name")).filter(learn & F.expr("doc_id is not null and lang is not null"))
    # Of each language only so many rows are ranked as its count says hold the first by hash, so a
    # language of most documents is no more work than the others.
    counts = known.groupBy("name").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(SPARE * max_rows)) / F.col("n"))
    known = known.withColumn("draw", F.xxhash64("doc_id")).join(F.broadcast(materialize(counts, "language-counts")), "name")
    known = known.filter((F.col("draw").cast("double") / float(1 << 63) + 1) / 2 <= share)
    order = Window.partitionBy("name").orderBy("draw", "doc_id")
    ranked = known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max_rows)
    chosen = ranked.orderBy("place", "name").limit(max_rows).groupBy("doc_id").agg(F.min("name").alias("name"))
    chosen = materialize(chosen, "chosen-languages")  # max_rows ids with their names: small enough to broadcast
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").filter("lang = name")
    windows = F.arrow_udf(_windows, "array<binary>")
    rows = rows.select("doc_id", "name", F.xxhash64("text").alias("h"), windows("text").alias("w"))
    first = rows.groupBy("doc_id").agg(F.min_by(F.struct("name", "w"), "h").alias("r")).collect()  # bounded in rows and bytes
    return [([bytes(w) for w in r.r.w], r.r.name) for r in sorted(first, key=lambda r: r.doc_id)]


def predict_udf(model: Model):
    def label(texts: pa.Array) -> pa.Array:
        found = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"]
        )

    label.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(label, "lang_pred string, score double")
