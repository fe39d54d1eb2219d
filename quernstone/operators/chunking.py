"""Splitting documents into chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quernstone.functions import text as tx
from quernstone.functions.keys import pair_key

SIZE = 512
OVERLAP = 32
TEXTS_AT_ONCE = 256


def window_pieces(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the one before.

    The text is cut once into strides, and a window is put together from neighbouring strides, so
    the work grows linearly with the text.
    """
    stride = size - overlap
    if stride < 1:
        raise ValueError("overlap must be smaller than size")
    beyond = F.ceil((F.char_length(text) - size) / stride).cast("int")
    last = F.when(text.isNotNull(), F.greatest(F.lit(0), beyond))
    reach = -(-size // stride)
    return tx.bind(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0)),
        lambda strides: F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.substring(F.array_join(F.slice(strides, i + 1, reach), ""), 1, size),
        ),
    )


def _merge(text: str, sep: str, size: int, overlap: int, split_long: bool) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    width = 0  # length of the held pieces when joined

    def emit() -> None:
        joined = sep.join(held).strip(" \t\r\n")
        if joined:
            out.append(joined)

    stride = size - overlap
    for piece in text.split(sep):
        if not piece:
            continue
        if split_long and len(piece) > size:
            emit()
            held, width = [], 0
            cuts = range(0, max(1, -(-(len(piece) - size) // stride) + 1))
            out.extend(piece[c * stride : c * stride + size] for c in cuts)
            continue
        if held and width + len(sep) + len(piece) > size:
            emit()
            first = 0
            while first < len(held) and (
                width > overlap or width + len(sep) + len(piece) > size
            ):
                width -= len(held[first]) + (len(sep) if first + 1 < len(held) else 0)
                first += 1
            held = held[first:]
        width += len(piece) + (len(sep) if held else 0)
        held.append(piece)
    emit()
    return out


def _pieces_of(docs: DataFrame, key: str, text_col: str, cut: Callable[[str], list], schema: str) -> DataFrame:
    """``key, chunk_no`` and the fields of each piece that ``cut`` makes of a text; null texts have none.

    Few texts at a time are Python strings, whatever the size of the Arrow batches.
    """
    kind = docs.schema[key].dataType.simpleString()
    fields = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(low, TEXTS_AT_ONCE)
                made = [[] if t is None else cut(t) for t in some.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(made)), [len(m) for m in made])
                if not len(owner):
                    continue
                number = np.concatenate([np.arange(len(m), dtype=np.int32) for m in made])
                flat = [piece for m in made for piece in m]
                columns = [[p[n] for p in flat] for n in range(len(fields))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(owner)), pa.array(number), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    [key, "chunk_no", *fields],
                )

    types = [f.type for f in to_arrow_schema(T.StructType.fromDDL(schema))]
    return docs.select(key, text_col).mapInArrow(run, f"`{key}` {kind}, chunk_no int, {schema}")


def chunk(
    docs: DataFrame,
    size: int = SIZE,
    overlap: int = OVERLAP,
    sep: str = "\n\n",
    mode: str = "merge",
    oversize: str = "keep",
    key: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Chunks ``key, chunk_no, page_content`` of every document.

    ``mode='merge'`` packs the pieces between separators; a piece longer than ``size`` stays
    whole under ``oversize='keep'`` and is cut into windows under ``'split'``.
    ``mode='window'`` cuts fixed windows.
    """
    if mode == "window":
        pieces = window_pieces(F.col(text_col), size, overlap)
    elif mode == "merge":
        if oversize not in ("keep", "split"):
            raise ValueError("oversize is 'keep' or 'split'")
        if overlap > size:
            raise ValueError("overlap must not be larger than size")

        # The packing depends on everything before it in the same document: one linear pass per document.
        def pack(text: str) -> list[tuple[str]]:
            return [(piece,) for piece in _merge(text, sep, size, overlap, oversize == "split")]

        return _pieces_of(docs, key, text_col, pack, "page_content string")
    else:
        raise ValueError("mode is 'merge' or 'window'")
    return docs.select(key, F.posexplode(pieces).alias("chunk_no", "page_content"))


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


def token_pieces(text: str, path: str, size: int, overlap: int) -> list[tuple[int, str, int]]:
    """(first character, piece, ids) of windows of at most ``size`` ids.

    Edges lie between tokens that share no character. A piece that has more ids alone than in its
    text ends at an earlier edge.
    """
    encode = _tokenizer(path).encode
    offsets = np.array(encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
    ends = np.concatenate([[0], np.maximum.accumulate(offsets[:, 1])])
    inner = np.flatnonzero(offsets[1:, 0] >= ends[1:-1]) + 1
    edges = np.concatenate([[0], inner, [len(offsets)]]) if len(offsets) else np.zeros(2, np.int64)
    at = np.concatenate([[0], ends[inner], [len(text)]])
    out, low, last = [], 0, len(edges) - 1
    while True:
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + size, side="right")) - 1)
        piece = text[at[low] : at[high]]
        n = len(encode(piece, add_special_tokens=False).ids)
        while n > size and high > low + 1:
            high = max(low + 1, high - max(1, n - size))
            piece = text[at[low] : at[high]]
            n = len(encode(piece, add_special_tokens=False).ids)
        out.append((int(at[low]), piece, n))
        if high == last:
            return out
        low = max(low + 1, int(np.searchsorted(edges, edges[high] - overlap, side="right")) - 1)


def chunk_tokens(
    docs: DataFrame,
    tokenizer: str,
    size: int = SIZE,
    overlap: int = OVERLAP,
    key: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Chunks ``key, chunk_no, page_content, start_char, n_ids`` of at most ``size`` ids of a model's tokenizer.

    ``tokenizer`` names a tokenizer file that every worker can read. A chunk begins ``overlap`` ids
    before the end of the one before, or at the edge before that; without overlap the chunks
    joined are the text. Null texts have no chunks, an empty text has an empty one.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")

    def cut(text: str) -> list[tuple[int, str, int]]:
        return token_pieces(text, tokenizer, size, overlap)

    made = _pieces_of(docs, key, text_col, cut, "start_char long, page_content string, n_ids int")
    return made.select(key, "chunk_no", "page_content", "start_char", "n_ids")


def with_chunk_id(chunks: DataFrame, key: str = "doc_id", numeric: bool = True) -> DataFrame:
    """Add the long primary key ``id``, the same under any partitioning."""
    if not numeric:
        return chunks.withColumn("id", F.xxhash64(key, "chunk_no"))
    return chunks.withColumn("id", pair_key(key, "chunk_no"))


def chunk_table(chunks: DataFrame, kind: str = "Document") -> DataFrame:
    """The saved shape of chunks: ``page_content, type, id``."""
    return chunks.select("page_content", F.lit(kind).alias("type"), "id")


def window_guard(chunks: DataFrame, max_tokens: int = 512) -> DataFrame:
    """Flag chunks longer than a model's token window and add the part the model reads."""
    found = tx.tokens("page_content")
    return chunks.withColumns(
        {
            "n_tokens": F.size(found),
            "over_window": F.size(found) > max_tokens,
            "model_input": F.array_join(F.slice(found, 1, max_tokens), " "),
        }
    )


def window_report(guarded: DataFrame) -> DataFrame:
    return guarded.agg(
        F.count("*").alias("chunks"),
        F.sum(F.col("over_window").cast("long")).alias("truncated"),
        F.round(F.avg(F.col("over_window").cast("double")), 6).alias("truncated_share"),
    )
