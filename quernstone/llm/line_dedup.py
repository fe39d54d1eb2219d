"""Content-defined line chunks; chunks that repeat anywhere in the corpus stay once.

A text is cut between lines (parts between ``\\n``), by what stands in the lines nearby only:

- *Edges.* For each two neighbouring lines the occurrences of this pair in all texts are counted. Where
  that count is at most half of the pair's before or behind it, a repeated passage begins or ends, and
  a boundary stands there. So a passage is cut out of each document alike, whatever surrounds it.
- A line of ``PASSAGE`` words or more is a chunk of its own. Pairs with such a line count as once.
- *Rolling hash.* Elsewhere a rolling hash over the hashes of the last ``WINDOW`` lines puts a boundary after a
  line where it is divisible by ``DIVISOR``, but not between two equal lines, and not where it would leave one
  line alone: next to a boundary above, or behind a line that has one already.
- A run without a boundary is cut after every ``MOST`` lines; one line left over stays with those before.

A chunk counts as removable if it has two lines or more, or ``PASSAGE`` words, and ``MIN_WORDS``
words. Removable chunks are grouped by their bytes; of those occurring twice or more, the first
occurrence inside the document with the smallest doc_id stays, all others go.

How it runs: pairs of lines, and long lines, are counted by 64-bit hashes (equal hashes of others could only
add a boundary). Counts above one come back to the texts that hold them; all other texts stay where they
are. A chunk can only repeat if all its pairs, or its one long line, do, so no other chunk is moved.
Every task groups its own chunk texts before the shuffle, so a chunk that a third of
all documents share arrives once per task. Occurrences then travel as 128-bit keys only; a key that
two different texts share removes nothing. What goes from a document is listed by its id and the
hash of its text; texts that lose something are joined with the list.

- Null texts stay null, empty texts stay empty; neither has chunks. Lines without words count as
  lines and have no words.
- Rows equal in id and text are treated alike: if their document is the first to hold a chunk, each
  of them keeps it. Rows without an id come after all others and are treated like one document.
- An empty table gives an empty result. Columns of the input named like results are replaced.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import join_by_counts, materialize, may_be_in, words_of

WINDOW = 2
BASE = 31
PRIME = 2**31 - 1
DIVISOR = 3
MOST = 16
PASSAGE = 50
MIN_WORDS = 10


def _digest(text: str) -> bytes:
    return md5(text.encode("utf-8", "surrogatepass")).digest()


def _is_long(line: str) -> bool:
    if len(line) < 2 * PASSAGE - 1:
        return False
    return len(line.encode("utf-8", "surrogatepass").split(None, PASSAGE - 1)) == PASSAGE


def marks_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lines and 64-bit hashes of what must repeat for a chunk to do so: each two neighbouring short lines, each long line."""
    if not text:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    lines = text.split("\n")
    long = np.array([_is_long(line) for line in lines])
    hashes = np.frombuffer(b"".join(_digest(line)[:8] for line in lines), np.uint64)
    marks = hashes * np.uint64(0x9E3779B97F4A7C15)
    marks[:-1] ^= np.where(long[:-1], np.uint64(0), hashes[1:] >> np.uint64(1))
    marks *= np.uint64(0xBF58476D1CE4E5B9)
    counted = long.copy()
    counted[:-1] |= ~long[:-1] & ~long[1:]
    at = np.flatnonzero(counted)
    return at.astype(np.int32), marks[at].view(np.int64)


def chunks(text: str | None, counts: dict[int, int] | None = None) -> list[tuple[int, int, int]]:
    """(first line, number of lines, number of words) of each chunk.

    ``counts`` has, by line, the occurrences of what ``marks_of`` gives for it, where these are more than one.
    """
    if not text:
        return []
    lines = text.split("\n")
    n = len(lines)
    sizes = [len(words_of(line)) for line in lines]
    long = [size >= PASSAGE for size in sizes]
    hashes = [int.from_bytes(_digest(line)[:4], "big") >> 4 for line in lines]
    seen = [1] * (n - 1)
    for at, times in (counts or {}).items():
        if not long[at]:
            seen[at] = times

    # fixed[i + 1], hashed[i + 1]: a boundary behind line i; the text begins behind line -1.
    fixed, hashed = [True] * (n + 1), [False] * (n + 1)
    for i in range(n - 1):
        beside = max(seen[i - 1] if i else 0, seen[i + 1] if i + 2 < n else 0)
        fixed[i + 1] = long[i] or long[i + 1] or 2 * seen[i] <= beside
    for i in range(n - 1):
        if not (fixed[i] or fixed[i + 1] or fixed[i + 2]) and lines[i] != lines[i + 1]:
            rolled = 0
            for h in hashes[max(0, i + 1 - WINDOW) : i + 1]:
                rolled = (rolled * BASE + h) % PRIME
            hashed[i + 1] = rolled % DIVISOR == 0

    out, first = [], 0
    for i in range(n):
        if fixed[i + 1] or (hashed[i + 1] and not hashed[i]):
            # Runs of over MOST lines in parts, the last of them of 2 to MOST + 1 lines.
            while i + 1 - first > MOST + 1:
                out.append((first, MOST, sum(sizes[first : first + MOST])))
                first += MOST
            out.append((first, i + 1 - first, sum(sizes[first : i + 1])))
            first = i + 1
    return out


def removable(n_lines: int, n_words: int) -> bool:
    return n_words >= PASSAGE or (n_lines >= 2 and n_words >= MIN_WORDS)


def _counts(marks: list[dict] | None) -> dict[int, int]:
    return {m["line"]: m["times"] for m in marks or []}


def _candidates(text: str | None, marks: list[dict] | None) -> list[tuple[int, str]]:
    """Number and text of the chunks that may repeat: removable, all that ``marks_of`` gives for them met elsewhere."""
    lines, counts = text.split("\n") if text else [], _counts(marks)
    return [
        (k, "\n".join(lines[at : at + n]))
        for k, (at, n, w) in enumerate(chunks(text, counts))
        if removable(n, w) and all(i in counts for i in range(at, at + max(1, n - 1)))
    ]


def _marks_of(texts: pa.Array) -> pa.Array:
    found = [marks_of(t.as_py()) for t in texts]
    ends = np.cumsum([0, *(len(lines) for lines, _ in found)]).astype(np.int32)
    lines = np.concatenate([np.empty(0, np.int32), *(lines for lines, _ in found)])
    marks = np.concatenate([np.empty(0, np.int64), *(marks for _, marks in found)])
    flat = pa.StructArray.from_arrays([pa.array(lines), pa.array(marks)], ["line", "mark"])
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _texts_of(texts: pa.Array, marks: pa.Array) -> pa.Array:
    rows = zip(texts, marks, strict=True)
    return pa.array([[c for _, c in _candidates(t.as_py(), m.as_py())] for t, m in rows], pa.list_(pa.string()))


def _keys_of(texts: pa.Array, marks: pa.Array) -> pa.Array:
    """Per text: chunk number, md5 of its bytes, whether it is the first such chunk of the text."""
    out = []
    for t, m in zip(texts, marks, strict=True):
        seen, rows = set(), []
        for k, chunk in _candidates(t.as_py(), m.as_py()):
            key = _digest(chunk)
            rows.append({"chunk": k, "key": key, "first": key not in seen})
            seen.add(key)
        out.append(rows)
    kind = pa.list_(pa.struct([("chunk", pa.int32()), ("key", pa.binary()), ("first", pa.bool_())]))
    return pa.array(out, kind)


def rewrite(text: str | None, counts: dict[int, int], gone: list[int]) -> tuple:
    """The text without some chunks, with its numbers of lines, chunks, chunks and lines gone."""
    if text is None:
        return None, 0, 0, 0, 0
    lines, parts = text.split("\n"), chunks(text, counts)
    drop = set(gone)
    kept = [line for k, (at, n, _) in enumerate(parts) if k not in drop for line in lines[at : at + n]]
    n_lines = len(lines) if text else 0
    left = len(kept) if text else 0
    return "\n".join(kept), n_lines, len(parts), len(drop), n_lines - left


def _rewritten(texts: pa.Array, marks: pa.Array, gone: pa.Array) -> pa.Array:
    rows = [rewrite(t.as_py(), _counts(m.as_py()), g.as_py() or []) for t, m, g in zip(texts, marks, gone, strict=True)]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.string(), *[pa.int64()] * 4)
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(_RESULTS))


_RESULTS = ("clean_text", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")
for _f in (_marks_of, _texts_of, _keys_of, _rewritten):
    _f.__annotations__ = {n: pa.Array for n in _f.__code__.co_varnames[: _f.__code__.co_argcount]} | {"return": pa.Array}


def _with_list(rows: DataFrame, lists: DataFrame, name: str, text: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the list their id and text have in ``lists``, or null: rows that may have one, the others."""
    other = lists.select(F.col("doc_id").alias("other_id"), F.col("digest").alias("other_digest"), name)
    digest = F.xxhash64(text)
    concerned = may_be_in(lists, "doc_id", "digest")(F.xxhash64(F.col("doc_id"), digest))
    some = rows.filter(concerned)
    same = some["doc_id"].eqNullSafe(other["other_id"]) & (digest == other["other_digest"])
    joined = some.join(other, same, "left").select(*rows.columns, name)
    return joined, rows.filter(~concerned).withColumn(name, F.lit(None).cast(lists.schema[name].dataType))


def _unrolled(rows: DataFrame) -> DataFrame:
    """One row per entry ``one`` of the lists ``all``, next to the other columns.

    What else is made of the text is made before, so that no text travels with each of its lines; and for
    ``explode`` itself Spark would first ask each list whether it is empty, and so make it twice.
    """
    others = [c for c in rows.columns if c != "all"]
    return rows.select(*others, F.explode_outer("all").alias("one")).filter("one is not null")


def _marked(rows: DataFrame, text: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``marks``, what repeats in their text with its counts: rows that may have any, the others."""
    marks = F.arrow_udf(_marks_of, "array<struct<line int, mark long>>")
    every = _unrolled(rows.select("doc_id", F.xxhash64(text).alias("digest"), marks(text).alias("all")))
    every = every.select("doc_id", "digest", "one.*")
    repeated = every.groupBy("mark").agg(F.count("*").alias("times")).filter("times > 1")
    repeated = materialize(repeated, "repeated-marks")
    found = every.filter(may_be_in(repeated, "mark")(F.xxhash64("mark")))
    found = materialize(found, "marks-met")
    hit = join_by_counts(found, repeated, "mark", "times", found.count())
    listed = hit.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("line", "times")).alias("marks"))
    some, others = _with_list(rows, materialize(listed, "marks-by-text"), "marks", text)
    return materialize(some, "marked-rows"), others


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``clean_text`` and the counts of lines and chunks, in all and removed."""
    texts = F.arrow_udf(_texts_of, "array<string>")
    keys = F.arrow_udf(_keys_of, "array<struct<chunk int, key binary, first boolean>>")
    rewritten = F.arrow_udf(
        _rewritten, "clean_text string, n_lines long, n_chunks long, n_removed_chunks long, n_removed_lines long"
    )
    # The input's own columns travel inside one, so that no name of theirs can clash.
    of_row = F.col("row").getField
    rows = docs.select(docs[doc_id].alias("doc_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    marked, others = _marked(rows, of_row(text))

    # The byte comparison: grouping by the chunk itself. The other rows have no chunk that repeats.
    spelled = _unrolled(marked.select("doc_id", texts(of_row(text), "marks").alias("all"))).withColumnRenamed("one", "chunk")
    groups = spelled.groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")
    repeated = groups.select(F.unhex(F.md5("chunk")).alias("key"), "n", "first_doc")
    repeated = repeated.groupBy("key").agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"), F.count("*").alias("texts"))
    repeated = materialize(repeated.filter("texts = 1").drop("texts"), "repeated-chunks")

    digest = F.xxhash64(of_row(text)).alias("digest")
    found = marked.select("doc_id", digest, keys(of_row(text), "marks").alias("all"))
    found = materialize(_unrolled(found).select("doc_id", "digest", "one.*"), "chunk-keys")
    hit = join_by_counts(found, repeated, "key", "n", found.count())
    stays = F.col("doc_id").eqNullSafe(F.col("first_doc")) & F.col("first")
    gone = hit.filter(~stays).groupBy("doc_id", "digest").agg(F.collect_set("chunk").alias("gone"))
    some, whole = _with_list(marked, materialize(gone, "chunks-gone"), "gone", of_row(text))
    out = some.unionAll(whole).unionAll(others.withColumn("gone", F.lit(None).cast("array<int>"))).select("row", rewritten(of_row(text), "marks", "gone").alias("out"))
    kept = [of_row(c).alias(c) for c in docs.columns if c not in _RESULTS]
    return out.select(*kept, *(F.col("out").getField(c).alias(c) for c in _RESULTS))


def clean_documents(docs: DataFrame) -> DataFrame:
    """Every document with its cleaned text and its length; columns as in ``documents``."""
    cleaned = remove_repeated(docs)
    named = {"text": F.col("clean_text"), "n_chars": F.char_length("clean_text").cast("long")}
    return cleaned.select(*(named[c].alias(c) if c in named else F.col(f"`{c}`") for c in docs.columns))
