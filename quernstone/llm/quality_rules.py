"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much.

Lines are the parts between ``\\n``. A line without a word is kept and judged by no rule. A line
fails by the first rule that holds, in this order:

- ``symbols``: more characters of ``[#*$%&<>]`` than words;
- ``navigation``: two or more ``|`` and at most five words per part between them;
- ``stutter``: eight words or more, at least 40 % of them equal to the word before;
- ``shouting``: three words or more, and as many ``!`` as words or twice as many ``A-Z`` as ``a-z``;
- ``boilerplate``: at most twelve words, with one of ``PHRASES`` (A-Z lower-cased);
- ``letters``: no letter at all;
- ``punctuation``: fewer than three words and no closing punctuation at the end.

A document is rejected when its base checks fail (fewer than 10 words, or over 20 % of its words in
5-word windows found twice) or when the failing lines held more than ``max_lost`` of the characters
of its lines with words.

Null and empty texts count 0 everywhere and fail by their number of words; the cleaned text of a
null text is null. Each row is judged by itself, so repeated rows, ties and null ids change
nothing. Columns of the input with the names of results are replaced.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import BLANKS, text_udf, words_of

# Characters and phrases the rules look for.
SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = "#*$%&<>"
CLOSING = ".!?:;…\"')]»”’"
PHRASES = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign in",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
)
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
MAX_LOST = 0.3  # of the characters of lines with words
WINDOW = 5

_LOWER = {c: c + 32 for c in range(65, 91)}


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words lying in a window of ``window`` words that occurs twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    # Grow n-grams a word at a time; only positions whose shorter gram repeats can repeat themselves.
    # A gram keeps its number below the number of words, so number * words + word is unique.
    at, gram = np.arange(n), ids[:n]
    for step in range(window):
        if step:
            gram = gram * len(words) + ids[at + step]
        _, gram, counts = np.unique(gram, return_inverse=True, return_counts=True)
        twice = counts[gram] > 1
        at, gram = at[twice], gram[twice]
        if not len(at):
            return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_rule(line: str, words: list[bytes]) -> str | None:
    """The rule by which a line with words fails."""
    n_words = len(words)
    if sum(map(line.count, LINE_SYMBOLS)) > n_words:
        return "symbols"
    bars = line.count("|")
    if bars >= 2 and n_words <= 5 * (bars + 1):
        return "navigation"
    if n_words >= 8 and 10 * sum(map(eq, words, words[1:])) >= 4 * n_words:
        return "stutter"
    if n_words >= 3:
        if line.count("!") >= n_words:
            return "shouting"
        data = np.frombuffer(line.encode("utf-8", "surrogatepass"), np.uint8)
        upper = np.count_nonzero((data >= 65) & (data <= 90))
        if upper and upper >= 2 * np.count_nonzero((data >= 97) & (data <= 122)):
            return "shouting"
    if n_words <= 12:
        low = line.translate(_LOWER)
        if any(p in low for p in PHRASES):
            return "boilerplate"
    if not any(map(str.isalpha, line)):
        return "letters"
    if n_words < 3 and line.rstrip(BLANKS)[-1:] not in CLOSING:
        return "punctuation"
    return None


def judge(text: str | None, max_lost: float = MAX_LOST) -> tuple:
    """Counts, verdict and cleaned text of one document."""
    if text is None:
        return 0, 0, 0, 0, 0, 0, 0, 0, 0, True, False, None
    words = words_of(text)
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    n_symbols = sum(map(text.count, SYMBOLS))
    repeated = repeat_words(words)
    seen: set[str] = set()
    kept, n_lines, n_dup, n_failed, chars, lost = [], 0, 0, 0, 0, 0
    for line in text.split("\n"):
        in_line = words_of(line)
        if not in_line:
            kept.append(line)
            continue
        n_lines += 1
        n_dup += line in seen
        seen.add(line)
        chars += len(line)
        if line_rule(line, in_line):
            n_failed += 1
            lost += len(line)
        else:
            kept.append(line)
    base_failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED * n_words
    keep = not base_failed and lost <= max_lost * chars
    clean = "\n".join(kept) if n_failed else text
    return n_words, word_chars, n_symbols, n_dup, repeated, n_lines, n_failed, chars, lost, base_failed, keep, clean


_FIELDS = [
    *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    *((n, pa.int64()) for n in ("n_lines", "n_failed_lines", "line_chars", "lost_chars")),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("clean_text", pa.string()),
]
_SCHEMA = ", ".join(f"{n} {'boolean' if k == pa.bool_() else 'string' if k == pa.string() else 'long'}" for n, k in _FIELDS)


def apply_rules(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``kept`` and ``clean_text``; one scan, no shuffle."""
    run = text_udf(lambda t: judge(t, max_lost), _FIELDS, _SCHEMA)
    names = {n for n, _ in _FIELDS}
    kept = [docs[f"`{c}`"] for c in docs.columns if c not in names]
    judged = docs.select(*kept, run(docs[text]).alias("__judged"))
    return judged.select(*[c for c in judged.columns if c != "__judged"], "__judged.*")


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text and its length; columns as in ``documents``."""
    judged = apply_rules(docs).filter("kept")
    named = {"text": F.col("clean_text"), "n_chars": F.char_length("clean_text").cast("long")}
    return judged.select(*(named[c].alias(c) if c in named else F.col(c) for c in docs.columns))
