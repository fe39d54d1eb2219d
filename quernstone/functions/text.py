"""Text expressions. Every function maps columns to columns and stays inside the JVM.

The patterns use no look-around and no back-references, so the same text works in any engine
with linear-time regular expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_WORD = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"([.!?])[ \t\r]+"
VOWEL_GROUP = "[aeiouyáàâäãåéèêëíìîïóòôöõøúùûüýÿœæ]+"
BLANKS = r"[ \t\r\n\f]+"

# The entities the page reader decodes, in the order they are applied.
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
# Markup that is dropped together with its content, in the order it is dropped.
DROPPED_MARKUP = [
    r"(?is)<!--.*?-->",
    r"(?is)<script\b.*?</script[^>]*>",
    r"(?is)<style\b.*?</style[^>]*>",
    r"(?is)<head\b.*?</head[^>]*>",
    r"(?s)<[^>]*>",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Inside a lambda an outer expression would be computed again for every element.
    """
    return F.transform(F.array(value), body)[0]


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order; null text gives null."""
    return F.filter(F.split(F.lower(_col(text)), NON_WORD), lambda t: t != "")


def terms(text: Column | str) -> Column:
    """Distinct tokens in sorted order."""
    return F.array_sort(F.array_distinct(tokens(text)))


def sentences(text: Column | str) -> Column:
    """Sentences with their closing punctuation; a line end also closes a sentence."""
    marked = F.regexp_replace(_col(text), SENTENCE_END, "$1\n")
    return F.filter(
        F.transform(F.split(marked, r"\n+"), lambda s: F.btrim(s, F.lit(" \t\r"))),
        lambda s: s != "",
    )


def ngrams(items: Column, n: int) -> Column:
    """All runs of ``n`` consecutive items, each joined by a blank."""
    if n == 1:
        return items
    none = F.array().cast("array<int>")

    def runs(held: Column) -> Column:
        last = F.size(held) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(none)
        return F.transform(starts, lambda i: F.array_join(F.slice(held, i, n), " "))

    return bind(items, runs)


def decode_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def squeeze(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, BLANKS, " "))


def markup_text(html: Column | str) -> Column:
    """Visible text of a page: scripts, styles, head, comments and tags removed."""
    text = _col(html)
    for pattern in DROPPED_MARKUP:
        text = F.regexp_replace(text, pattern, " ")
    return squeeze(decode_entities(text))


def letters_and_digits(text: Column | str) -> Column:
    return F.char_length(F.regexp_replace(_col(text), NON_WORD, ""))


def syllables(text: Column | str) -> Column:
    return F.regexp_count(F.lower(_col(text)), F.lit(VOWEL_GROUP))
