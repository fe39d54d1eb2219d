"""Exact length histogram: documents by encoded length, suffix sums for every context limit.

``length_histogram`` counts documents by length; ``with_suffix_sums`` adds, for each length L that
occurs, how many documents and tokens have at least L and what is left of all tokens when every
document is cut at L. ``at_limits`` and ``quantiles`` answer from that table alone.

A null or empty text has length 0 (plus the end token if asked for). Rows count as often as they
occur; ties share a row of the histogram. An empty table gives an empty histogram. Groups (a column
such as ``lang``) may be null and then form a group of their own.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.tokens import encoder

BLOCK = 4096  # lengths per block of the two-level suffix sums


def length_udf(vocabulary: str, end_tokens: int = 0):
    def run(texts: pa.Array) -> pa.Array:
        ids = encoder(vocabulary).ids
        return pa.array([len(ids(t.as_py())) + end_tokens for t in texts], pa.int64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "long")


def length_histogram(
    docs: DataFrame, vocabulary: str, group: Column | None = None, text: str = "text", end_tokens: int = 0
) -> DataFrame:
    """(grp, n_tokens, docs): each task counts its own lengths before anything is shuffled."""
    grp = F.lit(None).cast("string") if group is None else group.cast("string")
    lengths = docs.select(grp.alias("grp"), length_udf(vocabulary, end_tokens)(docs[text]).alias("n_tokens"))
    return lengths.groupBy("grp", "n_tokens").agg(F.count("*").alias("docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per (grp, n_tokens): docs_at_least, tokens_at_least, truncated_total.

    Sums run inside blocks of ``BLOCK`` lengths, then over the blocks, so no window holds more than
    the blocks of a group or the lengths of a block.
    """
    cells = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("docs") * F.col("n_tokens")
    )
    sums = [F.sum(c).alias(f"block_{c}") for c in ("docs", "tokens")]
    later = Window.partitionBy("grp").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("grp")
    blocks = cells.groupBy("grp", "block").agg(*sums)
    blocks = blocks.select(
        F.col("grp").alias("g"),
        F.col("block").alias("b"),
        *(F.coalesce(F.sum(f"block_{c}").over(later), F.lit(0)).alias(f"later_{c}") for c in ("docs", "tokens")),
        F.sum("block_tokens").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("grp", "block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    joined = cells.join(blocks, cells["grp"].eqNullSafe(blocks["g"]) & (cells["block"] == blocks["b"]))
    out = joined.select(
        "grp",
        "n_tokens",
        "docs",
        (F.sum("docs").over(inside) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("later_tokens")).alias("tokens_at_least"),
        "total_tokens",
    )
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return out.withColumn("truncated_total", cut)


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(grp, context, over_docs, kept_tokens, total_tokens) for any context limits, exact between lengths too.

    The first length above a limit carries what is needed; without one nothing is cut.
    """
    sums = sums.select("grp", "n_tokens", "docs_at_least", "tokens_at_least", "total_tokens")
    at = sums.select("*", F.explode(F.array(*map(F.lit, limits))).alias("context"))
    first = F.when(F.col("n_tokens") > F.col("context"), F.struct("n_tokens", "docs_at_least", "tokens_at_least"))
    least = at.groupBy("grp", "context").agg(F.min(first).alias("f"), F.max("total_tokens").alias("total_tokens"))
    over = F.coalesce("f.docs_at_least", F.lit(0))
    kept = F.col("total_tokens") - F.coalesce("f.tokens_at_least", F.lit(0)) + F.col("context") * over
    return least.select("grp", "context", over.alias("over_docs"), kept.alias("kept_tokens"), "total_tokens")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(grp, share, n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    n = sums.groupBy("grp").agg(F.max("docs_at_least").alias("n"))
    s, t = sums.alias("s"), n.alias("t")
    up_to = F.col("n") - F.col("docs_at_least") + F.col("docs")
    at = s.join(t, F.col("s.grp").eqNullSafe(F.col("t.grp"))).select(
        "s.grp", "n_tokens", "n", up_to.alias("up_to"), F.explode(F.array(*map(F.lit, shares))).alias("share")
    )
    enough = at.filter(F.col("up_to") >= F.col("share") * F.col("n"))
    return enough.groupBy("grp", "share").agg(F.min("n_tokens").alias("n_tokens"))
