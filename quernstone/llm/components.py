"""Connected components of a table of links, as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links`` (a, b: long).

    In each round a node takes the smallest of itself and its neighbours (combined in each task
    before the shuffle), then that node's choice; the links are rewritten to the choices, and those
    inside one choice are dropped. So links vanish fast, and rounds end when none is left. Each round
    is written, so a lost executor repeats one round at most.
    """
    nodes = None
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
    links = materialize(links.distinct(), "links")
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        choice = materialize(least.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "choices")
        further = choice.select(F.col("node").alias("label"), F.col("label").alias("further"))
        choice = choice.join(further, "label").select("node", F.col("further").alias("label"))
        choice = materialize(choice, "choices")
        if nodes is None:
            nodes = choice
        else:
            later = choice.select(F.col("node").alias("label"), F.col("label").alias("later"))
            nodes = nodes.join(later, "label", "left").select("node", F.coalesce("later", "label").alias("label"))
            nodes = materialize(nodes, "labels")
        for end in ("a", "b"):
            named = choice.select(F.col("node").alias(end), F.col("label").alias(f"to_{end}"))
            links = links.join(named, end)
        links = links.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).filter("a != b")
        links = materialize(links.distinct(), "links")
        if links.isEmpty():
            return nodes
