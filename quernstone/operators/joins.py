"""Joins that keep their balance when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Below this many rows no key can be hot enough to matter.
HOT_ROWS = 100_000
# A key is hot when it holds more than 1/HOT_SHARE of the rows, so fewer than HOT_SHARE keys are.
HOT_SHARE = 1000


def hot_keys(facts: DataFrame, key: str, min_rows: int = HOT_ROWS) -> dict:
    """Keys with more than 1/HOT_SHARE of the rows, with the number of such shares each holds.

    There are fewer than HOT_SHARE of them.
    """
    total = facts.count()
    if total <= min_rows:
        return {}
    bar = max(min_rows, total // HOT_SHARE)
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > bar)
    return {row[0]: -(-row[1] // bar) for row in counts.select(key, "count").collect()}


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join a written table with a lookup of few rows per key.

    Rows of a hot key are spread over as many salts as it holds hot shares, and its lookup rows are
    repeated for each; all other keys join plainly.
    """
    hot = hot_keys(facts, key, min_rows)
    if not hot:
        return facts.join(lookup, key, how)
    pairs = [part for name, n in hot.items() for part in (F.lit(name), F.lit(n))]
    salts = F.coalesce(F.element_at(F.create_map(*pairs), F.col(key)), F.lit(1))
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), salts).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def placed_by(df: DataFrame, key: str) -> DataFrame:
    """Place rows by a unique key over all shuffle partitions.

    For work that is heavy per row: the number of partitions is kept even where the rows are
    small, and aggregations and joins on the key that follow need no further shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
