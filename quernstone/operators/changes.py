"""Changes between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_feed(
    old: DataFrame, new: DataFrame, key: str, payload: Sequence[str] | None = None
) -> DataFrame:
    """``key, change``: rows to insert, update or delete to turn ``old`` into ``new``.

    Keys are unique on each side. Only a digest of the payload is shuffled.
    """
    columns = list(payload) if payload is not None else [c for c in new.columns if c != key]

    def digested(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key), F.md5(F.to_json(F.struct(*columns))).alias(name))

    change = (
        F.when(F.col("was").isNull(), "insert")
        .when(F.col("now").isNull(), "delete")
        .when(F.col("was") != F.col("now"), "update")
    )
    return (
        digested(old, "was")
        .join(digested(new, "now"), key, "full_outer")
        .select(key, change.alias("change"))
        .where("change is not null")
    )


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count("*").alias("n"))
