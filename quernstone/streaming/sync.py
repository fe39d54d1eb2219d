"""Tables kept in step with their source by triggered Structured Streaming.

``follow`` hands every micro-batch's changed documents to a function, each document as it came last.
``sync_index`` writes their rows to a folder per batch, so writing a batch again after a failure
replaces just that. Readers take every document from the last batch that touched it; a document
without chunks there is gone. ``compact`` writes the merged state as the first batch of a new index
folder. ``live`` keeps whole indexes in step the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.sources.scratch import materialize

# live documents, keys of all documents that arrived, number of the batch
Apply = Callable[[DataFrame, DataFrame, int], None]


def follow(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    apply: Apply,
    key: str = "doc_id",
    max_files: int | None = None,
) -> list[int]:
    """Hand all files that arrived at ``source`` since the last call to ``apply``, then stop.

    A document that arrived more than once counts as it came last: by the time of its file, then the
    file's name, then the row in it. One with a true ``deleted`` column is among the keys only.
    Returns the numbers of source rows per batch.
    """
    counts: list[int] = []
    at = F.col("_metadata")
    arrived = F.struct(at["file_modification_time"], at["file_path"], at["row_index"])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source).select("*", arrived.alias("_arrived"))

    def write(batch: DataFrame, number: int) -> None:
        batch = materialize(batch, "batch")
        counts.append(batch.count())
        last = F.max_by(F.struct(*schema.names), "_arrived").alias("last")
        docs = batch.groupBy(F.col(key).alias("_key")).agg(last).select("last.*")
        live = docs.where(~F.coalesce("deleted", F.lit(False))) if "deleted" in schema.names else docs
        apply(live, docs.select(key), number)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [n for n in counts if n]


def sync_index(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    index: Callable[[DataFrame], DataFrame],
    key: str = "doc_id",
    max_files: int | None = None,
) -> list[int]:
    """Index all files that arrived at ``source`` since the last call (see ``follow``).

    ``index`` turns documents into index rows that keep ``key``.
    """

    def write(live: DataFrame, touched: DataFrame, number: int) -> None:
        rows = materialize(index(live), "indexed")  # read twice below, made once
        empty = touched.join(rows.select(key).distinct(), key, "left_anti")
        rows.unionByName(empty, allowMissingColumns=True).write.mode("overwrite").parquet(
            f"{target}/batch={number}"
        )

    return follow(spark, source, schema, checkpoint, write, key, max_files)


def read_index(spark: SparkSession, target: str, key: str = "doc_id") -> DataFrame:
    """Current index rows, without the rows of replaced or removed documents."""
    stored = spark.read.parquet(target)
    last = stored.groupBy(key).agg(F.max("batch").alias("batch"))
    return stored.join(last, [key, "batch"]).where("id is not null").drop("batch")


def compact(spark: SparkSession, target: str, fresh: str, key: str = "doc_id") -> None:
    """Write the current rows to the new index folder ``fresh``."""
    read_index(spark, target, key).write.mode("overwrite").parquet(f"{fresh}/batch=0")
