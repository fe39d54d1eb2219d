"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each to the shared folder
and gives the next what it reads back. All but the last return the columns of ``documents``.

- Documents the quality rules reject go, and so do the failing lines of the others.
- Line dedup takes repeated chunks out of texts; it removes no document.
- Of each group of near duplicates one document stays, the one with the smallest id. Rows without an
  id are kept; of rows equal in id and text one stays.
- Documents holding a benchmark item go.
- What is left is packed; a text left empty is an end token alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from quernstone.llm.common import materialize, read_table, release_filters, small_batches
from quernstone.llm.queries import CONTEXT, END_TOKEN, vocabulary


def _begin(spark: SparkSession) -> None:
    small_batches(spark)
    release_filters()  # what earlier stages have broadcast


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return quality_rules.clean_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return line_dedup.clean_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return near_dedup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return packing.pack(docs, vocabulary(), CONTEXT, END_TOKEN)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# The tokenizer and the min-max hashes cannot be written in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
