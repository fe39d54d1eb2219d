"""Written intermediate tables.

A result that several later steps read is written once to the shared folder the cluster names in
``spark.checkpoint.dir`` and read back. That cuts the lineage, survives the loss of executors and
gives later joins true sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

CODEC = "zstd"

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="quernstone-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, path: str | None = None, options: Mapping | None = None) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").options(compression=CODEC, **(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
