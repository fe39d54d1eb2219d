"""Versions of a table: immutable folders, and a one-row commit that makes each of them visible.

A writer first writes all rows to a folder of its own, then the commit of the next version, which
names that folder. A reader takes the newest commit, or a version it names, and reads that folder
only: it sees one whole version, whatever is written meanwhile, and goes on seeing it. A writer whose
version number was taken by another one fails and leaves the table as it is; so does one that is
lost before its commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.operators.changes import change_feed

_COMMIT = "version long, folder string, fields string, row_count long"


class VersionConflict(RuntimeError):
    """Another writer has committed the version this one was based on."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> DataFrame:
        """``version, folder, fields, row_count`` of every committed version."""
        try:
            # Each commit is a folder of its own; the number inside is what counts.
            found = self.spark.read.schema(_COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")
            found.head(1)
            return found
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def newest(self) -> int | None:
        return self.versions().agg(F.max("version")).first()[0]

    def write(self, df: DataFrame, based_on: int | None = None) -> int:
        """Write a whole version and return its number, one above ``based_on`` (the newest, if not given)."""
        newest = self.newest()
        if based_on is not None and based_on != newest:
            raise VersionConflict(f"based on version {based_on}, the newest is {newest}")
        number = 0 if newest is None else newest + 1
        folder = f"rows-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        n = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()
        commit = self.spark.createDataFrame([(number, folder, df.schema.json(), n)], _COMMIT).coalesce(1)
        try:
            commit.write.mode("errorifexists").parquet(f"{self.path}/commits/{number:020d}")
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise VersionConflict(f"version {number} was committed meanwhile") from taken
        return number

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (of the newest, if not given)."""
        at = self.newest() if version is None else version
        found = self.versions().where(F.col("version") == F.lit(at)).head(1)
        if not found:
            raise ValueError(f"no version {at}")
        kind = T.StructType.fromJson(json.loads(found[0].fields))
        return self.spark.read.schema(kind).parquet(f"{self.path}/{found[0].folder}")

    def changes(self, old: int, new: int, key: str, payload: Sequence[str] | None = None) -> DataFrame:
        """``key, change``: what turns version ``old`` into version ``new``, whichever came first."""
        return change_feed(self.read(old), self.read(new), key, payload)
