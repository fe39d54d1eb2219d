"""Tables in and out: pages, evaluation sets, saved tables and saved evaluation runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions import text as tx
from quernstone.functions.keys import pair_key

EVAL_SCHEMA = T.StructType(
    [
        T.StructField("qid", T.LongType(), False),
        T.StructField("questions", T.StringType(), True),
        T.StructField("ground_truth", T.StringType(), True),
    ]
)
TURNS_PER_BLOCK = 1024


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_pages(pages: DataFrame) -> DataFrame:
    """Web pages as text documents with their metadata: ``page_id, url, title, text, metadata``."""
    html = F.col("html")
    title = tx.squeeze(
        tx.decode_entities(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1))
    )
    language = F.lower(F.regexp_extract(html, r'(?is)<html[^>]*\blang="([^"]*)"', 1))
    return pages.select(
        "page_id",
        "url",
        title.alias("title"),
        tx.markup_text(html).alias("text"),
        F.map_from_arrays(
            F.array(F.lit("source"), F.lit("title"), F.lit("language")),
            F.array(F.col("url"), title, language),
        ).alias("metadata"),
    )


def eval_set(
    rows: DataFrame | Iterable[tuple[str, str]],
    question: str = "questions",
    target: str = "ground_truth",
    qid: Column | str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """An evaluation set ``qid, questions, ground_truth``.

    ``rows`` is a table with a key (``qid``), or a short literal list of (question, answer) pairs.
    """
    if isinstance(rows, DataFrame):
        key = F.col(qid) if isinstance(qid, str) else (qid if qid is not None else F.col("qid"))
        return rows.select(
            key.cast("long").alias("qid"),
            F.col(question).alias("questions"),
            F.col(target).alias("ground_truth"),
        )
    spark = spark or SparkSession.getActiveSession()
    numbered = [(n, q, a) for n, (q, a) in enumerate(rows)]
    return spark.createDataFrame(numbered, EVAL_SCHEMA)


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn that directly follows it, as an evaluation set.

    The next turn is found inside blocks of turn numbers. Only the first rows of later blocks are
    ordered over a whole conversation, so a conversation that holds much of the table does not
    end up in one sort.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "block", F.floor(F.col("turn") / TURNS_PER_BLOCK)
    )
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn")
    paired = turns.withColumn("next", F.lead(F.struct("role", "text")).over(in_block))
    across = Window.partitionBy("conv_id").orderBy("block")
    # The first turn of a later block follows the last turn of the block before it.
    heads = (
        turns.where(F.col("turn") >= TURNS_PER_BLOCK)
        .groupBy("conv_id", "block")
        .agg(F.min(F.struct("turn", "role", "text")).alias("head"))
        .select(
            "conv_id",
            F.coalesce(F.lag("block").over(across), F.lit(0)).alias("block"),
            F.struct("head.role", "head.text").alias("after"),
        )
    )
    answer = F.coalesce("next", "after")
    return (
        paired.where("role = 'user'")
        .join(heads, ["conv_id", "block"], "left")
        .where(answer["role"] == "assistant")
        .select(
            pair_key("conv_id", "turn").alias("qid"),
            F.col("text").alias("questions"),
            answer["text"].alias("ground_truth"),
        )
    )


def save_table(df: DataFrame, name: str, evolve: bool = True, path: str | None = None) -> DataFrame:
    """Overwrite a table, creating its database first.

    With ``evolve`` the columns of the replaced table that ``df`` lacks stay in the schema, as
    nulls.
    """
    spark = df.sparkSession
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if evolve and spark.catalog.tableExists(name):
        old = spark.createDataFrame([], spark.table(name).schema)
        df = df.unionByName(old, allowMissingColumns=True)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def save_eval(results: Mapping[str, DataFrame], folder: str) -> None:
    """Store the tables of an evaluation (rows, metrics, runs), replacing only their own runs."""
    for name, df in results.items():
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(f"{folder.rstrip('/')}/{name}")
        )


def load_eval(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # run_id stays text even where all ids look like numbers
    path = f"{folder.rstrip('/')}/{name}"
    found = spark.read.parquet(path)
    typed = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "run_id" else f.dataType)
            for f in found.schema
        ]
    )
    return spark.read.schema(typed).parquet(path)
