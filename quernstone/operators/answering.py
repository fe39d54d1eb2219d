"""Answering prompts: an offline extractive reader, user models, routing and response parsing."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text as tx
from quernstone.operators.joins import placed_by, salted_join
from quernstone.sources.scratch import materialize

UNKNOWN = "I do not know."
BUCKETS = 100


def answer_extractive(df: DataFrame, unknown: str = UNKNOWN) -> DataFrame:
    """Add ``result`` and ``abstained``: the sentence of the documents closest to the question.

    A sentence scores the idf of the question terms it holds over the root of its number of
    distinct terms; ties go to the better ranked document, then to the earlier sentence. Needs
    ``source_documents`` and ``q_weights``.
    """

    def rate(found: Column) -> Column:
        shared = F.filter("q_weights", lambda w: F.array_contains(found, w["term"]))
        total = F.aggregate(shared, F.lit(0.0), lambda s, w: s + w["idf"])
        return F.round(total / F.sqrt(F.size(found)), 6)

    def candidates(doc: Column) -> Column:
        worded = F.transform(
            tx.sentences(doc["page_content"]),
            lambda s, i: F.struct(s.alias("text"), tx.terms(s).alias("found"), i.alias("at")),
        )
        return F.transform(
            F.filter(worded, lambda s: F.size(s["found"]) > 0),
            lambda s: F.struct(
                rate(s["found"]).alias("score"),
                (-doc["rank"]).alias("rank"),
                (-s["at"]).alias("at"),
                s["text"].alias("text"),
            ),
        )

    best = F.array_max(F.flatten(F.transform("source_documents", candidates)))
    answered = F.coalesce(F.col("_best.score") > 0, F.lit(False))
    return (
        df.withColumn("_best", best)
        .withColumns(
            {
                "result": F.when(answered, F.col("_best.text")).otherwise(F.lit(unknown)),
                "abstained": ~answered,
            }
        )
        .drop("_best")
    )


Predict = Callable[[list[str], Mapping], Sequence[str]]
_ANSWER = "prompt_key string, result string, latency double, error string"


def _asked(distinct: DataFrame, predict: Predict, params: Mapping, concurrency: int | None) -> DataFrame:
    """``prompt_key, result, latency, error`` of ``distinct(prompt_key, prompt)``, one call per Arrow batch."""

    def ask(texts: list[str]) -> pd.DataFrame:
        began = time.perf_counter()
        try:
            answers, errors = list(predict(texts, params)), [None] * len(texts)
            if len(answers) != len(texts):
                raise ValueError("model returned another number of answers")
        except Exception as failure:
            if len(texts) > 1:
                return pd.concat([ask([t]) for t in texts], ignore_index=True)
            answers, errors = [None], [f"{type(failure).__name__}: {failure}"]
        spent = (time.perf_counter() - began) / len(texts)
        return pd.DataFrame({"result": answers, "latency": spent, "error": errors})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                made = ask(batch["prompt"].tolist())
                yield pd.concat([batch[["prompt_key"]].reset_index(drop=True), made], axis=1)

    # A stated number of tasks, else as many as the session shuffles to: small prompts would
    # otherwise be gathered into one task, however slow the model is.
    dealt = distinct.repartition(concurrency, "prompt_key") if concurrency else placed_by(distinct, "prompt_key")
    return dealt.mapInPandas(run, _ANSWER)


def answer_with(
    prompts: DataFrame,
    predict: Predict,
    params: Mapping | None = None,
    max_tokens: int | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """Add ``result, latency, error`` from a user's model.

    ``predict(prompts, params)`` gets one Arrow batch of prompts. Each distinct prompt is asked
    once and its answer written before it is joined back, so a lost executor repeats its own
    batches only. If a batch fails its prompts are tried one by one and failures land in
    ``error``. ``latency`` is the wall-clock time of the call over its number of prompts.
    """
    keyed = materialize(
        prompts.withColumn("prompt_key", F.md5(F.coalesce("prompt", F.lit("")))), "prompts"
    )
    distinct = keyed.groupBy("prompt_key").agg(F.first("prompt").alias("prompt"))
    answers = materialize(_asked(distinct, predict, dict(params or {}), concurrency), "answers")
    if max_tokens is not None:
        answers = answers.withColumn("result", cut_tokens(F.col("result"), max_tokens))
    return salted_join(keyed, answers, "prompt_key").drop("prompt_key")


class AnswerStore:
    """Answers kept under ``path`` by a hash of model, parameters and prompt.

    Every finished slice of a run is a folder that is written whole, so a run that breaks off loses
    the slice it was in. Failed prompts are not kept; the next run asks them again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """``prompt_key, result, latency, error``, one row per key."""
        try:
            stored = self.spark.read.schema(_ANSWER).option("recursiveFileLookup", "true").parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _ANSWER)
        # Two runs at once may have asked the same prompt.
        return stored.where("error is null").dropDuplicates(["prompt_key"])

    def add(self, answers: DataFrame) -> DataFrame:
        return materialize(answers, "slice", f"{self.path}/{uuid.uuid4().hex}")


def answer_resumed(
    prompts: DataFrame,
    predict: Predict,
    store: AnswerStore,
    model: str,
    params: Mapping | None = None,
    slice_rows: int = 10_000,
    concurrency: int | None = None,
) -> DataFrame:
    """Like ``answer_with``, but prompts whose answer is in ``store`` are not asked again.

    A null prompt is asked as an empty one. The others are asked in slices of about ``slice_rows`` distinct prompts, each kept when it is
    done. Adds ``result, latency, error, reused``; ``reused`` tells answers of earlier runs.
    """
    params = dict(params or {})
    asked_as = F.lit(f"{model}\n{json.dumps(params, sort_keys=True)}\n")
    key = F.sha2(F.concat(asked_as, F.coalesce("prompt", F.lit(""))), 256)
    keyed = materialize(prompts.withColumn("prompt_key", key), "prompts")
    distinct = keyed.groupBy("prompt_key").agg(F.first(F.coalesce("prompt", F.lit(""))).alias("prompt"))
    known = store.read().select("prompt_key")
    todo = materialize(distinct.join(known, "prompt_key", "left_anti"), "not-yet-asked")
    slices = max(1, -(-todo.count() // slice_rows))
    place = F.pmod(F.xxhash64("prompt_key"), F.lit(slices))
    made = [store.add(_asked(todo.where(place == n), predict, params, concurrency)) for n in range(slices)]
    fresh = reduce(DataFrame.unionAll, made).withColumn("reused", F.lit(False))
    earlier = store.read().join(todo.select("prompt_key"), "prompt_key", "left_anti").withColumn("reused", F.lit(True))
    return salted_join(keyed, fresh.unionByName(earlier), "prompt_key").drop("prompt_key")


def cut_tokens(text: Column, max_tokens: int) -> Column:
    """The text up to the end of its last token allowed; nulls and short texts stay as they are."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?s).*?[\p{L}\p{N}]+"), F.lit(0))
    return F.when(F.size(pieces) > max_tokens, F.array_join(F.slice(pieces, 1, max_tokens), "")).otherwise(text)


def answered(df: DataFrame, question: str = "questions", context: str = "context") -> DataFrame:
    """Add ``supported``: whether the context holds any term of the question at all."""
    shared = F.arrays_overlap(tx.terms(question), tx.terms(F.coalesce(context, F.lit(""))))
    return df.withColumn("supported", F.coalesce(shared, F.lit(False)))


def abstain_report(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.sum(F.col("abstained").cast("long")).alias("abstained"),
        F.round(F.avg(F.col("abstained").cast("double")), 6).alias("abstain_rate"),
        F.round(F.avg((~F.col("supported")).cast("double")), 6).alias("unsupported_rate"),
    )


def route(questions: DataFrame, routes: Mapping[str, int], key: str = "qid") -> DataFrame:
    """Add ``model``: a fixed share of the keys for each served model, by percentage."""
    if any(pct < 0 for pct in routes.values()) or sum(routes.values()) != BUCKETS:
        raise ValueError("percentages must not be negative and must sum to 100")
    if any(name != name.strip() or not name for name in routes):
        raise ValueError("model names must not be empty or start or end with a blank")
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    bucket = F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(BUCKETS))
    edges, low = [], 0
    for name, pct in routes.items():
        edges.append(((bucket >= low) & (bucket < low + pct), name))
        low += pct
    chosen = F.coalesce(*[F.when(hit, F.lit(name)) for hit, name in edges])
    return questions.withColumns({"bucket": bucket, "model": chosen})


def route_stable(questions: DataFrame, routes: Mapping[str, float], key: str = "qid") -> DataFrame:
    """Add ``model`` by weighted rendezvous hashing (Thaler and Ravishankar, 1998).

    Every model gives a key a number, the logarithm of a uniform hash over its weight; the largest
    wins. A model's number does not depend on the others, so a change of weights, a new model or one
    less moves only the share of keys that it must.
    """
    if not routes or any(not (weight >= 0) for weight in routes.values()) or not any(routes.values()):
        raise ValueError("weights must not be negative, and one must be positive")
    found = []
    for name, weight in routes.items():
        if weight > 0:
            digest = F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(name))), 1, 8)
            uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 32)
            found.append(F.struct((F.log(uniform) / float(weight)).alias("score"), F.lit(name).alias("model")))
    return questions.withColumn("model", F.array_max(F.array(*found))["model"])


def parse_response(df: DataFrame, json_col: str) -> DataFrame:
    """Add ``content``: the first choice's message, null where the response is malformed."""
    return df.withColumn("content", F.get_json_object(json_col, "$.choices[0].message.content"))


def parse_report(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("responses"),
        F.sum(F.col("content").isNull().cast("long")).alias("malformed"),
    )
