"""The registered queries of the dealt operators: one thin query each, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import (
    decontamination,
    language_id,
    language_model,
    line_dedup,
    near_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    whitening,
)
from quernstone.llm.common import documents, fold, materialize, read_table, small_batches

SHARD_BYTES = 128 << 20
END_TOKEN = 2
CONTEXT = 1024


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *base, "n_lines", "n_failed_lines", "line_chars", "lost_chars")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), SHARD_BYTES).withColumnRenamed("key", "doc_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality_classifier.train(quality_classifier.training_rows(docs, labels, ~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_classifier.score_udf(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.train(language_id.training_rows(docs, ~held_out))
    labelled = docs.select("doc_id", held_out.alias("held_out"), language_id.predict_udf(model)("text").alias("p"))
    return labelled.select("doc_id", "held_out", "p.*")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary(), CONTEXT, END_TOKEN)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_repeated(documents(spark, sf_dir))
    counts = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")
    clean = F.col("clean_text")
    return cleaned.select("doc_id", *counts, F.char_length(clean).cast("long").alias("clean_chars"), F.md5(clean).alias("clean_md5"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item found in it; a document without a row is clean."""
    docs, items = documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")
    return decontamination.find_passages(docs, items).withColumn("contaminated", F.lit(True))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(documents(spark, sf_dir), vocabulary(), F.col("lang"))
    return token_counts.with_suffix_sums(materialize(histogram, "length-histogram"))  # read twice


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(fold(F.col("doc_id"), 7) != 2, F.lit(False))
    scored = language_model.score_documents(documents(spark, sf_dir), learn)
    held_out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", held_out.alias("held_out"), *columns)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(documents(spark, sf_dir), change=periodic_runs.planted)
    # The longest, of those the first, of those the one of the smallest period.
    rank = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(rank)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    spelled = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.l) div (-best.p)").alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(read_table(small_batches(spark), sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeated(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("clean_text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_language_id": op4_language_id,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_language_model": op10_language_model,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_substring_dedup": op13_substring_dedup,
}
