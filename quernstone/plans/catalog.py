"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.operators import (
    answering,
    bm25,
    changes,
    chunking,
    codes,
    embedding,
    evaluation,
    judging,
    prompting,
    scoring,
    search,
    shaping,
    toxicity,
)
from quernstone.plans import rag
from quernstone.functions.keys import pair_key
from quernstone.sources import tables, versions
from quernstone.sources.scratch import materialize, scratch_path
from quernstone.streaming import live, sync

Query = Callable[[SparkSession, str], DataFrame]

K = 4
DIMENSIONS = embedding.DIMENSIONS
CELLS = 16
RECALL = 0.9
SURVIVORS = 40  # full vectors scored for a query
PROBE_QUERIES = 1000  # the queries that choose how many cells are visited
ROUTES = {"large": 60, "medium": 30, "small": 10}
ROUTES_LATER = {"large": 50, "medium": 30, "small": 10, "tiny": 10}
HISTORY = 8
SUMMARY_METRICS = (*evaluation.QA_METRICS, "faithfulness_lexical", "relevance_lexical")

# Saved tables by session and folder: an index is built once and serves all queries on it.
_saved: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _saved:
        _saved[key] = build()
    return _saved[key]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, sf_dir, "documents")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "chunks", lambda: rag.build_chunks(_docs(spark, sf_dir)))


def _index(spark: SparkSession, sf_dir: str) -> bm25.Bm25Index:
    return _once(spark, sf_dir, "bm25", lambda: bm25.build_bm25(_chunks(spark, sf_dir)))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.turn_pairs(tables.read_table(spark, sf_dir, "conversations"))


def _answers(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """Answers with their targets."""

    def build() -> DataFrame:
        pairs = _pairs(spark, sf_dir)
        answers = rag.answer_questions(pairs, _index(spark, sf_dir), k)
        return materialize(answers.join(pairs.select("qid", "ground_truth"), "qid"), "graded")

    return _once(spark, sf_dir, f"answers{k}", build)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding"
    )


def _vector_index(spark: SparkSession, sf_dir: str) -> search.VectorIndex:
    return _once(
        spark, sf_dir, "cells", lambda: search.build_index(_vectors(spark, sf_dir), CELLS)
    )


def _text_index(spark: SparkSession, sf_dir: str):
    return _once(
        spark,
        sf_dir,
        "text_vectors",
        lambda: rag.build_vectors(_chunks(spark, sf_dir), DIMENSIONS, CELLS),
    )


def rag_token_f1(spark, sf_dir):
    return rag.graded_answers(_pairs(spark, sf_dir), _index(spark, sf_dir), K)


def page_text(spark, sf_dir):
    loaded = tables.load_pages(rag.spread(tables.read_table(spark, sf_dir, "pages")))
    return loaded.select(
        "page_id",
        "url",
        "title",
        "text",
        F.col("metadata")["source"].alias("meta_source"),
        F.col("metadata")["language"].alias("meta_language"),
    )


def eval_pairs(spark, sf_dir):
    return tables.eval_set(_pairs(spark, sf_dir))


def chunk_window(spark, sf_dir):
    chunks = chunking.with_chunk_id(
        chunking.chunk(rag.spread(_docs(spark, sf_dir)), mode="window")
    )
    return chunking.chunk_table(chunks)


def chunk_merge(spark, sf_dir):
    return chunking.with_chunk_id(
        chunking.chunk(rag.spread(_docs(spark, sf_dir)), sep="\n", mode="merge")
    ).select("id", "doc_id", "chunk_no", "page_content")


def chunk_merge_split(spark, sf_dir):
    return chunking.with_chunk_id(
        chunking.chunk(rag.spread(_docs(spark, sf_dir)), sep="\n", oversize="split")
    ).select("id", "doc_id", "chunk_no", "page_content")


def token_chunks(spark, sf_dir):
    """Chunks that fit a model's window of 512 ids of its own tokenizer."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    chunks = chunking.with_chunk_id(chunking.chunk_tokens(rag.spread(_docs(spark, sf_dir)), path))
    return chunks.select("id", "doc_id", "chunk_no", "start_char", "n_ids", "page_content")


def window_guard(spark, sf_dir):
    whole = rag.spread(_docs(spark, sf_dir)).select("doc_id", F.col("text").alias("page_content"))
    return chunking.window_guard(whole).select("doc_id", "n_tokens", "over_window", "model_input")


def window_report(spark, sf_dir):
    return chunking.window_report(chunking.window_guard(_chunks(spark, sf_dir), 64))


def missing_names(spark, sf_dir):
    return shaping.missing_from(
        _docs(spark, sf_dir), tables.read_table(spark, sf_dir, "labels"), "doc_id"
    )


def knn_exact(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return search.knn_exact(vectors.withColumnRenamed("id", "qid"), vectors, K)


def knn_cells_exact(spark, sf_dir):
    asked = _vectors(spark, sf_dir).withColumnRenamed("id", "qid")
    return search.knn_cells(_vector_index(spark, sf_dir), asked, K, nprobe=4).drop("pairs")


def reopened_index(spark, sf_dir):
    """An index built once, opened from its folder alone and searched."""
    path = scratch_path(spark, "kept-index")
    for _ in range(2):
        index = search.build_if_absent(spark, path, lambda: _vectors(spark, sf_dir))
    asked = _vectors(spark, sf_dir).withColumnRenamed("id", "qid")
    return search.knn_cells(index, asked, K).drop("pairs")


def reopened_bm25(spark, sf_dir):
    path = scratch_path(spark, "kept-bm25")
    bm25.build_bm25(_chunks(spark, sf_dir), path=path)
    return bm25.bm25_search(bm25.open_bm25(spark, path), _pairs(spark, sf_dir), K).select(
        "qid", "rank", "id", "score"
    )


def knn_cells_recall(spark, sf_dir):
    """An index with the default number of cells, visited as far as a recall of ``RECALL`` needs."""
    vectors = _vectors(spark, sf_dir)
    asked, n = vectors.withColumnRenamed("id", "qid"), vectors.count()
    index = search.build_index(vectors)
    truth = materialize(search.knn_exact(asked, vectors, K), "neighbours")
    nprobe = max(1, index.cells.count() // 3)
    if n > PROBE_QUERIES:  # some queries choose, all of them confirm
        some = asked.where(F.pmod(F.xxhash64("qid"), F.lit(-(-n // PROBE_QUERIES))) == 0)
        nprobe = search.probes_for_recall(index, some, truth, K, RECALL, nprobe)
    nprobe = search.probes_for_recall(index, asked, truth, K, RECALL, nprobe)
    found = search.knn_cells(index, asked, K, nprobe=nprobe, exact=False)
    return search.recall_report(found, truth, n)


def knn_codes_recall(spark, sf_dir):
    """Every vector's neighbours by codes: recall, and the share of full vectors scored for it."""
    vectors = _vectors(spark, sf_dir)
    asked, n = vectors.withColumnRenamed("id", "qid"), vectors.count()
    index = codes.build_codes(vectors)
    truth = materialize(search.knn_exact(asked, vectors, K), "neighbours")
    found = codes.knn_codes(index, asked, K, nprobe=len(index.centres), survivors=SURVIVORS)
    return search.recall_report(found, truth, n)


def describe_index(spark, sf_dir):
    described = search.describe_index(_vector_index(spark, sf_dir))
    return described.select(
        "row_count", "min_dimensions", "max_dimensions", "null_keys", "repeated_keys", "cells"
    )


def embed_text(spark, sf_dir):
    """The dimensions of each text that are not zero."""
    chunks = _chunks(spark, sf_dir)
    model = embedding.fit_embedder(chunks, "page_content", DIMENSIONS)
    made = embedding.embed(chunks, "page_content", model, sparse=True)
    # For ``explode`` Spark would first ask each list whether it is empty, and so make it twice.
    cells = made.select("id", F.explode_outer("embedding").alias("entry")).where("entry is not null").select("id", "entry.*")
    return cells.select("id", "dimension", F.round(F.col("weight").cast("double"), 6).alias("weight"))


def similarity_search(spark, sf_dir):
    model, index = _text_index(spark, sf_dir)
    asked = embedding.embed(
        tables.read_table(spark, sf_dir, "benchmark").select(
            F.col("item_id").alias("qid"), F.col("text").alias("questions")
        ),
        "questions",
        model,
    )
    return search.similarity_search(index, asked, ("id", "page_content"), k=2)


def vector_retrieval(spark, sf_dir):
    model, index = _text_index(spark, sf_dir)
    found = rag.retrieve(_pairs(spark, sf_dir).select("qid", "questions"), index, K, model=model)
    return found.select("qid", F.explode("source_documents").alias("d")).select(
        "qid", "d.rank", "d.id", "d.page_content"
    )


def bm25_index_terms(spark, sf_dir):
    index = bm25.build_bm25(_chunks(spark, sf_dir))
    return index.terms.select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_topk(spark, sf_dir):
    return bm25.bm25_search(_index(spark, sf_dir), _pairs(spark, sf_dir), K).select(
        "qid", "rank", "id", "score"
    )


def project_mapped(spark, sf_dir):
    hits = bm25.bm25_search(_index(spark, sf_dir), _pairs(spark, sf_dir), 2)
    renamed = shaping.col_mapping(hits, {"inputs": "qid", "context": "page_content"})
    return shaping.project(renamed, ["inputs", "id", "context"])


def stuffed_prompt(spark, sf_dir):
    asked = _pairs(spark, sf_dir).select("qid", "questions")
    return prompting.stuff_prompt(rag.retrieve(asked, _index(spark, sf_dir), K)).select(
        "qid", "prompt"
    )


def stuffed_budget(spark, sf_dir):
    asked = _pairs(spark, sf_dir).select("qid", "questions")
    return prompting.stuff_prompt(
        rag.retrieve(asked, _index(spark, sf_dir), K), max_chars=1200
    ).select("qid", "context")


def chat_messages(spark, sf_dir):
    asked = _answers(spark, sf_dir).select("qid", "prompt")
    return prompting.to_messages(asked).select(
        "qid",
        F.size("messages").alias("n_messages"),
        F.col("messages")[0]["role"].alias("role"),
        F.col("messages")[0]["content"].alias("content"),
    )


def chat_render(spark, sf_dir):
    return prompting.render_chat(tables.read_table(spark, sf_dir, "conversations"))


def extractive_answer(spark, sf_dir):
    answers = rag.answer_questions(_pairs(spark, sf_dir), _index(spark, sf_dir), K)
    return answers.select("qid", "result", "abstained")


def abstain_rate(spark, sf_dir):
    return answering.abstain_report(answering.answered(_answers(spark, sf_dir)))


def route_share(spark, sf_dir):
    routed = answering.route(_pairs(spark, sf_dir), ROUTES)
    return routed.groupBy("model").agg(
        F.count("*").alias("questions"), F.sum("bucket").alias("bucket_sum")
    )


def route_stable(spark, sf_dir):
    """Where the questions go before and after a change of weights."""
    asked = _pairs(spark, sf_dir).select("qid")
    before = answering.route_stable(asked, ROUTES).withColumnRenamed("model", "before")
    after = answering.route_stable(before, ROUTES_LATER).withColumnRenamed("model", "after")
    return after.groupBy("before", "after").agg(F.count("*").alias("questions"))


def chat_requests(spark, sf_dir):
    """Every question with the system text and the turns before it, as a model takes it."""
    talk = prompting.earlier_turns(tables.read_table(spark, sf_dir, "conversations"), HISTORY)
    talk = talk.select(pair_key("conv_id", "turn").alias("qid"), "system", "history")
    asked = _pairs(spark, sf_dir).select("qid", "questions").join(talk, "qid")
    made = prompting.chat_request(asked, "questions", F.col("system"), F.col("history"), max_tokens=256)
    shown = F.transform("request.messages", lambda m: F.concat_ws(": ", m["role"], m["content"]))
    return made.select(
        "qid", F.size("request.messages").alias("n_messages"), F.array_join(shown, "\n").alias("messages"), "request.max_tokens"
    )


def response_parse(spark, sf_dir):
    turns = tables.read_table(spark, sf_dir, "conversations").where("role = 'assistant'")
    message = F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"))
    full = F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))
    responses = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("response_id"), full.alias("response")
    ).unionByName(
        tables.read_table(spark, sf_dir, "events").select(
            F.concat(F.lit("event-"), "event_id").alias("response_id"),
            F.col("props").alias("response"),
        )
    )
    return answering.parse_response(responses, "response").select("response_id", "content")


def response_report(spark, sf_dir):
    return answering.parse_report(response_parse(spark, sf_dir))


def exact_match(spark, sf_dir):
    # an answer that repeats its target, next to the extracted one
    answers = _answers(spark, sf_dir)
    return answers.select(
        "qid",
        scoring.exact_match("result", "ground_truth").alias("exact_match"),
        scoring.exact_match(F.upper("ground_truth"), "ground_truth").alias("same_text"),
    )


def token_f1(spark, sf_dir):
    return scoring.overlap_scores(_answers(spark, sf_dir), sizes=(1,)).select("qid", "token_f1")


def rouge_n(spark, sf_dir):
    return scoring.overlap_scores(_answers(spark, sf_dir), sizes=(1, 2)).drop("token_f1")


def rouge_l(spark, sf_dir):
    return rag.spread(_answers(spark, sf_dir)).select(
        "qid", scoring.rouge_l("result", "ground_truth").alias("rouge_l")
    )


def readability(spark, sf_dir):
    docs = rag.spread(_docs(spark, sf_dir)).select("doc_id", "text")
    return scoring.readability(docs, "text").drop("text")


def _toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.NaiveBayes:
    def fit() -> toxicity.NaiveBayes:
        labels = tables.read_table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id"))
        docs = rag.spread(_docs(spark, sf_dir)).select("doc_id", "text")
        return toxicity.fit_naive_bayes(docs.join(labels, "doc_id"))

    return _once(spark, sf_dir, "toxicity", fit)


def toxicity_scores(spark, sf_dir):
    docs = rag.spread(_docs(spark, sf_dir)).select("doc_id", "text")
    return toxicity.naive_toxicity(docs, "doc_id", "text", _toxicity_model(spark, sf_dir))


def toxicity_ratio(spark, sf_dir):
    return toxicity.toxicity_ratio(toxicity_scores(spark, sf_dir))


def faithfulness(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "qid", scoring.faithfulness_lexical().alias("faithfulness_lexical")
    )


def faithfulness_target(spark, sf_dir):
    """The target judged against the retrieved context: most of it is not in there."""
    return _answers(spark, sf_dir).select(
        "qid",
        scoring.faithfulness_lexical(answer="ground_truth", n=2).alias("faithfulness_lexical"),
    )


def relevance(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "qid", scoring.relevance_lexical().alias("relevance_lexical")
    )


def judge_prompt(spark, sf_dir):
    return judging.judge_prompt(_answers(spark, sf_dir)).select("qid", "judge_prompt")


def judge_parse(spark, sf_dir):
    """Replies put together from the events; those of failed events are cut off."""
    grade = F.get_json_object("props", "$.k")
    whole = F.concat(F.lit('{"score": '), grade, F.lit(', "justification": "'), "event_type", F.lit('"}'))
    reply = F.when(F.col("event_type") == "error", F.substring(whole, 1, 12)).otherwise(whole)
    replies = tables.read_table(spark, sf_dir, "events").select("event_id", reply.alias("reply"))
    return judging.parse_judgement(replies, "reply").drop("reply")


def _evaluation(spark, sf_dir, k=K, run_id="run") -> evaluation.Evaluation:
    """All metrics of the answers to every question; scored once per number of chunks."""
    answers = _answers(spark, sf_dir, k)
    scored = _once(
        spark,
        sf_dir,
        f"scored{k}",
        lambda: rag.evaluate_answers(
            answers, answers, SUMMARY_METRICS, run_id=run_id, toxicity_model=_toxicity_model(spark, sf_dir)
        ),
    )
    return scored.renamed(run_id)


def eval_rows(spark, sf_dir):
    return _evaluation(spark, sf_dir).values


def metric_summary(spark, sf_dir):
    return _evaluation(spark, sf_dir).metrics


def compare_runs(spark, sf_dir):
    one = _evaluation(spark, sf_dir, 1, "top1").values
    four = _evaluation(spark, sf_dir, K, "top4").values
    return evaluation.compare_runs(one.unionByName(four), ["top1", "top4"], "top1")


def compare_certainty(spark, sf_dir):
    one = _evaluation(spark, sf_dir, 1, "top1").values
    four = _evaluation(spark, sf_dir, K, "top4").values
    return evaluation.compare_certainty(one.unionByName(four), ["top1", "top4"], "top1")


def merged_summary(spark, sf_dir):
    """Two runs summarised from what is saved of each, and whether the quantiles' ranks are as near as stated."""
    folder = scratch_path(spark, "sketches")
    asked = _answers(spark, sf_dir).select("qid", "prompt")
    timed = materialize(answering.answer_with(rag.spread(asked), _prompt_length), "timed")
    runs = []
    for k, run_id in ((1, "top1"), (K, "top4")):
        runs.append(_evaluation(spark, sf_dir, k, run_id).values.unionByName(evaluation.latency_values(timed, run_id)))
        tables.save_eval({"sketches": evaluation.sketch_metrics(runs[-1])}, folder)
    found = materialize(evaluation.merged_summary(tables.load_eval(spark, folder, "sketches")), "merged")
    ranked = runs[0].unionByName(runs[1]).where("value is not null").join(found, "metric").groupBy("metric", "share").agg(
        F.max("n").alias("n"),
        F.avg((F.col("value") < F.col("quantile")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("quantile")).cast("double")).alias("up_to"),
    )
    error = evaluation.rank_error()
    near = (F.col("below") <= F.col("share") + error) & (F.col("up_to") >= F.col("share") - error)
    return ranked.select("metric", "share", "n", near.alias("near"))


def _prompt_length(prompts, params):
    return [str(len(p)) for p in prompts]


def latency(spark, sf_dir):
    asked = _answers(spark, sf_dir).select("qid", "prompt")
    made = answering.answer_with(rag.spread(asked), _prompt_length)
    return made.select("qid", "result", (F.col("latency") >= 0).alias("timed"), "error")


def resumed_answers(spark, sf_dir):
    """A run over all prompts after one over those of even questions: answers it had are not asked again."""
    asked = rag.spread(_answers(spark, sf_dir).select("qid", "prompt"))
    store = answering.AnswerStore(spark, scratch_path(spark, "answer-store"))
    answering.answer_resumed(asked.where("qid % 2 = 0"), _prompt_length, store, "length", slice_rows=500)
    made = answering.answer_resumed(asked, _prompt_length, store, "length", slice_rows=500)
    return made.select("qid", "result", "reused", "error")


def version_changes(spark, sf_dir):
    """Three versions of the documents: the changes between any two, and the rows an earlier one still has."""
    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang")
    table = versions.VersionedTable(spark, scratch_path(spark, "versions"))
    table.write(docs)
    pinned = table.read()
    rewritten = F.replace("text", F.lit("\n"), F.lit(" ")).alias("text")
    table.write(docs.where("lang <> 'es'").select("doc_id", rewritten, "lang"))
    table.write(pinned.where("lang <> 'fr'"))
    out = None
    for old, new in ((0, 1), (1, 2), (0, 2), (2, 0)):
        found = table.changes(old, new, "doc_id").groupBy("change").agg(
            F.count("*").alias("n"), F.sum("doc_id").alias("doc_ids")
        )
        found = found.select(F.lit(f"{old}-{new}").alias("span"), "change", "n", "doc_ids")
        out = found if out is None else out.unionAll(found)
    return out


def change_feed(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang", "source")
    old = docs.where("source <> 'src0'").drop("source")
    new = docs.where("lang <> 'es'").select(
        "doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"), "lang"
    )
    return changes.change_feed(old, new, "doc_id")


def change_counts(spark, sf_dir):
    return changes.change_counts(change_feed(spark, sf_dir))


def sync_index(spark, sf_dir):
    folder = scratch_path(spark, "sync")
    sync.sync_index(
        spark,
        f"{sf_dir}/documents*.parquet",
        _docs(spark, sf_dir).schema,
        f"{folder}/index",
        f"{folder}/progress",
        lambda docs: chunking.with_chunk_id(chunking.chunk(docs, mode="window")),
    )
    return sync.read_index(spark, f"{folder}/index").select("id", "doc_id", "page_content")


def _arrivals(spark, sf_dir) -> tuple[DataFrame, ...]:
    """All documents, a language rewritten, a source removed."""
    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang", "source")
    rewritten = F.replace("text", F.lit("\n"), F.lit(" ")).alias("text")
    kept, gone = F.lit(False).alias("deleted"), F.lit(True).alias("deleted")
    return (
        docs.select("doc_id", "text", kept),
        docs.where("lang = 'fr'").select("doc_id", rewritten, kept),
        docs.where("source = 'src0'").select("doc_id", "text", gone),
    )


def _window_chunks(docs: DataFrame) -> DataFrame:
    return chunking.with_chunk_id(chunking.chunk(docs.drop("deleted"), mode="window"))


def sync_batches(spark, sf_dir):
    """The index after three arrivals."""
    folder = scratch_path(spark, "sync")
    for arrival in _arrivals(spark, sf_dir):
        arrival.write.mode("append").parquet(f"{folder}/docs")
        sync.sync_index(
            spark, f"{folder}/docs", arrival.schema, f"{folder}/index", f"{folder}/progress", _window_chunks
        )
    return sync.read_index(spark, f"{folder}/index").select("id", "doc_id", "page_content")


def live_bm25(spark, sf_dir):
    """Questions answered by an index that took three arrivals one after another."""
    folder = scratch_path(spark, "live-bm25")
    index = live.LiveBm25(spark, f"{folder}/index")

    def apply(docs: DataFrame, touched: DataFrame, number: int) -> None:
        chunks = _window_chunks(docs).withColumnRenamed("doc_id", "key")
        index.apply(materialize(chunks, "chunks"), touched.withColumnRenamed("doc_id", "key"), number)

    for arrival in _arrivals(spark, sf_dir):
        arrival.write.mode("append").parquet(f"{folder}/docs")
        sync.follow(spark, f"{folder}/docs", arrival.schema, f"{folder}/progress", apply)
    return bm25.bm25_search(index.open(), _pairs(spark, sf_dir), K).select("qid", "rank", "id", "score")


def live_vectors(spark, sf_dir):
    """Neighbours of every vector, by an index that took three arrivals: all of them, every fifth with
    its entries in reverse order, and the removal of a label."""
    folder = scratch_path(spark, "live-vectors")
    index = live.LiveVectors(spark, f"{folder}/index")
    rows = tables.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    kept, gone = F.lit(False).alias("deleted"), F.lit(True).alias("deleted")
    arrivals = (
        rows.select("vec_id", "embedding", kept),
        rows.where("vec_id % 5 = 0").select("vec_id", F.reverse("embedding").alias("embedding"), kept),
        rows.where("label = 0").select("vec_id", "embedding", gone),
    )

    def apply(vectors: DataFrame, touched: DataFrame, number: int) -> None:
        named = vectors.select(F.col("vec_id").alias("id"), F.col("vec_id").alias("key"), "embedding")
        index.apply(named, touched.withColumnRenamed("vec_id", "key"), number)

    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{folder}/rows")
        sync.follow(spark, f"{folder}/rows", arrival.schema, f"{folder}/progress", apply, key="vec_id")
    asked = _vectors(spark, sf_dir).withColumnRenamed("id", "qid")
    return search.knn_cells(index.open(), asked, K).drop("pairs")


def save_roundtrip(spark, sf_dir):
    """The chunk table saved, then overwritten by one without ``type``: the column stays."""
    chunks = chunking.chunk_table(_chunks(spark, sf_dir))
    path = scratch_path(spark, "saved")
    name = "quernstone_saved.raw_chunks_" + path[-8:]
    tables.save_table(chunks, name, path=path)
    saved = tables.save_table(chunks.drop("type"), name, path=f"{path}-next")
    return saved.select("id", "page_content", "type")


def run_history(spark, sf_dir):
    """Two saved runs, one of them saved again."""
    folder = scratch_path(spark, "history")
    for k, run_id in ((1, "top1"), (K, "top4"), (K, "top4")):
        tables.save_eval(_evaluation(spark, sf_dir, k, run_id).tables(), folder)
    rows = tables.load_eval(spark, folder, "eval_rows")
    runs = tables.load_eval(spark, folder, "runs")
    counted = rows.groupBy("run_id", "metric").agg(F.count("*").alias("n_rows"))
    return counted.join(runs.select("run_id", "model"), "run_id")


CONTRACT = T.StructType(
    [
        T.StructField("doc_id", T.LongType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("lang", T.StringType(), True),
        T.StructField("n_chars", T.IntegerType(), True),
        T.StructField("title", T.StringType(), True),
    ]
)


def signature_check(spark, sf_dir):
    return shaping.check_signature(_docs(spark, sf_dir), CONTRACT)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        rag_token_f1,
        page_text,
        eval_pairs,
        chunk_window,
        chunk_merge,
        chunk_merge_split,
        token_chunks,
        window_guard,
        window_report,
        missing_names,
        knn_exact,
        knn_cells_exact,
        reopened_index,
        reopened_bm25,
        knn_cells_recall,
        knn_codes_recall,
        describe_index,
        embed_text,
        similarity_search,
        vector_retrieval,
        bm25_index_terms,
        bm25_topk,
        project_mapped,
        stuffed_prompt,
        stuffed_budget,
        chat_messages,
        chat_render,
        extractive_answer,
        abstain_rate,
        route_share,
        route_stable,
        chat_requests,
        response_parse,
        response_report,
        exact_match,
        token_f1,
        rouge_n,
        rouge_l,
        readability,
        toxicity_scores,
        toxicity_ratio,
        faithfulness,
        faithfulness_target,
        relevance,
        judge_prompt,
        judge_parse,
        eval_rows,
        metric_summary,
        compare_runs,
        compare_certainty,
        merged_summary,
        latency,
        resumed_answers,
        version_changes,
        change_feed,
        change_counts,
        sync_index,
        sync_batches,
        live_bm25,
        live_vectors,
        save_roundtrip,
        run_history,
        signature_check,
    )
}
