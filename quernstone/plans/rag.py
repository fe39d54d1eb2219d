"""The three flows the operators compose into: corpus to index, question to answer, evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from quernstone.operators import answering, bm25, chunking, embedding, evaluation, prompting, search
from quernstone.operators.joins import placed_by
from quernstone.sources.scratch import materialize


def spread(df: DataFrame) -> DataFrame:
    """Give work that is heavy per row at least one partition per core.

    A table read in fewer partitions than that is small; larger tables stay as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def build_chunks(docs: DataFrame, mode: str = "window", path: str | None = None, **how) -> DataFrame:
    """The written chunk table ``id, doc_id, chunk_no, page_content``."""
    chunks = chunking.with_chunk_id(chunking.chunk(spread(docs), mode=mode, **how))
    return materialize(chunks.select("id", "doc_id", "chunk_no", "page_content"), "chunks", path)


def build_vectors(
    chunks: DataFrame, dimensions: int = embedding.DIMENSIONS, cells: int = 16, path: str | None = None
):
    """The fitted text model and the vector index of a chunk table."""
    model = embedding.fit_embedder(chunks, "page_content", dimensions)
    vectors = materialize(
        embedding.embed(chunks.select("id", "page_content"), "page_content", model), "embedded"
    )
    return model, search.build_index(vectors, cells=cells, path=path)


def retrieve(
    questions: DataFrame,
    index: bm25.Bm25Index | search.VectorIndex,
    k: int = 4,
    model=None,
) -> DataFrame:
    """``qid, questions, source_documents``: every question with its ``k`` best chunks.

    The kind of index decides between BM25 and vectors; for vectors ``model`` embeds the
    questions. A question without hits has no documents.
    """
    if isinstance(index, bm25.Bm25Index):
        hits = bm25.bm25_search(index, questions, k)
    else:
        asked = embedding.embed(questions.select("qid", "questions"), "questions", model)
        hits = search.similarity_search(index, asked, ("id", "page_content"), k)
    found = prompting.source_documents(hits)
    return questions.join(found, "qid", "left")


def answer_questions(
    questions: DataFrame,
    index: bm25.Bm25Index,
    k: int = 4,
    template: str = prompting.TEMPLATE,
    path: str | None = None,
) -> DataFrame:
    """Retrieve, fill the prompt and answer with the extractive reader; written once."""
    asked = placed_by(questions.select("qid", "questions"), "qid")
    prompts = prompting.stuff_prompt(retrieve(asked, index, k), template)
    weighted = prompts.join(bm25.question_idf(index, asked), "qid")
    return materialize(answering.answer_extractive(weighted), "answers", path)


def evaluate_answers(
    answers: DataFrame,
    targets: DataFrame,
    metrics: Sequence[str] = evaluation.QA_METRICS,
    run_id: str = "run",
    params: Mapping[str, str] | None = None,
    **more,
) -> evaluation.Evaluation:
    return evaluation.evaluate(answers, targets, metrics, run_id=run_id, params=params, **more)


def graded_answers(questions: DataFrame, index: bm25.Bm25Index, k: int = 4) -> DataFrame:
    """Questions with targets, answered and scored: the result of one whole run."""
    answers = answer_questions(questions, index, k)
    scored = evaluation.score_rows(
        answers.join(questions.select("qid", "ground_truth"), "qid"), ("exact_match", "token_f1")
    )
    return scored.select(
        "qid", "questions", "ground_truth", "result", "abstained", "exact_match", "token_f1"
    )
