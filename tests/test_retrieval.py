import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.operators import bm25, embedding, joins, search, topk
from quernstone.plans import catalog, rag


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def brute_bm25(chunks, question, k, k1=1.2, b=0.75):
    bags = {i: tokens(t) for i, t in chunks}
    n, mean = len(bags), sum(map(len, bags.values())) / len(bags)
    found = []
    for i, bag in bags.items():
        score = 0.0
        for t in set(tokens(question)):
            df = sum(t in other for other in bags.values())
            tf = bag.count(t)
            if tf:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                score += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(bag) / mean))
        if score > 0:
            found.append((-round(score, 6), i))
    return [(i, -s) for s, i in sorted(found)[:k]]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["the"] * 30
    chunks = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(150)]
    # a third of the chunks are copies of one text
    chunks += [(500 + i, "the w1 w2 copied text") for i in range(75)]
    questions = [(q, " ".join(rng.choices(words, k=rng.randint(1, 6)))) for q in range(30)]
    questions += [(100 + q, "W1, copied?") for q in range(20)] + [(200, "zzz"), (201, "...")]
    return chunks, questions


@pytest.mark.parametrize("k", [1, 4, 50])
@pytest.mark.parametrize("how", [{}, {"block_rows": 16, "broadcast_bytes": 0}])
def test_bm25_is_exact(spark, corpus, k, how):
    chunks, questions = corpus
    index = bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"))
    asked = spark.createDataFrame(questions, "qid long, questions string")
    found = {}
    for r in bm25.bm25_search(index, asked, k, **how).collect():
        found.setdefault(r["qid"], []).append((r["rank"], r["id"], r["score"]))
    for qid, question in questions:
        want = brute_bm25(chunks, question, k)
        got = sorted(found.get(qid, []))
        assert [g[0] for g in got] == list(range(1, len(want) + 1))
        assert [g[1] for g in got] == [w[0] for w in want], (qid, question)
        assert np.allclose([g[2] for g in got], [w[1] for w in want], atol=2e-6)


def test_every_copy_can_be_found(spark, tmp_path):
    chunks = [(i, "same words") for i in range(130)]
    path = str(tmp_path / "index")
    bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"), path=path)
    asked = spark.createDataFrame([(1, "same")], "qid long, questions string")
    hits = bm25.bm25_search(bm25.open_bm25(spark, path), asked, 100)
    assert [r["id"] for r in hits.orderBy("rank").collect()] == list(range(100))


def test_copies_beyond_the_kept_ones_still_count(spark):
    chunks = [(i, "same words") for i in range(200)] + [(900, "other words")]
    index = bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"))
    df = {r["term"]: r["df"] for r in index.terms.collect()}
    assert df == {"same": 200, "words": 201, "other": 1}
    asked = spark.createDataFrame([(1, "same")], "qid long, questions string")
    hits = bm25.bm25_search(index, asked, 64)
    assert sorted(r["id"] for r in hits.collect()) == list(range(64))


def test_question_without_hits_keeps_its_row(spark, corpus):
    index = bm25.build_bm25(spark.createDataFrame(corpus[0], "id long, page_content string"))
    asked = spark.createDataFrame([(1, "zzz"), (2, "w1")], "qid long, questions string")
    rows = {r["qid"]: r for r in rag.answer_questions(asked, index).collect()}
    assert rows[1]["abstained"] and rows[1]["result"] == "I do not know."
    assert not rows[2]["abstained"]


def brute_knn(queries, vectors, k):
    out = {}
    for qid, q in queries:
        scored = []
        for i, v in vectors:
            norm = np.linalg.norm(q) * np.linalg.norm(v)
            s = float(np.dot(np.float64(q), np.float64(v)) / norm) if norm else 0.0
            scored.append((-round(s, 6), i))
        out[qid] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    # small whole numbers give exact ties
    vectors = [(i, rng.integers(-2, 3, 8).astype(float).tolist()) for i in range(300)]
    vectors += [(1000 + i, [1.0] * 8) for i in range(150)] + [(2000, [0.0] * 8)]
    queries = [(q, rng.integers(-2, 3, 8).astype(float).tolist()) for q in range(40)]
    return vectors, queries + [(99, [1.0] * 8)]


def frames(spark, points):
    return (
        spark.createDataFrame(points[0], "id long, embedding array<float>"),
        spark.createDataFrame(points[1], "qid long, embedding array<float>"),
    )


def ids(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["qid"], []).append((r["rank"], r["id"]))
    return {q: [i for _, i in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("how", [{}, {"block_rows": 32, "broadcast_bytes": 0}])
def test_knn_exact(spark, points, how):
    vectors, queries = frames(spark, points)
    got = ids(search.knn_exact(queries, vectors, 5, **how))
    assert got == brute_knn(points[1], points[0], 5)


def test_cells_in_exact_mode_miss_nothing(spark, points):
    vectors, queries = frames(spark, points)
    index = search.build_index(vectors, cells=6)
    want = brute_knn(points[1], points[0], 5)
    assert ids(search.knn_cells(index, queries, 5, nprobe=1)) == want
    assert ids(search.knn_cells(index, queries, 5, nprobe=6, exact=False)) == want


def test_exact_cells_hold_at_scores_that_round_alike(spark):
    """Two cells whose nearest vectors both round to score 1: the nearer one, or the smaller id, wins."""
    angles = [(1, -0.0003), (50, 0.0008)] + [(100 + i, 0.2 + i / 1e3) for i in range(20)]
    angles += [(200 + i, -0.2 - i / 1e3) for i in range(20)]
    vectors = spark.createDataFrame([(i, [math.cos(a), math.sin(a)]) for i, a in angles], "id long, embedding array<double>")
    asked = spark.createDataFrame([(7, [math.cos(1e-4), math.sin(1e-4)])], "qid long, embedding array<double>")
    for cells in (2, 4, 8):
        index = search.build_index(vectors, cells=cells)
        assert ids(search.knn_cells(index, asked, 1, nprobe=1)) == ids(search.knn_exact(asked, vectors, 1)) == {7: [1]}


def test_search_without_queries(spark, points):
    vectors, queries = frames(spark, points)
    index = search.build_index(vectors, cells=3)
    for exact in (True, False):
        assert search.knn_cells(index, queries.limit(0), 2, exact=exact).count() == 0
    assert search.knn_exact(queries.limit(0), vectors, 2).count() == 0


def test_a_saved_index_is_opened(spark, points, tmp_path):
    vectors, queries = frames(spark, points)
    path = str(tmp_path / "index")
    made = search.build_if_absent(spark, path, lambda: vectors, cells=4)
    opened = search.build_if_absent(spark, path, lambda: 1 / 0)
    assert np.array_equal(made.centres, opened.centres)
    assert ids(search.knn_cells(opened, queries, 3)) == brute_knn(points[1], points[0], 3)


def test_vectors_of_one_table_are_searched_in_blocks(spark, points, tmp_path):
    """More vectors than a block holds, searched by themselves: both sides have the same columns."""
    spark.createDataFrame(points[0], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/vectors")
    vectors = spark.read.parquet(f"{tmp_path}/vectors").select(F.col("vec_id").alias("id"), "embedding")
    found = search.knn_exact(vectors.withColumnRenamed("id", "qid"), vectors, 3, block_rows=64)
    assert ids(found) == brute_knn(points[0], points[0], 3)


def test_recall_is_far_above_the_share_scored(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "embedding"
    )
    asked = vectors.withColumnRenamed("id", "qid")
    index = search.build_index(vectors, cells=16)
    found = search.knn_cells(index, asked, 4, nprobe=4, exact=False)
    report = search.recall_report(found, search.knn_exact(asked, vectors, 4), vectors.count())
    row = report.first()
    assert row["true_hits"] == 4 * vectors.count()
    assert row["recall"] - row["share_scored"] >= 0.2


def test_the_registered_index_finds_nine_in_ten(spark, small):
    row = catalog.knn_cells_recall(spark, small).first()
    assert row["recall"] >= 0.9 and row["share_scored"] < 0.8


def test_describe_index_counts_bad_keys(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 1.0]), (4, [1.0, 2.0]), (5, None)]
    index = search.build_index(spark.createDataFrame(rows, "id long, embedding array<float>"), 2)
    row = search.describe_index(index).first()
    assert (row["row_count"], row["null_keys"], row["repeated_keys"]) == (4, 1, 1)
    assert row["min_dimensions"] == row["max_dimensions"] == 2


def test_text_vectors(spark):
    texts = [(1, "red apples and pears"), (2, "green tea"), (3, "red apples and pears"), (4, ""), (5, None)]
    df = spark.createDataFrame(texts, "id long, page_content string")
    model = embedding.fit_embedder(df, "page_content")
    made = {r["id"]: r["embedding"] for r in embedding.embed(df, "page_content", model).collect()}
    assert made[1] == made[3] != made[2]
    assert math.isclose(np.linalg.norm(made[1]), 1, abs_tol=1e-6)
    assert not any(made[4]) and not any(made[5])
    index = search.build_index(embedding.embed(df, "page_content", model), cells=2)
    asked = embedding.embed(
        spark.createDataFrame([(7, "apples")], "qid long, questions string"), "questions", model
    )
    hits = search.similarity_search(index, asked, ("id", "page_content"), k=2)
    assert hits.columns == ["qid", "rank", "id", "page_content", "score"]
    assert [r["id"] for r in hits.orderBy("rank").collect()] == [1, 3]


def test_user_embedding_model(spark):
    def load():
        return lambda texts: np.array([[len(t), 1] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([("abc",), ("a",)], "page_content string")
    made = embedding.embed_with(df, "page_content", load).collect()
    assert {r["page_content"]: r["embedding"] for r in made} == {"abc": [3, 1], "a": [1, 1]}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k")
    ).unionByName(spark.createDataFrame([(9999, None)], "id long, k long"))
    lookup = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert joins.hot_keys(facts, "k", min_rows=100) == {7: 11}
    salted = joins.salted_join(facts, lookup, "k", how, min_rows=100)
    plain = facts.join(lookup, "k", how)
    assert salted.exceptAll(plain).count() == 0 == plain.exceptAll(salted).count()


def vector_table(rows, key):
    ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    values = pa.ListArray.from_arrays(ends, pa.array(rows.ravel().astype(np.float32)))
    return pa.table({key: pa.array(np.arange(len(rows))), "embedding": values})


def mostly_zeros(rng, rows, width, entries):
    out = np.zeros((rows, width), np.float32)
    for row in out:
        row[rng.integers(0, width, entries)] = rng.integers(1, 4, entries)
    return out


def test_many_sparse_queries_do_not_meet_every_dimension():
    rng = np.random.default_rng(5)
    asked = vector_table(mostly_zeros(rng, search.MANY_QUERIES, 8192, 8), "qkey")
    items = vector_table(mostly_zeros(rng, 1500, 8192, 40), "item")
    rows = search.cosine_kernel(asked)(items)(0, search.MANY_QUERIES)
    assert not isinstance(rows, np.ndarray)  # no product of all dimensions
    q, v = (search._matrix(t.column("embedding")) for t in (asked, items))
    assert np.allclose(np.stack(list(rows)), q @ v.T, atol=1e-12)


@pytest.mark.parametrize("odd", [0.0, np.nan, np.inf])
def test_sparse_scores_keep_ties_zeros_and_odd_values(odd):
    rng = np.random.default_rng(6)
    asked, items = mostly_zeros(rng, search.MANY_QUERIES, 64, 4), mostly_zeros(rng, 700, 64, 5)
    items[300:600] = items[:300]  # ties
    asked[3] = items[5] = 0
    items[9, 2] = asked[4, 1] = odd
    asked, items = vector_table(asked, "qkey"), vector_table(items, "item")
    with np.errstate(invalid="ignore"):
        q, v = (search._matrix(t.column("embedding")) for t in (asked, items))
        best = topk.Best(len(q), 4, None)
        for low in (0, 350):  # the second block meets the bar of the first
            topk._scan(best, search.cosine_kernel(asked), items.slice(low, 350), len(q))
        whole = np.round(q @ v.T, topk.PLACES)
    for n, row in enumerate(whole):
        known = np.flatnonzero(~np.isnan(row))
        want = known[np.lexsort((known, -row[known]))][:4]
        assert best.items[n].tolist() == want.tolist(), n


def test_terms_go_to_the_lists_of_many_questions(spark):
    """No join moves all lists by their terms before they move to their tasks, however many questions there are."""
    texts = [(i, f"common word{i} word{i} extra{i % 5}") for i in range(60)]
    index = bm25.build_bm25(spark.createDataFrame(texts, "id long, page_content string"))
    asked = bm25.materialize(spark.createDataFrame([("common",), ("word7",), ("unseen",)], "term string"), "asked")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt, joined = bm25._dealt_lists(index, asked, 4), bm25._dealt_lists(index, asked, 4, most=0)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        want = {(r.term, len(r.docs)) for r in joined.collect()}
        assert {(r.term, len(r.docs)) for r in dealt.collect()} == want == {("common", 60), ("word7", 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_only_texts_that_repeat_are_grouped(spark):
    texts = [(i, f"alone {i}") for i in range(50)] + [(100 + i, "again") for i in range(9)] + [(None, "no id"), (7, None)]
    chunks = spark.createDataFrame(texts, "id long, page_content string").where("page_content is not null")
    maybe = bm25.may_repeat(chunks)
    assert chunks.where(maybe).select("page_content").distinct().count() < 5
    named = {r.page_content: (r.rep, r.copies) for r in bm25.named_texts(chunks, maybe).collect()}
    assert named == {r.page_content: (r.rep, r.copies) for r in bm25.distinct_texts(chunks).collect()}
    index = bm25.build_bm25(chunks)
    copies = {(r.rep, r.id) for r in index.copies.collect()}
    assert copies == {(i, i) for i in range(50)} | {(100, 100 + i) for i in range(9)} | {(None, None)}
    asked = spark.createDataFrame([(1, "again"), (2, "alone 3")], "qid long, questions string")
    hits = {(r.qid, r.rank): (r.id, r.page_content) for r in bm25.bm25_search(index, asked, 2).collect()}
    assert hits[1, 1] == (100, "again") and hits[1, 2] == (101, "again") and hits[2, 1] == (3, "alone 3")


def test_sparse_vectors_are_the_entries_of_the_whole_ones(spark, monkeypatch):
    """The same weights without a row for each zero, and dimensions by the md5 of each token."""
    monkeypatch.setattr(embedding, "SLICE", 3)
    texts = [(i, f"all word{i % 7} word{i % 3} Ünï word{i % 3}") for i in range(20)] + [(90, None), (91, ""), (92, "all")]
    df = spark.createDataFrame(texts, "id long, text string")
    model = embedding.fit_embedder(df, "text", 64)
    whole = {r.id: r.embedding for r in embedding.embed(df, "text", model).collect()}
    found = {r.id: {e.dimension: e.weight for e in r.embedding} for r in embedding.embed(df, "text", model, sparse=True).collect()}
    assert found == {i: {d: w for d, w in enumerate(v) if w} for i, v in whole.items()} and found[90] == found[91] == {}
    md5 = F.conv(F.substring(F.md5(F.lit("ünï")), 1, 7), 16, 10).cast("long") % 64
    assert df.select(md5).first()[0] in found[0]


def test_embed_text_makes_each_vector_once(spark, small):
    plan = catalog.embed_text(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "posexplode" not in plan
