"""Sparse BM25 blocks, and indexes that follow their table by increments."""

import functools
import random

import numpy as np
import pyarrow as pa
import pytest
from test_retrieval import brute_bm25, brute_knn, ids

from quernstone.operators import bm25, codes, search, topk
from quernstone.streaming import live

WORDS = [f"w{i}" for i in range(60)] + ["the"] * 40


def texts_of(rng, n, first=0):
    return [(first + i, " ".join(rng.choices(WORDS, k=rng.randint(1, 25)))) for i in range(n)]


def hits_of(index, asked, k, **how):
    found = {}
    for r in bm25.bm25_search(index, asked, k, **how).collect():
        found.setdefault(r["qid"], []).append((r["rank"], r["id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in found.items()}


def assert_hits(found, chunks, questions, k):
    for qid, question in questions:
        want = brute_bm25(chunks, question, k)
        got = found.get(qid, [])
        assert [i for i, _ in got] == [i for i, _ in want], (qid, question)
        assert np.allclose([s for _, s in got], [s for _, s in want], atol=2e-6)


@pytest.mark.parametrize("how", [{}, {"block_rows": 8, "broadcast_bytes": 0}])
def test_many_small_blocks_are_exact(spark, monkeypatch, how):
    monkeypatch.setattr(bm25, "BLOCK_TEXTS", 16)
    monkeypatch.setattr(bm25, "BLOCKS_TOGETHER", 3)
    rng = random.Random(11)
    chunks, questions = texts_of(rng, 400), [(q, " ".join(rng.choices(WORDS, k=4))) for q in range(25)]
    index = bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"))
    assert index.postings.select("block").distinct().count() == 25
    asked = spark.createDataFrame(questions, "qid long, questions string")
    assert_hits(hits_of(index, asked, 3, **how), chunks, questions, 3)


def test_blocks_below_the_kth_score_are_skipped():
    """One block has a text that repeats the rare term; blocks of common terms alone cannot reach it."""
    weights = pa.array([[{"term": "rare", "idf": 5.0}, {"term": "the", "idf": 0.1}]])
    queries = pa.table({"qkey": ["q"], "q_weights": weights})
    scorer = bm25._Scorer(queries, 1, 1.2, 0.75, 10.0)

    def lists(block, rows):
        docs = [[{"rep": r, "n_tokens": n, "tf": tf} for r, n, tf in found] for _, found in rows]
        most = [max((tf for *_, tf in found), default=0) for _, found in rows]
        least = [min((n for _, n, _ in found), default=0) for _, found in rows]
        kind = pa.list_(pa.struct([("rep", pa.int64()), ("n_tokens", pa.int32()), ("tf", pa.int32())]))
        return pa.table(
            {"term": [t for t, _ in rows], "most": most, "least": least, "docs": pa.array(docs, kind)}
        )

    scorer.add(lists(0, [("rare", [(7, 10, 3)]), ("the", [(7, 10, 1)])]))
    assert (scorer.scored, scorer.skipped) == (1, 0)
    for block in range(1, 6):
        scorer.add(lists(block, [("the", [(block * 10, 8, 2)])]))
    assert (scorer.scored, scorer.skipped) == (1, 5)
    # A text listed as gone is no hit, however well it scores.
    scorer.add(lists(9, [("rare", [(99, 3, 9)]), (None, [(99, 0, 0)])]))
    assert scorer.scored == 2 and scorer.table().column("item").to_pylist() == [7]


@pytest.mark.parametrize(("cells", "common"), [(1 << 20, 300), (700, 0), (700, 10**9)])
def test_few_texts_are_scored_exactly(monkeypatch, cells, common):
    """A first pass in single precision leaves few texts to score exactly, and hits, ties included, stay the same."""
    monkeypatch.setattr(bm25, "CELLS", cells)
    monkeypatch.setattr(bm25, "COMMON", common)
    rng = random.Random(17)
    words = [f"w{i}" for i in range(400)] + ["the"] * 300
    questions = [sorted(set(rng.choices(words, k=6))) for _ in range(50)]
    idfs = {w: 1 + 5 * rng.random() for w in set(words)}
    weights = [[{"term": t, "idf": idfs[t]} for t in q] for q in questions]
    scorer = bm25._Scorer(pa.table({"qkey": [str(q) for q in range(50)], "q_weights": weights}), 4, 1.2, 0.75, 20.0)
    whole = [[] for _ in questions]
    for block in range(10):
        bags = {block * 1000 + i: rng.choices(words, k=rng.choice([10, 20, 30])) for i in range(100)}
        bags |= {block * 1000 + 500 + i: ["the", "w1", "w2"] for i in range(5)}
        texts = pa.table(
            {
                "block": pa.array([block] * 105, pa.int32()), "rep": list(bags), "copies": [1] * 105,
                "n_tokens": pa.array([len(b) for b in bags.values()], pa.int32()), "tokens": list(bags.values()),
            }
        )
        scorer.add(pa.Table.from_batches([bm25._lists_of_block(texts)]))
        for found, question in zip(whole, questions, strict=True):
            for rep, bag in bags.items():
                held = [(t, bag.count(t)) for t in question if t in bag]
                score = sum(idfs[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / 20.0)) for t, tf in held)
                found.append((-round(score, 6), rep))
    got = {}
    for row in scorer.table().to_pylist():
        got.setdefault(int(row["qkey"]), []).append((-row["score"], row["item"]))
    for q, found in enumerate(whole):
        want = [f for f in sorted(found) if f[0] < 0][:4]
        assert [i for _, i in sorted(got.get(q, []))] == [i for _, i in want]
        assert np.allclose([s for s, _ in sorted(got.get(q, []))], [s for s, _ in want], atol=2e-6)
    assert scorer.exact < 0.1 * scorer.scored * 105


def test_search_moves_lists_of_asked_terms_only(spark):
    rng = random.Random(5)
    index = bm25.build_bm25(spark.createDataFrame(texts_of(rng, 300), "id long, page_content string"))
    asked = spark.createDataFrame([(1, "w3 w5")], "qid long, questions string")
    queries = bm25.term_weights(index, bm25.question_terms(asked))
    terms = queries.selectExpr("explode(q_weights.term) AS term").distinct()
    for scored in (bm25._few_questions(index, queries, terms, 4), bm25._many_questions(index, queries, 1, 1, 4)):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "page_content" not in plan and "tokens#" not in plan.replace("n_tokens#", "")
        assert "Join" in plan


def test_live_bm25_equals_a_rebuild(spark, tmp_path):
    rng = random.Random(2)
    index = live.LiveBm25(spark, str(tmp_path / "live"))
    questions = [(q, " ".join(rng.choices(WORDS, k=3))) for q in range(12)] + [(50, "same words"), (51, "nothing")]
    asked = spark.createDataFrame(questions, "qid long, questions string")
    state: dict[int, list[tuple[int, str]]] = {}
    for number in range(3):
        keys = rng.sample(range(30), 16)
        chunks = []
        for key in keys:
            n = rng.randint(0, 4)  # a document may lose all its chunks
            rows = [(key * 1000 + i, t) for i, t in texts_of(rng, n)]
            # copies whose smallest id may go later
            rows += [(key * 1000 + 900, "same words again")] if rng.random() < 0.5 else []
            state[key] = rows
            chunks += [(i, key, t) for i, t in rows]
        made = spark.createDataFrame(chunks, "id long, key long, page_content string")
        touched = spark.createDataFrame([(k,) for k in keys], "key long")
        for _ in range(2 if number == 1 else 1):  # a batch that is written again replaces itself
            index.apply(made, touched, number)
    rows = sorted(r for held in state.values() for r in held)
    assert sorted((r.id, r.page_content) for r in index.rows().collect()) == rows
    opened = index.open()
    found = hits_of(opened, asked, 3)
    assert_hits(found, rows, questions, 3)
    assert hits_of(opened, asked, 3, block_rows=4, broadcast_bytes=0) == found
    fresh = index.rebuilt(str(tmp_path / "fresh")).open()
    terms = [sorted((r.term, r.df, round(r.idf, 9)) for r in x.terms.collect()) for x in (opened, fresh)]
    assert terms[0] == terms[1] and opened.n_chunks == fresh.n_chunks == len(rows)
    assert abs(opened.avg_tokens - fresh.avg_tokens) < 1e-9


def test_readers_see_whole_batches_only(spark, tmp_path, monkeypatch):
    index = live.LiveBm25(spark, str(tmp_path / "live"))
    schema, keys = "id long, key long, page_content string", "key long"
    index.apply(spark.createDataFrame([(1, 1, "red tea"), (2, 2, "tea")], schema), spark.createDataFrame([(1,), (2,)], keys), 0)
    asked = spark.createDataFrame([(7, "tea coffee")], "qid long, questions string")
    opened, before = index.open(), hits_of(index.open(), asked, 4)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(index.tables, "commit", broken)
    change = spark.createDataFrame([(3, 1, "coffee")], schema), spark.createDataFrame([(1,)], keys)
    with pytest.raises(RuntimeError):
        index.apply(*change, 1)
    assert hits_of(index.open(), asked, 4) == before  # written but not committed
    monkeypatch.undo()
    index.apply(*change, 1)
    assert {i for i, _ in hits_of(index.open(), asked, 4)[7]} == {2, 3}
    assert hits_of(opened, asked, 4) == hits_of(index.open(until=1), asked, 4) == before  # an opened index stays as it was


def test_live_index_without_rows(spark, tmp_path):
    asked = spark.createDataFrame([(7, "tea")], "qid long, questions string")
    index = live.LiveBm25(spark, str(tmp_path / "a"))
    assert hits_of(index.open(), asked, 4) == {}
    index.apply(spark.createDataFrame([], "id long, key long, page_content string"), spark.createDataFrame([(1,)], "key long"), 0)
    index.apply(spark.createDataFrame([(1, 1, None), (None, 2, "tea"), (3, 3, "tea")], "id long, key long, page_content string"), spark.createDataFrame([(3,), (None,)], "key long"), 1)
    assert [i for i, _ in hits_of(index.open(), asked, 4)[7]] == [3]
    vectors = live.LiveVectors(spark, str(tmp_path / "b"), cells=3)
    rows = "id long, key long, embedding array<float>"
    vectors.apply(spark.createDataFrame([], rows), spark.createDataFrame([(1,)], "key long"), 0)
    vectors.apply(spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 2, None)], rows), spark.createDataFrame([(1,)], "key long"), 1)
    found = search.knn_cells(vectors.open(), spark.createDataFrame([(5, [1.0, 1.0])], "qid long, embedding array<float>"), 2)
    assert ids(found) == {5: [1]}


def test_live_vectors_equal_brute_force_and_split_outgrown_cells(spark, tmp_path):
    rng = np.random.default_rng(8)
    index = live.LiveVectors(spark, str(tmp_path / "live"), cells=5, outgrown=2.0)
    state: dict[int, list[float]] = {}
    queries = [(q, rng.integers(-2, 3, 6).astype(float).tolist()) for q in range(20)]
    asked = spark.createDataFrame(queries, "qid long, embedding array<float>")
    for number in range(3):
        if number == 1:  # many vectors of one direction: a cell outgrows its share
            new = {5000 + i: ([3.0, 1.0, 0.0, 0.0, 0.0, 0.0] + 0.3 * rng.normal(size=6)).astype(np.float32).astype(float).tolist() for i in range(400)}
            gone = []
        else:
            new = {int(k): rng.integers(-2, 3, 6).astype(float).tolist() for k in rng.choice(300, 120, replace=False)}
            gone = [k for k in list(state)[:40] if k not in new]
        state = {k: v for k, v in (state | new).items() if k not in gone}
        made = spark.createDataFrame([(k, k, v) for k, v in new.items()], "id long, key long, embedding array<float>")
        index.apply(made, spark.createDataFrame([(k,) for k in [*new, *gone]], "key long"), number)
        opened = index.open()
        sizes = {r.cell: r.n for r in opened.cells.collect()}
        assert sum(sizes.values()) == len(state) == opened.vectors.count()
        if number == 1:
            assert len(opened.centres) > 5 and max(sizes.values()) < 400
    want = brute_knn(queries, sorted(state.items()), 4)
    assert ids(search.knn_cells(opened, asked, 4, nprobe=1)) == want
    fresh = index.rebuilt(str(tmp_path / "fresh")).open()
    assert ids(search.knn_cells(fresh, asked, 4, nprobe=1)) == want


def test_codes_find_nine_in_ten_with_few_full_scores(spark, small, tmp_path):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").selectExpr("vec_id AS id", "embedding")
    asked = vectors.withColumnRenamed("id", "qid")
    index = codes.build_codes(vectors, path=str(tmp_path / "codes"))
    assert sum(index.sizes.values()) == vectors.count() and len(index.top) < len(index.centres)
    truth = search.knn_exact(asked, vectors, 4)
    found = codes.knn_codes(index, asked, 4, nprobe=len(index.centres), survivors=40)
    report = search.recall_report(found, truth, vectors.count()).first()
    assert report.recall >= 0.9 and report.share_scored < 0.2
    score = {(r.qid, r.id): r.score for r in truth.collect()}
    assert all(score.get((r.qid, r.id), r.score) == r.score for r in found.collect())
    # With as many survivors as vectors nothing can be lost.
    some = asked.limit(20)
    opened = codes.open_codes(spark, str(tmp_path / "codes"))
    every = codes.knn_codes(opened, some, 4, nprobe=len(index.centres), survivors=vectors.count())
    assert ids(every) == ids(search.knn_exact(some, vectors, 4))


def test_a_search_of_all_cells_repeats_no_query(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    vectors = spark.createDataFrame(rows, "id long, embedding array<float>")
    index = codes.build_codes(vectors, cells=6, pieces=2)
    asked = [(i, v) for i, v in rows if i % 10 == 0]
    queries = spark.createDataFrame([*asked, (500, None)], "qid long, embedding array<float>")

    def never(*_):
        raise AssertionError("queries were dealt to cells")

    monkeypatch.setattr(codes, "nearest_cells", never)
    for block_rows in (topk.BLOCK_ROWS, 5):  # all queries in a broadcast, or in blocks
        monkeypatch.setattr(codes.topk, "block_topk", functools.partial(topk.block_topk, block_rows=block_rows))
        found = codes.knn_codes(index, queries, 3, nprobe=len(index.centres), survivors=120)
        assert ids(found) == brute_knn(asked, rows, 3)
        assert {r.pairs for r in found.collect()} == {120}
        monkeypatch.undo()
        monkeypatch.setattr(codes, "nearest_cells", never)


def test_codes_of_few_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(5)] + [(9, [0.0, 1.0, 0.0, 0.0]), (10, None)]
    vectors = spark.createDataFrame(rows, "id long, embedding array<float>")
    index = codes.build_codes(vectors, cells=2, pieces=2)
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 1.0]), (2, [0.0, 5.0, 0.0, 0.0])], "qid long, embedding array<float>")
    assert ids(codes.knn_codes(index, asked, 2, nprobe=4, survivors=6)) == {1: [0, 1], 2: [9, 0]}


def test_lists_are_moved_once_for_all_parts_of_questions(spark):
    rng = random.Random(6)
    chunks = texts_of(rng, 300)
    index = bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"))
    questions = [(q, " ".join(rng.choices(WORDS, k=4))) for q in range(40)]
    asked = bm25.question_terms(spark.createDataFrame(questions, "qid long, questions string"))
    queries = bm25.materialize(bm25.term_weights(index, asked), "queries").cache()
    scored = bm25._many_questions(index, queries, 40, 10, 3)
    assert scored.count() > 0
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("MapInArrow") == 4 and final.count("ReusedExchange") == 3


def test_posting_lists_need_no_row_per_token(spark):
    rng = random.Random(8)
    chunks = [*texts_of(rng, 60), (900, ""), (901, "... ")]
    texts = bm25.distinct_texts(spark.createDataFrame(chunks, "id long, page_content string"))
    texts = texts.withColumn("n_tokens", bm25.F.size(bm25.tx.tokens("page_content")))
    lists = bm25.postings_of(texts, 62, 5)
    assert "Generate" not in lists._jdf.queryExecution().executedPlan().toString()
    found = {r.term: r for r in lists.collect()}
    bags = {i: t.lower().split() for i, t in dict((t, (i, t)) for i, t in reversed(chunks)).values()}
    for term, row in found.items():
        held = sorted((i, len(b), b.count(term)) for i, b in bags.items() if term in b)
        assert [tuple(d) for d in row.docs] == held
        assert (row.most, row.least) == (max(h[2] for h in held), min(h[1] for h in held))
        assert row.df == sum(term in t.split() for _, t in chunks) and (row.batch, row.block) == (5, 0)
    assert set(found) == {w for b in bags.values() for w in b if w.strip(".")}


@pytest.mark.parametrize("most", [64 << 20, 0])  # terms go to the lists, or a filter of them does
def test_lists_in_many_partitions_are_scanned_where_they_lie(spark, tmp_path, monkeypatch, most):
    """No list moves for a search, and the texts that are gone are still those of their blocks."""
    monkeypatch.setattr(bm25, "BLOCK_TEXTS", 16)
    monkeypatch.setattr(bm25.topk, "BROADCAST_BYTES", most)
    rng = random.Random(13)
    questions = [(q, " ".join(rng.choices(WORDS, k=3))) for q in range(12)] + [(50, "same words")]
    asked = spark.createDataFrame(questions, "qid long, questions string")
    chunks = texts_of(rng, 200)
    index = bm25.build_bm25(spark.createDataFrame(chunks, "id long, page_content string"))
    assert index.places > 0
    index.places = 1000  # as if written in so many
    terms = bm25.materialize(spark.createDataFrame([("w3",), ("w5",)], "term string"), "asked")
    assert "Exchange hashpartitioning" not in bm25._asked_lists(index, terms, 4)._jdf.queryExecution().executedPlan().toString()
    assert_hits(hits_of(index, asked, 3), chunks, questions, 3)

    grown = live.LiveBm25(spark, str(tmp_path / "live"))
    schema = "id long, key long, page_content string"
    first = [(key * 1000 + i, key, t) for key in range(12) for i, t in texts_of(rng, 4)] + [(900 + k, k, "same words again") for k in range(2)]
    later = [(key * 1000 + i, key, t) for key in range(5) for i, t in texts_of(rng, 3)]
    for number, rows in enumerate((first, later)):
        touched = spark.createDataFrame([(k,) for k in sorted({r[1] for r in rows})], "key long")
        grown.apply(spark.createDataFrame(rows, schema), touched, number)
    opened = grown.open()
    opened.places = 1000
    rows = [(i, t) for i, key, t in first if key >= 5] + [(i, t) for i, _, t in later]
    assert_hits(hits_of(opened, asked, 3, block_rows=4), rows, questions, 3)


def test_few_blocks_are_unpacked_at_a_time(spark, tmp_path, monkeypatch):
    """A reader holds a row group as arrays; without a bound one of 1 GB of documents took several hundred MB a task."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(bm25, "BLOCK_TEXTS", 2)
    chunks = spark.createDataFrame(texts_of(random.Random(3), 120), "id long, page_content string").coalesce(1)
    bm25.build_bm25(chunks, path=str(tmp_path / "index"))
    files = [pq.ParquetFile(f).metadata for f in glob.glob(str(tmp_path / "index/blocks/*.parquet"))]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) > 30 and max(groups) <= 8
