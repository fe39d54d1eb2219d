import math

import pytest
from pyspark.sql import functions as F

from quernstone.operators import answering, chunking, evaluation, prompting, toxicity
from quernstone.sources import tables, versions
from quernstone.sources.scratch import materialize


def test_versions_are_whole_and_stay(spark, tmp_path, monkeypatch):
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    assert table.newest() is None
    schema = "k long, t string"
    assert table.write(spark.createDataFrame([(1, "a"), (2, "b")], schema)) == 0
    pinned = table.read()
    assert table.write(spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], schema)) == 1
    assert sorted(map(tuple, pinned.collect())) == [(1, "a"), (2, "b")] == sorted(map(tuple, table.read(0).collect()))
    assert {r.k: r.change for r in table.changes(0, 1, "k").collect()} == {2: "update", 3: "insert"}
    assert {r.k: r.change for r in table.changes(1, 0, "k").collect()} == {2: "update", 3: "delete"}
    # A writer that is lost before its commit leaves rows that no reader sees.
    spark.createDataFrame([(9, "x")], schema).write.parquet(str(tmp_path / "t" / "rows-lost"))
    assert table.newest() == 1 and table.read().count() == 3
    with pytest.raises(versions.VersionConflict):
        table.write(pinned, based_on=0)
    monkeypatch.setattr(table, "newest", lambda: 0)  # a writer that has not seen version 1
    with pytest.raises(versions.VersionConflict):
        table.write(pinned)
    monkeypatch.undo()
    assert table.write(spark.createDataFrame([], "k long, other double")) == 2
    assert table.read().columns == ["k", "other"] and table.read().count() == 0
    with pytest.raises(ValueError, match="no version 7"):
        table.read(7)


def test_a_broken_run_asks_only_the_rest(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    broken = {"on": True}

    def model(prompts, params):
        calls.add(len(prompts))
        return [p.upper() + params["mark"] for p in prompts]

    rows = [(q, f"prompt {q % 40}") for q in range(60)] + [(100, None)]
    prompts = spark.createDataFrame(rows, "qid long, prompt string")
    store = answering.AnswerStore(spark, str(tmp_path / "store"))
    add = store.add

    def sometimes(answers):
        if broken["on"] and len(list((tmp_path / "store").glob("*"))) == 2:
            raise RuntimeError("lost")
        return add(answers)

    store.add = sometimes
    how = {"params": {"mark": "!"}, "slice_rows": 11}
    with pytest.raises(RuntimeError):
        answering.answer_resumed(prompts, model, store, "m", **how)
    first, broken["on"] = calls.value, False
    kept = store.read().count()
    assert 0 < kept == first < 41
    made = {r.qid: r for r in answering.answer_resumed(prompts, model, store, "m", **how).collect()}
    assert calls.value == 41 and len(made) == 61
    assert all(r.result == (r.prompt or "").upper() + "!" and r.error is None for r in made.values())
    assert sum({r.prompt: r.reused for r in made.values()}.values()) == kept
    again = answering.answer_resumed(prompts, model, store, "m", **how).collect()
    assert calls.value == 41 and all(r.reused for r in again)
    # Other parameters and other models are other answers.
    answering.answer_resumed(prompts, model, store, "m", params={"mark": "?"}).collect()
    answering.answer_resumed(prompts, model, store, "n", **how).collect()
    assert calls.value == 3 * 41


def test_failed_prompts_are_asked_again(spark, tmp_path):
    flag = tmp_path / "up"

    def model(prompts, params):
        if not flag.exists() and any("2" in p for p in prompts):
            raise ValueError("down")
        return ["ok"] * len(prompts)

    prompts = spark.createDataFrame([(1, "p1"), (2, "p2")], "qid long, prompt string")
    store = answering.AnswerStore(spark, str(tmp_path / "store"))
    made = {r.qid: (r.result, r.error) for r in answering.answer_resumed(prompts, model, store, "m").collect()}
    assert made == {1: ("ok", None), 2: (None, "ValueError: down")}
    flag.touch()
    made = {r.qid: (r.result, r.error, r.reused) for r in answering.answer_resumed(prompts, model, store, "m").collect()}
    assert made == {1: ("ok", None, True), 2: ("ok", None, False)}


def test_stable_routes_move_what_they_must(spark):
    keys = spark.range(20_000).select(F.col("id").alias("qid"))
    before = answering.route_stable(keys, {"a": 60, "b": 30, "c": 10})
    shares = {r.model: r.n / 20_000 for r in before.groupBy("model").agg(F.count("*").alias("n")).collect()}
    assert all(abs(shares[m] - w) < 0.015 for m, w in (("a", 0.6), ("b", 0.3), ("c", 0.1)))
    after = answering.route_stable(before.withColumnRenamed("model", "was"), {"a": 50, "b": 30, "c": 10, "d": 10})
    moves = {(r.was, r.model): r.n for r in after.groupBy("was", "model").agg(F.count("*").alias("n")).collect()}
    # 10 points leave a and 10 come to d: keys leave a or come to d, and no others move.
    moved = {(was, now): n for (was, now), n in moves.items() if was != now}
    assert all(was == "a" or now == "d" for was, now in moved) and sum(moved.values()) / 20_000 < 0.15
    gone = answering.route_stable(before.withColumnRenamed("model", "was"), {"a": 60, "b": 30, "c": 0})
    assert gone.where("was <> model and was <> 'c'").count() == 0
    for bad in ({}, {"a": -1, "b": 2}, {"a": 0}):
        with pytest.raises(ValueError):
            answering.route_stable(keys, bad)


def test_chat_requests_hold_system_and_earlier_turns(spark):
    turns = [(1, 0, "system", "be brief"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "user", "x"), (2, 1, "assistant", None)]
    talk = prompting.earlier_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), most=2)
    made = prompting.chat_request(talk.withColumn("prompt", F.lit("now")), "prompt", F.col("system"), F.col("history"), max_tokens=10, temperature=0.5)
    found = {(r.conv_id, r.turn): r.request for r in made.collect()}
    assert [tuple(m) for m in found[1, 3].messages] == [("system", "be brief"), ("user", "q1"), ("assistant", "a1"), ("user", "now")]
    assert [tuple(m) for m in found[2, 0].messages] == [("user", "now")]
    assert (found[2, 0].max_tokens, found[2, 0].temperature) == (10, 0.5) and len(found) == 5
    plain = prompting.chat_request(spark.createDataFrame([(None,)], "prompt string"), system="s").first().request
    assert [tuple(m) for m in plain.messages] == [("system", "s"), ("user", "")]


def test_toxicity_of_null_and_repeated_keys(spark):
    labelled = spark.createDataFrame([(1, "vile words", 1), (2, "kind words", 0), (3, "vile vile", 1), (4, "kind kind", 0)], "doc_id long, text string, toxic int")
    model = toxicity.fit_naive_bayes(labelled)
    rows = [(1, "vile"), (1, "kind"), (None, "vile"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, toxicity.naive_toxicity(df, "doc_id", "text", model).collect()), key=repr)
    score = {r.doc_id: r.toxicity for r in toxicity.naive_toxicity(spark.createDataFrame([(1, "vile"), (2, "kind")], df.schema), "doc_id", "text", model).collect()}
    assert found == sorted([(1, score[1], True), (1, score[2], False), (None, score[1], True), (None, None, None), (2, None, None)], key=repr)
    answers = [(1, "q", "g", "vile"), (1, "q", "g", "kind"), (None, "q", "g", "vile"), (None, "q", "g", None)]
    scored = evaluation.score_rows(spark.createDataFrame(answers, "qid long, questions string, ground_truth string, result string"), (), model)
    assert sorted(((r.qid, r.result, r.toxicity) for r in scored.collect()), key=repr) == sorted(
        [(1, "vile", score[1]), (1, "kind", score[2]), (None, "vile", score[1]), (None, None, None)], key=repr
    )


def test_token_chunks_fit_the_window_and_rebuild_the_text(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = ["", " ", "plain words, and more of them " * 40, "你好世界🙂🙃 é" * 60, "a\n\n\n   b\t" * 50, "x" * 900, "<|endoftext|> tail " * 30, "🙂"]
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
    for size, overlap in ((16, 0), (16, 5), (7, 6), (512, 32)):
        found = {}
        for r in chunking.chunk_tokens(docs, path, size, overlap).collect():
            found.setdefault(r.doc_id, []).append(r)
        assert set(found) == set(range(len(texts)))
        for i, text in enumerate(texts):
            mine, end = sorted(found[i], key=lambda r: r.chunk_no), 0
            assert [r.chunk_no for r in mine] == list(range(len(mine)))
            for r in mine:
                assert text[r.start_char : r.start_char + len(r.page_content)] == r.page_content
                assert r.n_ids == len(tokenizer.encode(r.page_content, add_special_tokens=False).ids) <= size
                assert r.start_char <= end  # nothing is left out
                end = max(end, r.start_char + len(r.page_content))
            assert end == len(text)
            if not overlap:
                assert "".join(r.page_content for r in mine) == text
    with pytest.raises(ValueError, match="overlap"):
        chunking.chunk_tokens(docs, path, 8, 8)


def test_certainty_equals_a_plain_bootstrap(spark):
    import hashlib
    import random

    rng = random.Random(1)
    rows = [(run, q, m, rng.random() + (0.1 if run == "b" else 0)) for run in "ab" for q in range(80) for m in ("f1", "same")]
    rows = [(run, q, m, 0.5 if m == "same" else v) for run, q, m, v in rows] + [("a", 500, "f1", None), ("b", 500, "f1", 1.0)]
    values = spark.createDataFrame(rows, "run_id string, qid long, metric string, value double")
    found = {r.metric: r for r in evaluation.compare_certainty(values, ["a", "b"], "a", replicates=100).collect()}
    value = {(run, q): v for run, q, m, v in rows if m == "f1"}
    diffs = {q: value["b", q] - value["a", q] for q in range(80)}
    means = []
    for r in range(100):
        u = {q: (int(hashlib.md5(f"{q}-{r}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32 for q in diffs}
        w = {q: sum(u[q] >= c for c in evaluation.POISSON) for q in diffs}
        means.append(sum(w[q] * d for q, d in diffs.items()) / sum(w.values()))
    means.sort()
    row = found["f1"]
    assert (row.low, row.high) == (round(means[5], 6), round(means[94], 6)) and row.low < row.difference < row.high
    assert row.better_share == round(sum(m > 0 for m in means) / 100, 6)
    assert (found["same"].difference, found["same"].low, found["same"].high, found["same"].better_share) == (0, 0, 0, 0)


def test_quantiles_of_merged_runs_are_within_the_stated_rank(spark, tmp_path):
    import random

    rng = random.Random(9)
    rows = [(f"r{k}", q, "m", rng.gauss(k, 1 + k)) for k in range(4) for q in range(5000)]
    rows += [("r0", 1, "one", 2.5), ("r1", 1, "none", None), ("r1", 2, "none", float("nan"))]
    values = spark.createDataFrame(rows, "run_id string, qid long, metric string, value double")
    for run in ("r0", "r1", "r2", "r3", "r3"):  # saved one by one, one of them again
        tables.save_eval({"sketches": evaluation.sketch_metrics(values.where(f"run_id = '{run}'"))}, str(tmp_path / "e"))
    kept = tables.load_eval(spark, str(tmp_path / "e"), "sketches")
    shares = (0.01, 0.5, 0.9, 0.99)
    found = {(r.metric, r.share): r for r in evaluation.merged_summary(kept, shares).collect()}
    plain = sorted(v for *_, m, v in rows if m == "m")
    for share in shares:
        row = found["m", share]
        rank = sum(v <= row.quantile for v in plain) / len(plain)
        assert row.n == 20_000 and abs(rank - share) <= evaluation.rank_error() and abs(row.mean - sum(plain) / 20_000) < 1e-9
        assert found["one", share].quantile == 2.5
    assert not any(metric == "none" for metric, _ in found)
    by_run = evaluation.merged_summary(kept, (0.5,), by=("run_id", "metric")).collect()
    assert len(by_run) == 5
    assert max(len(r.sketch) for r in kept.collect()) < 12_000


def test_rating_makes_no_row_per_term_of_a_text(spark, monkeypatch):
    """Blocks of two rows, repeated and null keys, texts without tokens: each row is rated by its own terms."""
    monkeypatch.setattr(toxicity, "BLOCK_BITS", 1)
    made = []
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: made.append((name, materialize(df, name))) or made[-1][1])
    weights = spark.createDataFrame([("bad", 1.5), ("good", -0.5)], "term string, weight double")
    model = toxicity.NaiveBayes(weights, -1.0, 0.25)
    texts = [(1, "bad bad good"), (1, "good new"), (None, "bad"), (2, None), (3, "..."), (4, "new new"), (4, "bad bad good")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = sorted((r.toxicity is None, r.toxicity or 0) for r in toxicity.naive_toxicity(rows, "doc_id", "text", model).collect())
    odds = [-1 + w for w in (2.5, -0.25, 1.5, 0.5, 2.5)]
    assert found == [(False, x) for x in sorted(round(1 / (1 + math.exp(-o)), 6) for o in odds)] + [(True, 0)] * 2
    bags = dict(made)["bags"]
    assert bags.columns == ["term", "found"] and bags.count() == 7  # 8 rows of a text and a term before
