import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.operators import answering, evaluation, judging, prompting, scoring, shaping, toxicity
from quernstone.plans import catalog
from quernstone.sources import tables


def documents(spark, rows):
    """rows: (qid, questions, [page_content, ...])"""
    made = [(q, text, [(i + 1, 10 + i, p) for i, p in enumerate(d)]) for q, text, d in rows]
    return spark.createDataFrame(
        made,
        "qid long, questions string, "
        "source_documents array<struct<rank:int,id:long,page_content:string>>",
    )


def test_prompt_slots_inside_texts_stay(spark):
    df = documents(spark, [(1, "why {context}?", ["a {question} b", "c"])])
    row = prompting.stuff_prompt(df, "<{context}|{question}>").first()
    assert row["prompt"] == "<a {question} b\n\nc|why {context}?>"


def test_prompt_budget_takes_whole_documents(spark):
    df = documents(spark, [(1, "q", ["aaaa", "bbbb", "c"])])
    got = [
        prompting.stuff_prompt(df, max_chars=n).first()["context"] for n in (3, 4, 9, 10, 99)
    ]
    assert got == ["", "aaaa", "aaaa", "aaaa\n\nbbbb", "aaaa\n\nbbbb\n\nc"]


def test_messages(spark):
    df = prompting.stuff_prompt(documents(spark, [(1, "q", ["d"])]), "{question}")
    made = prompting.to_messages(df)
    assert "prompt" not in made.columns
    assert [tuple(m) for m in made.first()["messages"]] == [("user", "q")]


def test_chat_parts_follow_one_another(spark):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(25)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    whole = prompting.render_chat(df).collect()
    parts = prompting.render_chat(df, turns_per_part=4).orderBy("part").collect()
    assert len(whole) == 1 and len(parts) == 7
    assert "".join(p["rendered"] for p in parts) == whole[0]["rendered"]
    assert whole[0]["rendered"].endswith("<|assistant|>\n")
    bare = prompting.render_chat(df, add_generation_prompt=False).first()["rendered"]
    assert bare.startswith("<|user|>\nt0<|end|>\n") and not bare.endswith("<|assistant|>\n")


def weighted(spark, rows, weights):
    df = documents(spark, rows)
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(w).alias("idf")) for t, w in weights])
    return df.withColumn("q_weights", pairs)


def test_reader_takes_the_closest_sentence(spark):
    rows = [(1, "x y", ["nothing here. x alone.", "x y and much more words. x y."]), (2, "x", ["none."])]
    made = answering.answer_extractive(weighted(spark, rows, [("x", 1.0), ("y", 2.0)]))
    got = {r["qid"]: (r["result"], r["abstained"]) for r in made.collect()}
    assert got == {1: ("x y.", False), 2: ("I do not know.", True)}


def test_reader_ties_go_to_the_better_document(spark):
    rows = [(1, "x", ["b x. a x.", "a x."])]
    made = answering.answer_extractive(weighted(spark, rows, [("x", 1.0)])).first()
    assert made["result"] == "b x."


def test_user_model(spark):
    prompts = [(i, f"p{i % 3}") for i in range(9)] + [(50, "bad"), (51, None)]
    df = spark.createDataFrame(prompts, "qid long, prompt string")

    def predict(texts, params):
        if "bad" in texts:
            raise RuntimeError("no")
        return [f"{t} says {params['who']} now" for t in texts]

    made = answering.answer_with(df, predict, {"who": "me"}, max_tokens=3, concurrency=2).collect()
    assert len(made) == len(prompts)
    by_id = {r["qid"]: r for r in made}
    assert by_id[4]["result"] == "p1 says me" and by_id[4]["error"] is None
    assert by_id[50]["result"] is None and "RuntimeError" in by_id[50]["error"]
    assert all(r["latency"] >= 0 for r in made)
    # equal prompts were asked once
    assert len({r["latency"] for r in made if r["prompt"] == "p1"}) == 1


def test_routes(spark):
    df = spark.range(20000).withColumnRenamed("id", "qid")
    shares = {
        r["model"]: r["count"] / 20000
        for r in answering.route(df, {"a": 70, "b": 30, "c": 0}).groupBy("model").count().collect()
    }
    assert set(shares) == {"a", "b"} and abs(shares["a"] - 0.7) < 0.02
    for wrong in ({"a": 50}, {"a": 120, "b": -20}, {" a": 100}):
        with pytest.raises(ValueError):
            answering.route(df, wrong)


def test_responses(spark):
    rows = [('{"choices":[{"message":{"content":"hi"}}]}',), ('{"choices":[]}',), ("{oops",), (None,)]
    parsed = answering.parse_response(spark.createDataFrame(rows, "r string"), "r")
    assert [r["content"] for r in parsed.collect()] == ["hi", None, None, None]
    assert answering.parse_report(parsed).first()["malformed"] == 3


def test_judgements(spark):
    replies = ['{"score": 4, "justification": "j"}', '{"score": 0}', '{"score": 6}', "bad", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "qid long, reply string")
    got = judging.parse_judgement(df, "reply").orderBy("qid").collect()
    assert [r["score"] for r in got] == [4, None, None, None, None]
    assert [r["valid"] for r in got] == [True, False, False, False, False]


def test_judge_model(spark):
    rows = documents(spark, [(1, "q", ["ctx"])]).withColumn("result", F.lit("out"))

    def predict(prompts, params):
        ok = all("Score: 5" in p and "ctx" in p and "Output: out" in p for p in prompts)
        return ['{"score": %d, "justification": "x"}' % (5 if ok else 1)] * len(prompts)

    row = judging.judge(rows, predict).first()
    assert row["score"] == 5 and row["valid"]


def scored(spark, answer, target):
    df = spark.createDataFrame([(1, answer, target)], "qid long, result string, ground_truth string")
    return {
        **scoring.overlap_scores(df).first().asDict(),
        **df.select(
            scoring.exact_match("result", "ground_truth").alias("em"),
            scoring.rouge_l("result", "ground_truth").alias("rl"),
        ).first().asDict(),
    }


def test_scores_of_equal_disjoint_and_empty_texts(spark):
    same = scored(spark, "A b, a!", "a b a")
    assert same["token_f1"] == same["rouge2_f1"] == same["rl"] == same["em"] == 1
    other = scored(spark, "a b", "c d")
    assert other["token_f1"] == other["rouge2_f1"] == other["rl"] == other["em"] == 0
    for empty in ("", "...", None):
        assert set(v for k, v in scored(spark, empty, "a b").items() if k != "qid") == {None}


def test_token_f1_counts_repeats(spark):
    # overlap 2 of 4 and 3
    assert math.isclose(scored(spark, "a a a b", "a b c")["token_f1"], 4 / 7, abs_tol=1e-6)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert scoring._common_subsequence(a, b) == table[-1][-1]


def test_metrics_react_to_wrong_inputs(spark, small):
    answers = catalog._answers(spark, small)
    right = answers.select("qid", F.col("ground_truth").alias("result"), "ground_truth")
    n = right.count()
    shifted = right.select((F.col("qid") + 2).alias("qid"), "ground_truth")
    wrong = right.drop("ground_truth").join(shifted, "qid")
    assert 0 < wrong.count() < n
    mean = lambda df: scoring.overlap_scores(df).agg(F.avg("token_f1")).first()[0]
    assert mean(wrong) < 0.5 < mean(right)
    own = scoring.faithfulness_lexical()
    foreign = answers.withColumn(
        "source_documents",
        F.transform(
            "source_documents",
            lambda d: F.struct(d["rank"].alias("rank"), d["id"].alias("id"), F.reverse(d["page_content"]).alias("page_content")),
        ),
    )
    grade = lambda df: df.agg(F.avg(own)).first()[0]
    assert grade(answers) == 5 and grade(foreign) < 2


def test_readability_edges(spark):
    df = spark.createDataFrame([("",), ("...",), ("Go now.",)], "t string")
    rows = {r["t"]: r for r in scoring.readability(df, "t").collect()}
    assert rows[""]["ari_grade"] is None and rows["..."]["flesch_kincaid_grade"] is None
    assert rows["Go now."]["n_words"] == 2 and rows["Go now."]["n_sentences"] == 1


def test_toxicity_ranks_held_out_rows(spark, small):
    folder = small.replace("0.001", "0.01")
    labelled = tables.read_table(spark, folder, "documents").join(
        tables.read_table(spark, folder, "labels"), "doc_id"
    )
    model = toxicity.fit_toxicity(labelled.where(~toxicity.held_out("doc_id")))
    assert toxicity.auc(model, labelled.where(toxicity.held_out("doc_id"))) > 0.6
    blank = spark.createDataFrame([("",)], "text string")
    assert toxicity.toxicity(blank, "text", model).first()["toxicity"] is None


@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_quantile_is_exact(spark, p):
    rng = np.random.default_rng(1)
    groups = {
        "smooth": rng.normal(size=3000),
        # half of the values are equal
        "hot": np.concatenate([np.full(2000, 0.25), rng.random(2000)]),
        "few": np.array([3.0, 1.0]),
        "one": np.array([7.0]),
    }
    rows = [("r", i, m, float(v)) for m, vs in groups.items() for i, v in enumerate(vs)]
    rows += [("r", -1, "smooth", None), ("r", 0, "none", None)]
    df = spark.createDataFrame(rows, "run_id string, qid long, metric string, value double")
    got = {r["metric"]: r["quantile"] for r in evaluation.quantile(df, p).collect()}
    assert set(got) == set(groups)
    for metric, values in groups.items():
        assert math.isclose(got[metric], np.quantile(values, p), abs_tol=1e-9), metric


def test_saving_a_run_again_replaces_only_that_run(spark, tmp_path):
    def run(run_id, value):
        rows = [(run_id, 1, "m", value)]
        return {"eval_rows": spark.createDataFrame(rows, "run_id string, qid long, metric string, value double")}

    for run_id, value in (("1", 0.1), ("2", 0.2), ("1", 0.3)):
        tables.save_eval(run(run_id, value), str(tmp_path))
    rows = tables.load_eval(spark, str(tmp_path), "eval_rows").collect()
    assert sorted((r["run_id"], r["value"]) for r in rows) == [("1", 0.3), ("2", 0.2)]


def test_compare_runs(spark):
    rows = [("a", 1, "m", 1.0), ("a", 2, "m", 0.0), ("a", 3, "m", 0.5)]
    rows += [("b", 1, "m", 0.0), ("b", 2, "m", 0.0), ("b", 3, "m", 1.0), ("b", 4, "m", None)]
    df = spark.createDataFrame(rows, "run_id string, qid long, metric string, value double")
    row = evaluation.compare_runs(df, ["a", "b"], "a").first()
    assert (row["wins"], row["ties"], row["losses"]) == (1, 1, 1)


def test_evaluate_maps_columns(spark):
    answers = spark.createDataFrame(
        [(1, "x", "a b"), (2, "y", "c")], "qid long, input string, said string"
    ).withColumn("ground_truth", F.lit("ignored"))
    targets = tables.eval_set([("x", "?"), ("x", "a b"), ("y", "d")], spark=spark)
    made = evaluation.evaluate(
        answers, targets, mapping={"questions": "input", "result": "said"}, run_id="one"
    )
    means = {
        r["metric"]: r["value"] for r in made.metrics.where("agg = 'mean'").collect()
    }
    assert means["exact_match"] == means["token_f1"] == means["rouge_l"] == 0.5
    with pytest.raises(ValueError):
        evaluation.evaluate(answers, targets, mapping={"result": "nope"})


def test_signature(spark):
    contract = T.StructType(
        [T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())]
    )
    df = spark.createDataFrame([(1, "x"), (None, "y")], "a long, b int".replace("int", "string"))
    rows = {r["column"]: r for r in shaping.check_signature(df, contract).collect()}
    assert not rows["a"]["ok"] and rows["a"]["nulls"] == 1 and rows["b"]["ok"]


def test_missing_from_empty_registry(spark):
    asked = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    empty = spark.createDataFrame([], "name string")
    full = spark.createDataFrame([("a",)], "name string")
    assert {tuple(r) for r in shaping.missing_from(asked, empty, "name").collect()} == {("a", True), ("b", True)}
    assert {tuple(r) for r in shaping.missing_from(asked, full, "name").collect()} == {("a", False), ("b", True)}
