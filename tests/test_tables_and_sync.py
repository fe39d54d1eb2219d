import pytest
from pyspark.sql import functions as F

from quernstone.operators import changes, chunking
from quernstone.sources import scratch, tables
from quernstone.streaming import sync


def test_next_turn_across_blocks_and_gaps(spark, monkeypatch):
    numbers = {1: [0, 1, 2, 3, 4, 9, 10, 23, 24, 25], 2: [5, 17], 3: [0]}
    turns = [
        (c, t, "user" if i % 2 == 0 else "assistant", f"{c}/{t}")
        for c, ts in numbers.items()
        for i, t in enumerate(ts)
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    want = sorted(
        (c, ts[i], f"{c}/{ts[i + 1]}")
        for c, ts in numbers.items()
        for i in range(0, len(ts) - 1, 2)
    )
    for block in (1, 2, 4, 1024):
        monkeypatch.setattr(tables, "TURNS_PER_BLOCK", block)
        got = sorted(
            (r["qid"] // 1_000_000, r["qid"] % 1_000_000, r["ground_truth"])
            for r in tables.turn_pairs(df).collect()
        )
        assert got == want, block


def test_eval_set_from_rows_and_tables(spark):
    made = tables.eval_set([("q", "a"), ("r", "b")], spark=spark)
    assert made.columns == ["qid", "questions", "ground_truth"] and made.count() == 2
    df = spark.createDataFrame([(5, "q", "a")], "k long, ask string, gold string")
    assert tuple(tables.eval_set(df, "ask", "gold", "k").first()) == (5, "q", "a")


def test_save_table_keeps_columns(spark, tmp_path):
    name = f"quernstone_test.t{abs(hash(str(tmp_path)))}"
    tables.save_table(spark.createDataFrame([(1, "a")], "id long, a string"), name, path=str(tmp_path / "1"))
    new = spark.createDataFrame([(2, "b")], "id long, b string")
    kept = tables.save_table(new, name, path=str(tmp_path / "2"))
    assert [tuple(r) for r in kept.select("id", "a", "b").collect()] == [(2, None, "b")]
    plain = tables.save_table(new, name, evolve=False, path=str(tmp_path / "3"))
    assert plain.columns == ["id", "b"]


def test_scratch_folder_is_the_named_one(spark):
    root = scratch.scratch_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named.rstrip("/")
    written = scratch.materialize(spark.range(3).toDF("x"), "kept")
    assert f"{root}/kept-" in written.inputFiles()[0] and written.count() == 3


def test_applying_the_change_feed_gives_the_new_table(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k long, t string, n int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (4, None, 4)], "k long, t string, n int")
    feed = {r["k"]: r["change"] for r in changes.change_feed(old, new, "k").collect()}
    assert feed == {2: "update", 3: "delete", 4: "insert"}
    assert {tuple(r) for r in changes.change_counts(changes.change_feed(old, new, "k")).collect()} == {
        ("update", 1), ("delete", 1), ("insert", 1)
    }
    assert changes.change_feed(new, new, "k").count() == 0


@pytest.mark.parametrize("max_files", [None, 1])
def test_sync(spark, tmp_path, max_files):
    source, target = str(tmp_path / "docs"), str(tmp_path / "index")
    schema = "doc_id long, text string, deleted boolean"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        return sync.sync_index(
            spark,
            source,
            spark.createDataFrame([], schema).schema,
            target,
            str(tmp_path / "progress"),
            lambda d: chunking.with_chunk_id(chunking.chunk(d.select("doc_id", "text"), 4, 0, mode="window")),
            max_files=max_files,
        )

    def state(folder=target):
        return sorted((r["doc_id"], r["page_content"]) for r in sync.read_index(spark, folder).collect())

    add([(1, "aaaabb", None), (2, "cc", False)])
    assert run() == [2]
    assert state() == [(1, "aaaa"), (1, "bb"), (2, "cc")]
    assert run() == []  # nothing new
    add([(1, "xx", None), (3, "dd", None)])
    add([(2, None, True)])
    assert sum(run()) == 3
    assert state() == [(1, "xx"), (3, "dd")]
    sync.compact(spark, target, str(tmp_path / "fresh"))
    assert state(str(tmp_path / "fresh")) == [(1, "xx"), (3, "dd")]


def test_keys_have_no_range(spark):
    from quernstone.functions.keys import pair_key

    pairs = [(3, 7), (3, 1_000_007), (4, 7), (-1, 0), (2**62, 1), (None, 1)]
    keys = [r.k for r in spark.createDataFrame(pairs, "a long, b long").select(pair_key("a", "b").alias("k")).collect()]
    assert keys[0] == 3_000_007 and keys[2] == 4_000_007 and keys[5] is None
    assert len(set(keys)) == 6 and all(k < 0 for k in (keys[1], keys[3], keys[4]))


def test_plans_prune_and_limit_early(spark, small):
    """Columns and filters reach the scan, and groups are cut to their best rows before a shuffle."""
    from quernstone.operators import bm25

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    docs = tables.read_table(spark, small, "documents")
    chunks = plan(chunking.chunk(docs.where("lang = 'en'"), mode="window"))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in chunks
    assert "EqualTo(lang,en)" in chunks and "Exchange" not in chunks
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("page_content"))
    assert "partial_min" in plan(bm25.distinct_texts(texts))
    from quernstone.operators import scoring

    pairs = texts.select("id", F.col("page_content").alias("result"), F.col("page_content").alias("ground_truth"))
    assert plan(scoring.overlap_scores(pairs, key="id")).count("Exchange") == 1
