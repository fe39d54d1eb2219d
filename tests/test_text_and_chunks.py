import pytest
from pyspark.sql import functions as F

from quernstone.functions import text as tx
from quernstone.operators import chunking
from quernstone.sources import tables


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_tokens_edges(spark):
    assert one(spark, tx.tokens("t"), t="Été, a-b  C3!") == ["été", "a", "b", "c3"]
    assert one(spark, tx.tokens("t"), t="") == []
    assert one(spark, tx.tokens("t"), t="... !?") == []
    assert one(spark, tx.tokens("t"), t=None) is None


def test_sentences_keep_their_end(spark):
    got = one(spark, tx.sentences("t"), t="One a.b is two. Three!  Four\nfive?\n\n ")
    assert got == ["One a.b is two.", "Three!", "Four", "five?"]


def test_ngrams(spark):
    assert one(spark, tx.ngrams(tx.tokens("t"), 2), t="a b c") == ["a b", "b c"]
    assert one(spark, tx.ngrams(tx.tokens("t"), 4), t="a b c") == []


def test_page(spark):
    html = (
        "<html lang='x' lang=\"EN\"><head><title> A &amp; B </title><style>p{}</style></head>"
        "<body><!-- <p>no</p> --><script>var t='</p>';</script><p>one<br>two&lt;3&nbsp;</p></body>"
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    row = tables.load_pages(pages).first()
    assert (row["title"], row["text"]) == ("A & B", "one two<3")
    assert row["metadata"]["source"] == "u"


def windows(text, size, overlap):
    out, at = [], 0
    while True:
        out.append(text[at : at + size])
        if at + size >= len(text):
            return out
        at += size - overlap


@pytest.mark.parametrize("size,overlap", [(512, 32), (10, 7), (5, 0)])
def test_window_mode(spark, small, size, overlap):
    made = ["", "x", "é" * 512, "y" * 513, "😀b" * 400, "a\nb" * 30]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").unionByName(
        tables.read_table(spark, small, "documents").select(F.col("doc_id") + 100, "text").toDF(
            "doc_id", "text"
        )
    )
    texts = {r[0]: r[1] for r in docs.collect()}
    found = {}
    for r in chunking.chunk(docs, size, overlap, mode="window").collect():
        found.setdefault(r["doc_id"], []).append((r["chunk_no"], r["page_content"]))
    for key, text in texts.items():
        assert [c for _, c in sorted(found[key])] == windows(text, size, overlap), key


def join_length(pieces):
    return len("\n".join(pieces))


def merged(text, size, overlap):
    """The contract, read off literally: pieces are tried against joined texts each time."""
    out, held = [], []
    for piece in [p for p in text.split("\n") if p]:
        if held and join_length(held + [piece]) > size:
            out.append("\n".join(held))
            for start in range(len(held) + 1):
                rest = held[start:]
                if not rest or (
                    join_length(rest) <= overlap and join_length(rest + [piece]) <= size
                ):
                    held = rest
                    break
        held = held + [piece]
    out.append("\n".join(held))
    return [c.strip(" \t\r\n") for c in out if c.strip(" \t\r\n")]


@pytest.mark.parametrize("size,overlap", [(512, 32), (60, 40)])
def test_merge_mode(spark, small, size, overlap):
    docs = tables.read_table(spark, small, "documents").select("doc_id", "text")
    found = {}
    for r in chunking.chunk(docs, size, overlap, sep="\n").collect():
        found.setdefault(r["doc_id"], []).append((r["chunk_no"], r["page_content"]))
    for r in docs.collect():
        assert [c for _, c in sorted(found.get(r[0], []))] == merged(r[1], size, overlap)


def test_merge_split_never_exceeds_size(spark, small):
    docs = tables.read_table(spark, small, "documents")
    chunks = chunking.chunk(docs, sep="\n", oversize="split")
    assert chunks.agg(F.max(F.length("page_content"))).first()[0] <= 512


def test_null_document_has_no_chunks(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert chunking.chunk(docs, mode="window").count() == 0
    assert chunking.chunk(docs, mode="merge").count() == 0


def test_ids_do_not_depend_on_partitions(spark, small):
    docs = tables.read_table(spark, small, "documents")
    made = [
        chunking.with_chunk_id(chunking.chunk(docs.repartition(n), mode="window"))
        for n in (2, 5)
    ]
    assert made[0].exceptAll(made[1]).count() == 0
    assert made[0].select("id").distinct().count() == made[0].count()
    hashed = chunking.with_chunk_id(chunking.chunk(docs, mode="window"), numeric=False)
    assert hashed.select("id").distinct().count() == hashed.count()


def test_wrong_parameters(spark, small):
    docs = tables.read_table(spark, small, "documents")
    for wrong in ({"mode": "x"}, {"oversize": "x"}, {"mode": "window", "overlap": 512}):
        with pytest.raises(ValueError):
            chunking.chunk(docs, **wrong)


def test_window_guard(spark):
    df = spark.createDataFrame([("a b c",), ("a",)], "page_content string")
    rows = {r["page_content"]: r for r in chunking.window_guard(df, 2).collect()}
    assert rows["a b c"]["over_window"] and rows["a b c"]["model_input"] == "a b"
    assert not rows["a"]["over_window"]


def test_merge_chunks_hold_few_texts_at_a_time(spark, monkeypatch):
    """Texts are cut a slice of a batch at a time; nulls, empty texts and slice ends change nothing."""
    texts = [None if i % 7 == 0 else "" if i % 7 == 1 else "\n\n".join("x" * (j % 40 + 1) for j in range(i)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    made = chunking.chunk(docs, size=100, overlap=10)
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    want = [(i, n, p) for i, t in enumerate(texts) if t is not None for n, p in enumerate(chunking._merge(t, "\n\n", 100, 10, False))]
    assert sorted(map(tuple, made.collect())) == want
    assert made.schema.simpleString() == "struct<doc_id:bigint,chunk_no:int,page_content:string>"
