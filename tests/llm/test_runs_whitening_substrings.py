"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import common, periodic_runs, substring_dedup, whitening
from quernstone.llm.queries import QUERIES
from quernstone.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def plain_runs(words):
    """Every stretch that keeps a period, by comparing each word with the one a period on."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = words_in(text)
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    s, m, q = best or (None, None, None)
    return doc_id, len(runs), s, m, q, best and 1000 * m // q, sha(lines), sha(kept)


def test_runs_equal_plain_ones_on_every_short_binary_text():
    texts = [[b"ab"[k >> i & 1 : (k >> i & 1) + 1] for i in range(13)] for k in range(1 << 13)]
    for low in range(0, len(texts), 4096):
        part = texts[low : low + 4096]
        for words, found in zip(part, periodic_runs.runs_of(part), strict=True):
            assert [tuple(r) for r in found.tolist()] == plain_runs(words)


def _fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_plain_ones_on_nested_and_joined_periods():
    rng = random.Random(3)
    texts = [_fibonacci(300), "ab" * 40 + "a" + "ab" * 40, "a" * 200, ("aab" * 9 + "ab") * 6, "a" * 30 + "b" + "a" * 30]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = "".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 21)))
            parts.append((unit * rng.randint(1, 9))[: rng.randint(1, 90)])
        texts.append("".join(parts))
    split = [[c.encode() for c in t] for t in texts]
    for words, found in zip(split, periodic_runs.runs_of(split), strict=True):
        assert [tuple(r) for r in found.tolist()] == plain_runs(words)


def test_query_of_runs_equals_plain_rows(spark, folder, odd_docs):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    ids = [i for i in range(100_000, 101_000) if crc32(str(i).encode()) % 10 == 0][:20]
    more = [(i, " ".join(f"w{(7 * k) % (11 + i % 5)}" for k in range(i % 97))) for i in ids]
    docs = docs.filter("length(text) < 6000").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.unionAll(odd_docs.filter("length(text) < 5000 or text is null").select("doc_id", "text"))
    path = folder(documents=docs)
    found = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, path).collect()), key=repr)
    assert found == sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert sum(r[1] > 0 for r in found) > 20


def test_runs_of_odd_rows(spark, odd_docs):
    rows = periodic_runs.find_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for i in (1, 2, 3):
        assert by_id[i][0].runs == [] and by_id[i][0].collapsed_text == ""
    (long_run,) = by_id[4][0].runs
    assert (long_run.start, long_run.length, long_run.period) == (0, 60_000, 977)
    assert len(by_id[4][0].collapsed_text.split()) == 977
    assert by_id[5][0] == by_id[5][1]
    assert periodic_runs.find_runs(odd_docs.limit(0)).collect() == []


# Whitening


def test_whitening_equals_plain_arithmetic(spark, folder):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 0.2, (60, 12)).astype(np.float32) * np.linspace(1, 3, 12, dtype=np.float32)
    rows = [(i, [float(v) for v in base[i % 60 if i > 100 else 0]], i % 3) for i in range(300)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [None] * 12, 0), (1003, [math.nan] * 12, 0), (1004, [math.inf] + [0.0] * 11, 0)]
    rows += [(1005, [0.5] * 7, 0), (1006, [3e38] * 12, 0), (None, rows[7][1], 0), (5, rows[5][1], 0)]
    path = folder(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    found = QUERIES["op12_embedding_whitening"](spark, path).collect()
    good = [r for r in rows if r[0] is None or r[0] < 1000]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r[1]] for r in good])
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, columns = np.linalg.eigh(c.T @ c / n)
    values, columns = values[::-1], columns[:, ::-1]
    assert len(found) == 8 * n
    apart = {r[0]: int(((n * x[k].astype(object) - sums) ** 2).sum()) for k, r in enumerate(good)}
    want = {r[0]: c[k] @ columns[:, :8] / np.sqrt(values[:8]) for k, r in enumerate(good)}
    sign = {}
    for r in found:
        assert r.n == n and r.deviation == apart[r.vec_id] and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        plain = want[r.vec_id][r.component - 1]
        assert math.isclose(abs(r.whitened), abs(plain), rel_tol=1e-7, abs_tol=1e-8)
        if abs(plain) > 1e-3:
            assert sign.setdefault(r.component, plain * r.whitened > 0) == (plain * r.whitened > 0)


def test_each_vector_once_as_weight(spark):
    rows = [(i, [float(i % 4), float(i % 4 == 1)]) for i in range(40)] + [(99, [9.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(df, weights="one").collect()
    x = np.unique([[1024 * v + 100_000 for v in r[1]] for r in rows], axis=0)
    assert {r.n for r in found} == {5} and {r.component for r in found} == {1, 2} and len(found) == 82
    c = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(c.T @ c / 5)
    assert math.isclose(found[0].explained + found[1].explained, 1.0) and found[0].identity_error < 1e-9
    top = max(r.explained for r in found)
    assert math.isclose(top, values[-1] / values.sum(), rel_tol=1e-9)


def test_whitening_without_spread_or_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == [] and whitening.whiten(same.limit(0)).collect() == []
    nulls = spark.createDataFrame([(1, None)], "vec_id string, embedding array<float>")
    assert whitening.whiten(nulls).collect() == []
    clash = same.unionAll(spark.createDataFrame([(3, [4.0, 2.0])], same.schema)).withColumn("key", F.lit(1)).withColumn("n", F.lit(2)).withColumn("x", F.lit(2))
    assert sorted((r.vec_id, r.component) for r in whitening.whiten(clash).collect()) == [(1, 1), (2, 1), (3, 1)]


def test_deviation_beyond_long_is_exact(spark):
    rows = [(1, [float(1 << 40)]), (2, [-float(1 << 40)]), (3, [0.5])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [math.floor(1024 * r[1][0]) + 100_000 for r in rows]
    assert {r.vec_id: int(r.deviation) for r in found} == {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x, 1)}


# Substring dedup


def plain_removal(docs, width):
    first = {}
    for i, text in docs:
        words = words_in(text)
        for k in range(len(words) - width + 1) if i is not None else ():
            key = tuple(words[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text in docs:
        words, gone = words_in(text), set()
        for k in range(len(words) - width + 1) if i is not None else ():
            if first[tuple(words[k : k + width])] < i:
                gone |= set(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, kept, len(words), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("period", [1, 2, 7, 12, 16, 17, 25, 60])
def test_covers_give_every_distance(period):
    cover = substring_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize(("width", "few"), [(13, substring_dedup.FEW), (13, 0), (5, 0), (40, substring_dedup.FEW), (1, 0)])
def test_removal_equals_comparing_every_window(spark, make_docs, width, few):
    rng = random.Random(width)
    passages = [[f"p{k}_{j}" for j in range(n)] for k, n in enumerate((12, 13, 14, 25, 60, 200))]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"u{rng.randint(0, 60)}" for _ in range(rng.randint(0, 30))]
            one = rng.choice(passages)
            low = rng.randint(0, len(one) // 2)
            words += one[low : low + rng.randint(5, len(one))]
        rows.append((rng.randint(0, 90), " ".join(words)))
    rows += [(500, rows[0][1]), (500, rows[0][1]), (500, rows[1][1]), (None, rows[2][1]), (None, None), (501, None), (502, "")]
    found = substring_dedup.remove_repeated(make_docs(rows), width=width, few=few)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_removal(rows, width)


def test_removal_on_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = substring_dedup.remove_repeated(odd_docs).collect()
    assert sorted(map(tuple, found), key=repr) == plain_removal(rows, 13)
    assert substring_dedup.remove_repeated(odd_docs.limit(0)).collect() == []


def test_a_passage_in_every_document_is_spread_over_salts(spark, make_docs):
    passage = " ".join(f"x{k}" for k in range(20))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(3000)]
    found = substring_dedup.remove_repeated(make_docs(rows)).collect()
    assert {(r.doc_id == 0, r.n_removed) for r in found} == {(True, 0), (False, 20)}


def test_joins_with_hot_keys_lose_and_repeat_nothing(spark):
    """Keys of bytes and of two columns, one of them with a third of all rows."""
    rows = [(i, bytes([i % 200 if i % 3 else 7]) * 16, i % 200 if i % 3 else 7, i % 2) for i in range(9000)]
    left = spark.createDataFrame(rows, "row long, cls binary, a long, b int").filter("row != 5")
    for keys in ("cls", ["a", "b"]):
        one = [keys] if isinstance(keys, str) else keys
        counts = left.groupBy(*one).agg(F.count("*").alias("n")).withColumn("v", F.col("n") * 2).filter("n != 45")
        found = common.join_by_counts(left, counts, keys, "n", 9000)
        assert sorted(r.row for r in found.collect()) == sorted(r.row for r in left.join(counts, one).collect())
        assert found.columns == [*one, *[c for c in left.columns if c not in one], "n", "v"]


def test_membership_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(50_000).select(F.xxhash64("id").alias("h"))
    test = common.membership(keys, F.col("h"), 1 << 20)
    values = np.array([r.h for r in spark.range(100_000).select(F.xxhash64("id").alias("h")).collect()], np.int64)
    found = test(values)
    assert found[:50_000].all() and found[50_000:].mean() < 0.01


def test_few_keys_make_a_small_filter(spark):
    assert common.filter_bits(0) == common.filter_bits(1) == common.LEAST_BITS
    assert common.filter_bits(1 << 40) == common.SKETCH_BITS
    assert common.filter_bits(100_000) == 1 << 22
    keys = spark.range(5000)
    common.release_filters()
    test = common.may_be_in(keys, "id")
    assert common._filters[-1].value.nbytes <= common.LEAST_BITS // 8  # 8 MB, whatever the number of keys
    rows = spark.range(100_000).select("id", test(F.xxhash64("id")).alias("known"))
    assert rows.where("known and id < 5000").count() == 5000
    assert rows.where("known and id >= 5000").count() < 200


def test_a_query_releases_the_filters_of_those_before(spark):
    common.may_be_in(spark.range(10), "id")
    assert common._filters
    common.documents(spark, SMALL)
    assert not common._filters
