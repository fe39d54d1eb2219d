"""Near duplicates, packing, decontamination and line dedup against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quernstone.llm import decontamination, line_dedup, near_dedup, packing, queries, token_counts, tokens
from quernstone.llm.common import documents, read_table

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_components(rows):
    """Smallest id reachable per id, by testing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for g in s for j in by[g] if j > i)
        for j, common in shared.items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for i in sorted(sets):
        least.setdefault(root(i), i)
    return {i: (len(sets[i]), least[root(i)]) for i in sets}


def found_components(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_duplicates_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    found = queries.op5_minhash_near_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_copies_in_large_bands(make_docs, monkeypatch):
    """Many variants of one text and of texts just below the threshold, with small bands and blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randrange(1, 7)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    assert found_components(near_dedup.near_duplicates(make_docs(rows))) == brute_components(rows)


def test_a_band_of_minor_classes_is_cut_on_both_sides(spark):
    """No group holds all minors of a band, and each pair of a minor with another class meets in one group."""
    n, block = 200, 10
    for minors in (199, 60, 1):
        rows = spark.range(n).select(
            F.lit(7).cast("long").alias("key"), F.col("id").alias("uid"), (F.col("id") < minors).alias("minor"),
            F.lit(n).cast("long").alias("size"), F.lit(minors).cast("long").alias("minors"),
        )
        groups = defaultdict(list)
        for r in near_dedup._dealt(rows, block).collect():
            groups[r.part, r.block].append(r)
        assert max(map(len, groups.values())) <= 6 * block
        met = Counter((a.uid, b.uid) for held in groups.values() for a in held if a.asks for b in held if b.here)
        assert met == {(a, b): 1 for a in range(minors) for b in range(n)}


def test_templated_texts_under_the_threshold(make_docs, monkeypatch):
    """A template that all texts share to about 65 %, with a few true near copies among them."""
    for name, value in (("SMALL", 2), ("BLOCK", 8), ("SKETCHES", 16)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(6)
    template = [f"t{k}" for k in range(160)]
    own = lambda: [f"u{rng.randrange(10**7)}" for _ in range(40)]
    rows = [(i, " ".join(template + own())) for i in range(70)]
    rows += [(100 + i, t.rsplit(" ", 3)[0]) for i, t in rows[::9]]
    found = found_components(near_dedup.near_duplicates(make_docs(rows)))
    assert found == brute_components(rows)
    assert 60 < len({c for _, c in found.values()}) < len(rows)


def test_near_duplicates_of_odd_rows(odd_docs, make_docs):
    found = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd_docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (None, None, True), (None, None, True)]
        + [(5, 5, True), (5, 5, True), (6, 5, False), (7, 7, True), (8, 8, True), (9, 9, True)],
        key=str,
    )
    assert near_dedup.near_duplicates(make_docs([])).count() == 0


def test_ids_are_those_of_the_plain_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    for text in ("hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>  b\n<|endoftext", "é 你好 <|endoftext|>!"):
        assert tokens.encoder(queries.vocabulary()).ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_the_program_is_solved_to_its_bound():
    """A histogram that best fit packs into 948 sequences and its best configurations into 934."""
    histogram = {522: 600, 277: 600, 266: 600, 236: 1200}
    groups, least = packing.pack_histogram(histogram, 1024)
    total = sum(n for _, n in groups)
    assert least <= total <= 936 and total <= 1.01 * least
    solution, bound = packing.solve(histogram, 1024)
    for length, n in histogram.items():
        assert sum(found.get(length, 0) * times for found, times in solution) >= n - 1e-6
    assert bound <= sum(times for _, times in solution) and bound <= 934


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    rows = queries.op6_best_fit_packing(spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for d in documents(spark, SF).collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        mine = sorted(pieces[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        at = 0
        for r in mine:
            part = ids[at : at + r.length]
            assert r.start == at and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1


@pytest.mark.parametrize("seed", range(4))
def test_configurations_cover_every_length(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 65): rng.randrange(1, 200) for _ in range(30)}
    groups, least = packing.pack_histogram(histogram, 64)
    packed = Counter()
    for found, times in groups:
        assert sum(a * b for a, b in found.items()) <= 64
        for length, n in found.items():
            packed[length] += n * times
    assert dict(packed) == histogram
    total = sum(n for _, n in groups)
    plain = sum(n for _, n in packing.best_fit([], histogram, 64))
    assert least <= total <= plain


def test_knapsack_is_optimal():
    import numpy as np

    rng = random.Random(5)
    for _ in range(20):
        prices = np.full(31, -np.inf)
        for length in rng.sample(range(1, 31), 6):
            prices[length] = rng.random()
        best = [0.0] * 31
        for room in range(1, 31):
            best[room] = max([best[room - 1]] + [best[room - k] + prices[k] for k in range(1, room + 1)])
        found = packing.knapsack(prices, 30)
        assert sum(k * n for k, n in found.items()) <= 30
        assert abs(sum(prices[k] * n for k, n in found.items()) - best[30]) < 1e-9


def test_packing_of_odd_rows(odd_docs, make_docs):
    rows = packing.pack(odd_docs, queries.vocabulary()).collect()
    ends = [r for r in rows if r.length == 1]
    assert len(ends) == 3 and len(rows) > 12  # the null and empty texts
    spans = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:], strict=False))
    assert packing.pack(make_docs([]), queries.vocabulary()).count() == 0


def test_length_histogram_answers(spark):
    docs = documents(spark, SF)
    lengths = defaultdict(list)
    for r in docs.select("lang", token_counts.length_udf(queries.vocabulary())("text").alias("n")).collect():
        lengths[r.lang].append(r.n)
    sums = queries.op9_token_counts(spark, SF)
    for r in sums.collect():
        own = lengths[r.grp]
        assert r.docs == own.count(r.n_tokens)
        assert r.docs_at_least == sum(n >= r.n_tokens for n in own)
        assert r.tokens_at_least == sum(n for n in own if n >= r.n_tokens)
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in own)
        assert r.total_tokens == sum(own)
    for r in token_counts.at_limits(sums, [0, 100, 1024, 10**6]).collect():
        assert r.kept_tokens == sum(min(n, r.context) for n in lengths[r.grp])
        assert r.over_docs == sum(n > r.context for n in lengths[r.grp])
    for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        own = sorted(lengths[r.grp])
        assert r.n_tokens == next(n for k, n in enumerate(own, 1) if k >= r.share * len(own))


def test_histogram_of_odd_rows(odd_docs, make_docs):
    rows = {r.n_tokens: r.docs for r in token_counts.length_histogram(odd_docs, queries.vocabulary()).collect()}
    assert sum(rows.values()) == 12 and rows[0] == 3
    assert token_counts.with_suffix_sums(token_counts.length_histogram(make_docs([]), queries.vocabulary())).count() == 0


def brute_passages(docs, items):
    out = set()
    for item, text in items:
        w = words(text)
        grams = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
        for doc, body in docs:
            b = words(body)
            n = min(len(w), len(b))
            if not n or not any(tuple(b[i : i + 5]) in grams for i in range(max(1, len(b) - 4))):
                continue
            for at in range(len(b) - n + 1):
                part = b[at : at + n]
                have = Counter(tuple(part[i : i + 5]) for i in range(max(1, n - 4)))
                common = sum((have & grams).values())
                if 100 * common >= 75 * (have.total() + grams.total() - common):
                    out.add((doc, item))
                    break
    return out


def test_passages_of_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    rows = queries.op8_decontamination(spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute_passages(docs, items)


def test_near_passages_at_any_place(spark, make_docs):
    rng = random.Random(8)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((6, 9, 15, 22, 40, 61, 90))]
    docs = []
    for i in range(300):
        item = words(rng.choice(items)[1])
        kind = i % 4
        if kind == 1:
            item = item[: max(1, int(len(item) * 0.9))]
        if kind == 2:
            item[rng.randrange(len(item))] = "changed"
        if kind == 3:
            item = [w.upper() for w in item]
        docs.append((i, " ".join([word() for _ in range(rng.randrange(60))] + item + [word() for _ in range(rng.randrange(60))])))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_passages(make_docs(docs), table).collect()}
    wanted = brute_passages(docs, items)
    assert found <= wanted and len(found) >= 0.99 * len(wanted)


def test_multi_index_finds_all_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(4)
    own = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    flips = np.zeros(3000, np.uint64)
    for k in range(3000):
        for b in rng.choice(64, k % 20, replace=False):
            flips[k] |= np.uint64(1) << np.uint64(b)
    prints = own[np.arange(3000) % 200] ^ flips
    table = decontamination.ItemIndex._table(own, np.arange(200), np.zeros(200, np.int64))
    window, mine = decontamination.ItemIndex.near(table, prints)
    near = np.bitwise_count(prints[:, None] ^ own[None]) <= decontamination.RADIUS
    assert set(zip(window.tolist(), mine.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_passages_of_odd_rows(spark, odd_docs, make_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "one two")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.find_passages(odd_docs, items).collect()] == [(7, 3)]
    assert decontamination.find_passages(make_docs([]), items).count() == 0
    assert decontamination.find_passages(odd_docs, items.limit(0)).count() == 0
    assert decontamination.clean_documents(odd_docs, items).count() == 11


def test_repeated_chunks(make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"Own line {i} of document number {i}.\n{passage}\nLast line of {i}.") for i in range(5)]
    out = {r.doc_id: r.clean_text for r in line_dedup.remove_repeated(make_docs(rows)).collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == f"Own line {i} of document number {i}.\nLast line of {i}." for i in range(1, 5))


@pytest.mark.parametrize(("n_lines", "n_words"), [(2, 30), (3, 20), (4, 15), (6, 10), (12, 10), (20, 10), (40, 6)])
def test_passages_of_short_lines_go(make_docs, n_lines, n_words):
    """Passages planted in two documents each, between lines of their own: the second loses them, own lines stay."""
    rng = random.Random(n_lines)
    prose = lambda n, m: [" ".join(f"w{rng.randrange(10**6)}" for _ in range(m)) for _ in range(n)]
    rows, planted, own = [], {}, {}
    for k in range(30):
        passage = prose(n_lines, n_words)
        for i in (k, 100 + k):
            head, tail = prose(rng.randrange(5), 12), prose(rng.randrange(5), 12)
            planted[i], own[i] = passage, head + tail
            rows.append((i, "\n".join(head + passage + tail)))
    out = {r.doc_id: r.clean_text.split("\n") for r in line_dedup.remove_repeated(make_docs(rows)).collect()}
    assert all(out[i] == t.split("\n") for i, t in rows if i < 100)
    left = sum(len(set(out[i]) & set(planted[i])) for i in planted if i >= 100)
    assert left <= 0.1 * 30 * n_lines
    assert all(set(own[i]) <= set(out[i]) for i in own)


def test_passage_shared_by_many_in_a_copied_document(make_docs):
    """Pairs inside the passage occur far oftener than those at its edges, though all of the copies' pairs repeat."""
    passage = [f"passage line {k} with six words" for k in range(9)]
    whole = "\n".join([*(f"opening line {k} of the copied text" for k in range(4)), *passage, "a closing line of it", "the very end of it"])
    rows = [(1, whole), (2, whole)] + [(i, "\n".join([f"own start of {i}", *passage, f"own end of {i}"])) for i in range(3, 9)]
    out = {r.doc_id: r.clean_text for r in line_dedup.remove_repeated(make_docs(rows)).collect()}
    assert out[1] == whole and out[2] == ""
    assert all(out[i] == f"own start of {i}\nown end of {i}" for i in range(3, 9))


def test_line_dedup_keeps_columns_of_any_name(make_docs):
    docs = make_docs([(1, "one line of a text\nand another one of it, of ten words"), (2, "one line of a text\nand another one of it, of ten words")])
    for name in ("row", "digest", "marks", "gone", "other_id", "__doc", "__gone", "out", "a.b"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = line_dedup.remove_repeated(docs).orderBy("doc_id").collect()
    assert [r.n_removed_lines for r in rows] == [0, 2] and all(r["a.b"] == r["row"] == r["marks"] == "x" for r in rows)


def test_boundaries_come_back_after_an_insertion():
    rng = random.Random(2)
    lines = [" ".join(f"w{rng.randrange(999)}" for _ in range(8)) for _ in range(200)]
    before = {tuple(lines[a : a + n]) for a, n, _ in line_dedup.chunks("\n".join(lines))}
    moved = ["a new line at the top", *lines]
    after = {tuple(moved[a : a + n]) for a, n, _ in line_dedup.chunks("\n".join(moved))}
    assert len(before & after) >= len(before) - 2


def test_line_dedup_of_odd_rows(odd_docs, make_docs):
    rows = line_dedup.remove_repeated(odd_docs).select("doc_id", "clean_text", "text", "n_removed_lines").collect()
    assert len(rows) == 12
    assert all(r.clean_text is None for r in rows if r.text is None)
    assert {r.clean_text for r in rows if r.doc_id == 2} == {""}
    assert {r.n_removed_lines for r in rows if r.doc_id in (1, 2, 3, 7, 8, 9)} == {0}
    assert len({r.clean_text for r in rows if r.doc_id == 5}) == 1
    assert all(r.n_removed_lines > 0 for r in rows if r.doc_id == 6)
    assert line_dedup.remove_repeated(make_docs([])).count() == 0


def test_confirmed_links_only(spark, make_docs):
    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:80] + [f"y{i}" for i in range(20)]))]
    assert {r.component_id for r in near_dedup.near_duplicates(make_docs(rows)).collect()} == {1, 2}
    assert near_dedup.near_duplicates(make_docs(rows)).filter(F.col("kept")).count() == 2
