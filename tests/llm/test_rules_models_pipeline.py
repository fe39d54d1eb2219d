"""Quality rules, sharding, the three models and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from quernstone.llm import gru, language_id, language_model, line_dedup, quality_classifier, quality_rules, queries, sharding
from quernstone.llm.common import documents, materialize, read_table
from quernstone.llm.oracle import ORACLE
from test_near_and_packing import brute_components, brute_passages

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_queries_equal_their_sql(spark):
    con = compare.connect(SMALL)
    for name, sql in ORACLE.items():
        _, problem = compare.compare(spark, con, queries.QUERIES[name], sql, SMALL)
        assert not problem, (name, problem)


def brute_repeats(words):
    n = len(words) - 4
    grams = Counter(tuple(words[i : i + 5]) for i in range(max(0, n)))
    return len({i + k for i in range(max(0, n)) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)})


def test_repeated_words_against_brute_force():
    rng = random.Random(1)
    for size in (0, 1, 4, 5, 6, 12, 60, 400):
        for kinds in (1, 2, 3, 9, 60):
            words = [b"w%d" % rng.randrange(kinds) for _ in range(size)]
            assert quality_rules.repeat_words(words) == brute_repeats(words)


def test_line_rules():
    cases = {
        "Home | About | Contact": "navigation",
        "a### b$$$ c%%%": "symbols",
        "BUY NOW AND HERE": "shouting",
        "go! go! go!": "shouting",
        "a a a b b b c c": "stutter",
        "See our Privacy Policy.": "boilerplate",
        "12 34 56": "letters",
        "Read on": "punctuation",
        "A plain sentence that ends well.": None,
        "a sentence without an end but with words": None,
    }
    for line, rule in cases.items():
        assert quality_rules.line_rule(line, line.encode().split()) == rule, line


def test_quality_rules_of_odd_rows(odd_docs, make_docs):
    rows = quality_rules.apply_rules(odd_docs).collect()
    assert len(rows) == 12 and all(isinstance(r.kept, bool) for r in rows)
    assert {r.kept for r in rows if r.doc_id in (1, 2, 3, 7, 8, 9)} == {False}
    assert {r.n_words for r in rows if r.doc_id == 4} == {60_000}
    assert quality_rules.apply_rules(make_docs([])).count() == 0
    judged = quality_rules.judge("Home | News | More\n" * 2 + "A fine sentence with quite a few words in it.\n")
    assert judged[-2:] == (False, "A fine sentence with quite a few words in it.\n")


def shards_of(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r.depth, r.shard, r.page)].append(r)
    return out


def test_shards_fit_and_split_only_when_needed(spark):
    for limit in (2_000, 50_000, 10**9):
        rows = sharding.assign(documents(spark, SF), limit).collect()
        assert len(rows) == 1000
        shards = shards_of(rows)
        sizes = {k: sum(r.bytes for r in held) for k, held in shards.items()}
        assert all(size <= limit or len(shards[k]) == 1 for k, size in sizes.items())
        assert all(r.shard_bytes == sizes[k] for k, held in shards.items() for r in held)
        names = sorted(shard for _, shard, _ in shards)
        assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False) if a != b)
        for depth, shard, _ in shards:  # the bucket it was split from was too large
            if depth:
                assert sum(size for (_, s, _), size in sizes.items() if s.startswith(shard[:-1])) > limit


def test_equal_rows_go_to_pages(make_docs, odd_docs):
    docs = make_docs([(1, "x" * 100)] * 57 + [(2, "y" * 30)])
    rows = sharding.assign(docs, 1000).collect()
    assert len(rows) == 58
    assert all(sum(r.bytes for r in held) <= 1000 for held in shards_of(rows).values())
    assert sharding.assign(odd_docs, 500).count() == 12
    assert sharding.assign(make_docs([]), 500).count() == 0


def test_quality_scores_separate_held_out_labels(spark):
    rows = {r.doc_id: r for r in queries.op3_quality_classifier(spark, SF).collect()}
    labels = [(rows[r.doc_id], r.quality) for r in read_table(spark, SF, "labels").collect()]
    held = [(r.score, q) for r, q in labels if r.held_out]
    good, bad = (np.array([s for s, q in held if q == k]) for k in (1, 0))
    assert all(r.held_out == (crc(i, 5) == 0) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    assert (good[:, None] > bad[None]).mean() > 0.85


def plain_buckets(text):
    """Every word, n-gram of characters and pair of neighbours of a text, hashed one by one."""
    factors = [int(f) for f in quality_classifier._FACTORS]
    whole = 1 << 64

    def mixed(x):
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD % whole
        x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 % whole
        return x ^ (x >> 33)

    spelled, found = [], Counter()
    for word in text.split():
        marked = [ord(c) for c in f"<{word}>"]
        spelled.append(mixed(sum(mixed((c * factors[5] + i * factors[6]) % whole) for i, c in enumerate(marked)) % whole))
        found[spelled[-1] % quality_classifier.BUCKETS] += 1
        for n in quality_classifier.GRAMS:
            for i in range(len(marked) - n + 1):
                total = n + sum(c * f for c, f in zip(marked[i : i + n], factors, strict=False))
                found[mixed(total % whole) % quality_classifier.BUCKETS] += 1
    for one, two in zip(spelled, spelled[1:], strict=False):
        found[mixed((one * factors[0] + two * factors[1]) % whole) % quality_classifier.BUCKETS] += 1
    return found


def test_long_words_count_whole_and_by_characters(monkeypatch):
    rng = random.Random(4)
    long_word = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3000))
    logit = np.random.default_rng(1).normal(size=quality_classifier.BUCKETS).astype(np.float32)
    texts = ["a", "éß", "plain words and plain words again", "你好世界" * 3, "ab" * 40 + "é", f"the {long_word} the end", "x x x x"]
    for stretch in (1 << 20, 50):
        monkeypatch.setattr(quality_classifier, "STRETCH", stretch)
        model = quality_classifier.Model(logit, 0.25)
        together = model.scores([None, *texts, ""])
        assert together[0] == together[-1] == model.score(" ") == 1 / (1 + np.exp(-0.25))
        for text, score in zip(texts, together[1:-1], strict=True):
            wanted = plain_buckets(text)
            ids, weights = quality_classifier.document_features(text)
            assert dict(zip(ids.tolist(), np.round(weights.astype(float) * wanted.total()).astype(int).tolist(), strict=True)) == wanted
            plain = 0.25 + sum(float(logit[k]) * c for k, c in wanted.items()) / wanted.total()
            assert abs(score - 1 / (1 + np.exp(-plain))) < 1e-6 and abs(model.score(text) - score) < 1e-12
    assert model.score("文" * 50 + "a" * 500) != model.score("文" * 50 + "b" * 500)


def test_a_worker_forgets_words_it_has_no_room_for(monkeypatch):
    logit = np.random.default_rng(1).normal(size=quality_classifier.BUCKETS).astype(np.float32)
    texts = [f"w{i} w{i + 1} w{2 * i}" for i in range(40)]
    wanted = quality_classifier.Model(logit, 0.0).scores(texts)
    monkeypatch.setattr(quality_classifier, "KEPT", 5)
    model = quality_classifier.Model(logit, 0.0)
    assert np.allclose([model.score(t) for t in texts], wanted) and len(model._known) < 10


def test_quality_of_odd_rows(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality_classifier.train(quality_classifier.training_rows(odd_docs, labels, F.lit(True)))
    scores = [r.s for r in odd_docs.select(quality_classifier.score_udf(model)("text").alias("s")).collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    none = quality_classifier.train(quality_classifier.training_rows(odd_docs, labels.limit(0), F.lit(True)))
    assert {none.score(t) for t in (None, "", "some words")} == {0.5}
    assert quality_classifier.training_rows(make_docs([]), labels, F.lit(True)) == []


def test_languages_of_held_out_documents(spark):
    rows = queries.op4_language_id(spark, SF).collect()
    langs = {r.doc_id: r.lang for r in documents(spark, SF).collect()}
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean(held) > 0.97


def test_language_of_odd_rows(odd_docs, make_docs):
    model = language_id.train([([b"the cat and the dog"] * 3, "en"), ([b"le chat et le chien"] * 3, "fr")])
    rows = odd_docs.select("doc_id", "text", language_id.predict_udf(model)("text").alias("p")).collect()
    assert all((r.p.lang_pred == "und") == (r.text is None or not any(map(str.isalpha, r.text))) for r in rows)
    assert language_id.training_rows(make_docs([]), F.lit(True)) == []
    assert language_id.train([]).predict(["text", None]) == [("und", 0.0)] * 2


def plain_label(model, text):
    """One byte, one window and one text at a time: the averages of the softmax over both states."""
    data, width, total = text.encode(), language_id.WIDTH, 0

    def states(name, symbols):
        table, u, h, out = model.params[f"table_{name}"], model.params[f"u_{name}"], np.zeros(width), []
        for x in symbols:
            a, c = table[x].astype(float), h @ u.astype(float)
            z, r = (1 / (1 + np.exp(-(a[k : k + width] + c[k : k + width]))) for k in (0, width))
            n = np.tanh(a[2 * width :] + r * c[2 * width :])
            h = n + z * (h - n)
            out.append(h)
        return out

    for at in range(0, len(data), language_id.WINDOW):
        part = list(data[at : at + language_id.WINDOW])
        whole = part + [language_id.PAD] * (language_id.WINDOW - len(part))
        ahead, behind = states("a", whole), states("b", whole[::-1])[::-1]
        for one, two in list(zip(ahead, behind, strict=True))[: len(part)]:
            logits = np.concatenate([one, two]) @ model.params["out"] + model.params["bias"]
            p = np.exp(logits - logits.max())
            total = total + p / p.sum()
    return model.names[int(np.argmax(total))], float(np.max(total) / len(data))


def test_labels_of_texts_together_equal_plain_ones(monkeypatch):
    model = language_id.train([([b"the cat and the dog"] * 3, "en"), ([b"le chat et le chien"] * 3, "fr"), ([b"der hund"], "de")])
    texts = ["the dog", "le chien et le chat " * 20, "x", "é" * 100, "the cat " * 16, "der " * 200, None, "12"]
    for together in (2048, 3):
        monkeypatch.setattr(language_id, "TOGETHER", together)
        for text, (name, score) in zip(texts[:6], model.predict(texts), strict=False):
            wanted, share = plain_label(model, text)
            assert name == wanted and abs(score - share) < 1e-4, text
    assert model.predict(texts)[6:] == [("und", 0.0)] * 2


def test_learning_rows_are_whole_texts_of_every_language(spark, make_docs):
    rows = [(i, f"text {i} " * 60) for i in range(400)]
    docs = make_docs(rows).withColumn("lang", F.when(F.col("doc_id") % 20 == 0, "xx").when(F.col("doc_id") % 7 > 0, "en"))
    found = language_id.training_rows(docs, F.lit(True), max_rows=24)
    texts = {t.encode(): i for i, t in rows}
    names = Counter(name for _, name in found)
    assert names == {"en": 12, "xx": 12}
    assert all((texts[b"".join(windows)] % 20 == 0) == (name == "xx") for windows, name in found)
    assert len(language_id.training_rows(docs, F.lit(True), max_rows=1000)) == docs.filter("lang is not null").count()


def test_gradients_of_the_unit():
    rng = np.random.default_rng(0)
    cell = {k: v.astype(np.float64) for k, v in gru.new_cell(rng, 7, 3).items()}
    symbols, zero = rng.integers(0, 7, (5, 2)), np.zeros((2, 3), np.float32)
    weights = rng.normal(size=(5, 2, 3))
    loss = lambda: float((gru.run(cell, symbols, zero)[0] * weights).sum())
    _, kept = gru.run(cell, symbols, zero, True)
    found = gru.back(cell, symbols, kept, weights)
    for name, at in (("u", (1, 4)), ("u", (2, 8)), ("u", (0, 0)), ("table", (int(symbols[0, 0]), 5)), ("table", (int(symbols[2, 1]), 1))):
        kept_value = cell[name][at]
        cell[name][at] = kept_value + 1e-2
        up = loss()
        cell[name][at] = kept_value - 1e-2
        down = loss()
        cell[name][at] = kept_value
        assert abs((up - down) / 2e-2 - found[name][at]) < 2e-3


def test_base_and_model_of_a_corpus(spark):
    docs = documents(spark, SF).collect()
    counts = Counter()
    for d in docs:
        if crc(d.doc_id, 7) != 2:
            counts.update([*language_model.tokens_of(d.text), b""])
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in queries.op10_language_model(spark, SF).collect()}
    for d in docs:
        tokens, r = [*language_model.tokens_of(d.text), b""], rows[d.doc_id]
        base = sum(np.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
        assert r.held_out == (crc(d.doc_id, 7) == 2)
    held = [r for r in rows.values() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.15  # log10 a token


def test_rows_of_a_table_move_as_in_the_whole_table():
    rng = np.random.default_rng(6)
    cell = gru.new_cell(rng, 9, 4)
    symbols = rng.integers(0, 6, (7, 3))
    _, kept = gru.run(cell, symbols, np.zeros((3, 4), np.float32), True)
    d_out = rng.normal(size=(7, 3, 4)).astype(np.float32)
    whole, (met, values) = gru.back(cell, symbols, kept, d_out)["table"], gru.back(cell, symbols, kept, d_out, rows=True)["table"]
    assert met.tolist() == sorted(set(symbols.ravel().tolist())) and np.allclose(whole[met], values)
    assert not whole[[k for k in range(9) if k not in met]].any()
    one, two = ({"table": cell["table"].copy()} for _ in range(2))
    gru.Adam(one, 0.1).step({"table": whole / 5})
    gru.Adam(two, 0.1).step({"table": (met, values)}, share=1 / 5)
    assert np.allclose(one["table"], two["table"], atol=1e-6)


def test_words_of_equal_counts_are_the_models_own(spark, make_docs, monkeypatch):
    """More words of one count than are broadcast: the first by spelling still get numbers of their own."""
    monkeypatch.setattr(language_model, "HEAD", 10)
    docs = make_docs([(i, " ".join(f"u{i}x{k:02d}" for k in range(30))) for i in range(4)])
    words = language_model.lexicon(materialize(language_model.word_counts(docs), "word-counts"))
    assert len(words.own) == 121 and words.own[b"u0x00"] == 2 and words.own[b"u3x29"] == 121
    assert {language_model.input_row(b"never seen")} <= set(range(language_model.VOCABULARY, language_model.VOCABULARY + language_model.HASHED))
    rows = language_model.score_documents(docs, F.lit(True)).collect()
    assert all(np.isfinite(r.score) and r.n_known == 31 for r in rows)


def test_probabilities_sum_to_one():
    model = language_model.new_model()
    states = np.random.default_rng(1).normal(size=(1, language_model.WIDTH)).astype(np.float32)
    every = np.arange(language_model.VOCABULARY)
    found, _ = language_model.log_probabilities(model, np.repeat(states, len(every), axis=0), every)
    assert abs(np.exp(found).sum() - 1) < 1e-3


def test_state_is_carried_across_windows():
    """Scoring in windows equals one run over the whole document, for documents of any lengths together."""
    model = language_model.new_model()
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 4096, n), 0) for n in (0, 3, 31, 32, 33, 200, 64)]
    found = language_model.log10_of(model, docs)
    for doc, score in zip(docs, found, strict=True):
        inputs = np.concatenate([[0], doc[:-1]])[:, None]
        states, _ = gru.run(model, inputs, np.zeros((1, language_model.WIDTH), np.float32))
        whole, _ = language_model.log_probabilities(model, states[:, 0], doc)
        assert abs(whole.sum() / np.log(10) - score) < 1e-3 * abs(score) + 1e-3


def test_every_token_is_learned_from(spark, make_docs):
    """Few long documents of one cycle of words: all their tokens reach a trainer, and the model learns the order."""
    cycle = [f"w{k * 7 % 40}" for k in range(40)]
    rows = [(i, " ".join((cycle * 500)[i : i + 15_000 + i])) for i in range(6)] + [(6, ""), (7, "w1"), (8, None)]
    docs = make_docs(rows)
    words = language_model.lexicon(materialize(language_model.word_counts(docs), "word-counts"))
    found = language_model._stretches(docs, spark.sparkContext.broadcast(words)).collect()
    taken = [np.frombuffer(r.tokens, "<i2") for r in found]
    assert sum(len(t) - 1 for t in taken) == words.tokens == sum(15_001 + i for i in range(6)) + 1 + 2 + 1
    learned = Counter(int(k) for t in taken for k in t[1:])
    assert learned == {words.own[w]: c for w, c in words.head.items()}
    whole = language_model._numbers(language_model.tokens_of(rows[3][1]), words.own)
    parts = language_model.stretches_of(whole)
    assert [int(k) for p in parts for k in p[1:]] == whole
    assert [int(p[0]) for p in parts[1:]] == [int(p[-1]) for p in parts[:-1]]
    scored = {r.doc_id: r for r in language_model.score_documents(docs, F.expr("doc_id < 5 or doc_id > 5")).collect()}
    assert scored[5].score > 0.5 * scored[5].base_score


def test_rare_words_are_joined(spark, make_docs, monkeypatch):
    """With almost nothing broadcast, the base still holds."""
    monkeypatch.setattr(language_model, "HEAD", 3)
    docs = make_docs([(i, " ".join(f"w{k % (i + 2)}" for k in range(20))) for i in range(12)] + [(50, None), (51, ""), (None, "w1 unseen")])
    rows = language_model.score_documents(docs, F.expr("doc_id < 10")).collect()
    counts = Counter(t for i in range(10) for t in [*(b"w%d" % (k % (i + 2)) for k in range(20)), b""])
    n, v = sum(counts.values()), len(counts)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        tokens = [*language_model.tokens_of(texts[r.doc_id]), b""]
        assert abs(r.base_score - sum(np.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)) < 1e-6
        assert r.n_known == sum(counts[t] > 0 for t in tokens) and np.isfinite(r.score)
    assert len(rows) == 15


def test_model_without_anything_to_learn(make_docs, odd_docs):
    rows = language_model.score_documents(odd_docs, F.lit(False)).collect()
    assert len(rows) == 12 and {(r.base_score, r.score, r.train_tokens) for r in rows} == {(0.0, 0.0, 0)}
    assert language_model.score_documents(make_docs([]), F.lit(True)).count() == 0


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept."""
    start = docs = documents(spark, SMALL)
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs.collect()
        docs = materialize(stage(spark, docs, SMALL), "stage")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.schema.names == start.schema.names
        if name == "quality_rules":
            kept = {r.doc_id: v[-1] for r in before if (v := quality_rules.judge(r.text))[-2]}
            assert {i: r.text for i, r in after.items()} == kept
        if name == "line_dedup":
            assert set(after) == {r.doc_id for r in before}
            first = {}
            neighbours = Counter(p for r in before for p in pairwise(r.text.split("\n")))
            for r in sorted(before, key=lambda r: r.doc_id):
                lines, out = r.text.split("\n"), []
                long = [len(line_dedup.words_of(line)) >= line_dedup.PASSAGE for line in lines]
                counts = {k: neighbours[p] for k, p in enumerate(pairwise(lines)) if not long[k] and not long[k + 1]}
                for at, n, w in line_dedup.chunks(r.text, counts):
                    chunk = "\n".join(lines[at : at + n])
                    if not line_dedup.removable(n, w) or first.setdefault(chunk, (r.doc_id, at)) == (r.doc_id, at):
                        out.append(chunk)
                assert after[r.doc_id].text == "\n".join(out) and after[r.doc_id].n_chars == len("\n".join(out))
        if name == "minhash_near_dedup":
            found = brute_components([(r.doc_id, r.text) for r in before])
            assert set(after) == {i for i, (_, least) in found.items() if i == least}
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
            hit = {i for i, _ in brute_passages([(r.doc_id, r.text) for r in before], items)}
            assert set(after) == {r.doc_id for r in before} - hit
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_stages_take_odd_and_empty_tables(odd_docs, make_docs, spark):
    columns = make_docs([]).columns
    for docs in (odd_docs.select(columns), make_docs([])):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        docs.collect()
