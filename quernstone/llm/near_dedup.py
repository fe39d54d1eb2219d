"""Near-duplicate groups by min-max hashing.

A document's set holds its distinct 5-word shingles (``shingles``). Each of 64 hash functions gives
two values, the smallest and the largest of the set: 128 values for 64 evaluations per shingle, each
agreeing with probability equal to the Jaccard similarity. Four values make a band, 32 bands in all;
two sets of similarity 0.75 share none with probability (1 - 0.75^4)^32 = 5e-6.

1. Documents with equal sets become one class (a 128-bit hash of the set), counted before a shuffle.
2. Classes meet by band. In bands of up to ``SMALL`` classes all pairs are candidates; in larger ones
   each class is first paired with one class of the band only.
3. Candidates are compared by one byte of each of the 128 values. Similarity 0.75 agrees in 96 of
   them with a deviation of 4.9; pairs below ``AGREE`` = 70 are dropped (probability about 1e-7).
4. The rest is confirmed on full sets, read again from the texts: 100 * common >= 75 * union.
5. Larger bands whose classes are now in different components are gone through in blocks: a task
   compares one block of a band with one block of the classes outside the band's commonest component,
   first by sketches, then, cut into blocks again, those that look alike by their full sets. A task
   holds two blocks at most, and passes on no pairs but the confirmed links that join components.
6. Components of all confirmed links; the smallest doc_id of a component names it.

Documents without words have no set and no links. Rows without doc_id are linked with nothing, have
no component and are kept. Rows sharing a doc_id are one document if their texts are equal; if not,
the texts are linked through the id only when the texts are. Ties do not matter: a component has one
smallest id. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import join_by_counts, materialize, may_be_in, salted_join
from quernstone.llm.components import components
from quernstone.llm.shingles import mix, shingle_set

HASHES = 64
ROWS = 4
BANDS = 2 * HASHES // ROWS
SIMILAR = 75  # per cent
AGREE = 70  # of 2 * HASHES bytes
SMALL = 16  # classes of a band compared in all pairs: 120 at most
BLOCK = 512  # classes of a band on either side of a task that compares full sets
SKETCHES = 4096  # the same where only sketches are compared

_rng = np.random.default_rng(77)
_MULTIPLY = _rng.integers(1, 1 << 63, (HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, (HASHES, 1), dtype=np.uint64)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64)
_PLACES = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima, then HASHES maxima."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(HASHES, np.uint64)
    for at in range(0, len(shingles), 512):
        values = shingles[at : at + 512] * _MULTIPLY + _ADD
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def _describe(text: str | None) -> tuple:
    shingles = shingle_set(text)
    if not len(shingles):
        return 0, None, None, None
    values = signature(shingles)
    keys = mix((mix(values).reshape(BANDS, ROWS) * _PLACES).sum(axis=1) + _BAND * _PLACES[0])
    sketch = (mix(values) & np.uint64(255)).astype(np.uint8).tobytes()
    return len(shingles), blake2b(shingles.tobytes(), digest_size=16).digest(), keys.view(np.int64), sketch


def _describe_texts(texts: pa.Array) -> pa.Array:
    rows = list(zip(*(_describe(t.as_py()) for t in texts), strict=True)) or [[], [], [], []]
    kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
    names = ["n_shingles", "cls", "keys", "sketch"]
    return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(rows, kinds, strict=True)], names)


def _sets_of(texts: pa.Array) -> pa.Array:
    sets = [shingle_set(t.as_py()) for t in texts]
    return pa.StructArray.from_arrays(
        [
            pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
            pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
        ],
        ["cls", "shingles"],
    )


def _agree(left: pa.Array, right: pa.Array) -> pa.Array:
    a, b = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, 2 * HASHES) for s in (left, right))
    return pa.array((a == b).sum(axis=1), pa.int32())


def _arrow(function, kind: str):
    n = function.__code__.co_argcount
    function.__annotations__ = dict(zip(function.__code__.co_varnames[:n], [pa.Array] * n, strict=True)) | {"return": pa.Array}
    return F.arrow_udf(function, kind)


def _pass_sketch(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose sketches agree often enough."""
    agree = _arrow(_agree, "int")
    pairs = materialize(pairs, "candidates")
    a = classes.select(F.col("uid").alias("a"), F.col("sketch").alias("sketch_a"))
    b = classes.select(F.col("uid").alias("b"), F.col("sketch").alias("sketch_b"))
    met = salted_join(salted_join(pairs, a, "a", "b"), b, "b", "a")
    return met.filter(agree("sketch_a", "sketch_b") >= AGREE).select("a", "b")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough; only texts of classes in a pair are read for it."""
    pairs = materialize(pairs, "likely")
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), classes, docs)
    a = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sb"))
    met = salted_join(salted_join(pairs, a, "a", "b"), b, "b", "a")
    common = F.size(F.array_intersect("sa", "sb"))
    sized = met.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("both"))
    return materialize(sized.filter(F.expr(f"100 * common >= {SIMILAR} * (both - common)")).select("a", "b"), "confirmed")


def _sets(uids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(uid, shingles): the full sets of some classes, read again from the texts."""
    wanted = materialize(classes.select("uid", "doc_id", "cls").join(uids, "uid"), "wanted")
    near = docs.filter(may_be_in(wanted, "doc_id")(F.xxhash64("doc_id")))
    sets = near.join(wanted, "doc_id").select("uid", "cls", _arrow(_sets_of, "cls binary, shingles array<long>")("text").alias("s"))
    sets = sets.filter("s.cls = cls").select("uid", "s.shingles").dropDuplicates(["uid"])
    return materialize(sets, "sets")


def _near_others(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Per asking minor class: its row, and the rows of the block of other labels with a like sketch."""
    here, asks = np.flatnonzero(rows["here"]), np.flatnonzero(rows["asks"])
    if not len(here) or not len(asks):
        return
    sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
    label, uid, minor = (rows[c].to_numpy() for c in ("label", "uid", "minor"))
    for k in asks:
        near = (sketches[here] == sketches[k]).sum(axis=1) >= AGREE
        # Of two minor classes the smaller one asks.
        found = here[near & (label[here] != label[k]) & (~minor[here] | (uid[here] > uid[k]))]
        if len(found):
            yield k, found


def _like_others(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The classes of a block in any pair that sketches leave open."""
    hit = np.zeros(len(rows), bool)
    for k, found in _near_others(rows):
        hit[k] = True
        hit[found] = True
    return pd.DataFrame({"key": key[0], "uid": rows["uid"].to_numpy()[hit]}).drop_duplicates()


def _cross_links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a block confirmed on full sets: those that join labels not joined by an earlier one."""
    sets, uid, label = list(rows["shingles"]), rows["uid"].to_numpy(), rows["label"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for k, found in _near_others(rows):
        low = np.searchsorted(flat, sets[k])
        n = np.searchsorted(flat, sets[k], side="right") - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(sets))[found]
        for j in found[100 * common >= SIMILAR * (sizes[found] + sizes[k] - common)]:
            one, two = root(int(label[k])), root(int(label[j]))
            if one != two:
                parent[max(one, two)] = min(one, two)
                out.append((min(uid[k], uid[j]), max(uid[k], uid[j])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, uid, minor, size, minors, ...) as groups (key, part, block) that hold every pair of a minor class once.

    In each group the classes that ask are of one part of the band's minors, those ``here`` of one block
    of all its classes; both are of about ``block`` classes.
    """
    rows = rows.withColumn("parts", F.ceil(F.greatest("minors", F.lit(1)) / block).cast("int"))
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    part, own = (F.pmod(F.xxhash64("uid"), F.col(c)).cast("int") for c in ("parts", "blocks"))

    def cell(p, b, asks, here):
        return F.struct(p.alias("part"), b.alias("block"), asks.alias("asks"), here.alias("here"))

    asking = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: cell(part, b, F.lit(True), b == own))
    asked = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: cell(p, own, F.lit(False), F.lit(True)))
    cells = F.when(F.col("minor"), F.concat(asking, F.filter(asked, lambda c: c["part"] != part))).otherwise(asked)
    return rows.withColumn("cell", F.explode(cells)).select("*", "cell.*").drop("cell", "size", "minors", "parts", "blocks")


def _remaining(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links inside large bands that hold classes of more than one component so far."""
    named = members.join(labels, members["uid"] == labels["node"], "left")
    named = named.select("key", "uid", F.coalesce("label", "uid").alias("label"))
    by_label = materialize(named.groupBy("key", "label").agg(F.count("*").alias("n")), "band-labels")
    # The commonest component of each band, by count and then by label, both packed in no struct.
    most = by_label.groupBy("key").agg(F.max("n").alias("most"), F.count("*").alias("labels"), F.sum("n").alias("n"))
    major = by_label.join(most.filter("labels > 1").select("key", "most", F.col("n").alias("size")), "key")
    major = major.filter("n = most").groupBy("key").agg(
        F.min("label").alias("major"), F.first("size").alias("size"), F.first(F.col("size") - F.col("most")).alias("minors")
    )
    major = materialize(major, "open-bands")
    if major.isEmpty():
        return members.select(F.col("uid").alias("a"), F.col("uid").alias("b")).limit(0)
    total = members.count()
    rows = join_by_counts(named, major, "key", "size", total).withColumn("minor", F.col("label") != F.col("major"))
    rows = rows.join(classes.select("uid", "sketch"), "uid")
    rows = materialize(rows.select("key", "uid", "label", "sketch", "minor", "size", "minors"), "open-rows")
    likely = _dealt(rows, SKETCHES).groupBy("key", "part", "block").applyInPandas(_like_others, "key long, uid long")
    likely = materialize(likely.distinct(), "open-classes")
    sets = _sets(likely.select("uid").distinct(), classes, docs)
    rows = materialize(rows.drop("size", "minors").join(likely, ["key", "uid"], "left_semi"), "open-rows")
    counts = rows.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.col("minor").cast("long")).alias("minors"))
    rows = join_by_counts(rows, materialize(counts, "open-sizes"), "key", "size", rows.count())
    rows = _dealt(rows.join(sets, "uid"), BLOCK)
    return rows.groupBy("key", "part", "block").applyInPandas(_cross_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    describe = _arrow(_describe_texts, "n_shingles long, cls binary, keys array<long>, sketch binary")
    sets = materialize(docs.select("doc_id", describe("text").alias("s")).select("doc_id", "s.*"), "described")

    named = sets.filter("cls is not null and doc_id is not null")
    classes = named.groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"),
        F.count("*").alias("copies"),
        F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"),
    )
    # The ids are fixed by being written.
    classes = materialize(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")

    banded = classes.select("uid", F.explode("keys").alias("key"))
    # uid ^ key orders each band in its own way, so bands choose different centres.
    bands = banded.groupBy("key").agg(F.count("*").alias("n"), F.min(F.expr("uid ^ key")).alias("least")).filter("n > 1")
    bands = materialize(bands.select("key", "n", F.expr("least ^ key").alias("centre")), "bands")
    # Only rows of bands that two classes share are moved.
    shared = banded.filter(may_be_in(bands, "key")(F.xxhash64("key")))
    n_shared = bands.agg(F.sum("n")).first()[0] or 0
    members = materialize(join_by_counts(shared, bands, "key", "n", n_shared), "band-members")

    small = members.filter(F.col("n") <= SMALL).select("key", "uid")
    one, two = small.select("key", F.col("uid").alias("a")), small.select("key", F.col("uid").alias("b"))
    pairs = one.join(two, "key").filter("a < b").select("a", "b")
    large = members.filter(F.col("n") > SMALL)
    star = large.filter("uid != centre").select(F.least("uid", "centre").alias("a"), F.greatest("uid", "centre").alias("b"))
    links = _confirm(_pass_sketch(pairs.unionAll(star).distinct(), classes), classes, docs)
    labels = components(links)
    more = materialize(_remaining(large.select("key", "uid"), labels, classes, docs), "more-links")
    if not more.isEmpty():
        so_far = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(so_far.unionAll(more))

    in_group = classes.select("uid", "doc_id").join(labels, classes["uid"] == labels["node"]).select("uid", "doc_id", "label")
    least = in_group.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    group_of = in_group.join(least, "label").select("uid", "component_id")
    of_class = classes.select("cls", "uid", "copies", "doc_id").join(group_of, "uid", "left")
    of_class = of_class.select("cls", "copies", F.coalesce("component_id", "doc_id").alias("component_id"))
    of_class = materialize(of_class, "class-components")
    linked = join_by_counts(named.select("doc_id", "n_shingles", "cls"), of_class, "cls", "copies", named.count())
    linked = linked.select("doc_id", "n_shingles", "component_id")
    alone = sets.filter("cls is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of every component, and all rows without an id; columns as in ``docs``.

    Rows equal in id and text become one; different texts under one kept id all stay.
    """
    found = near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id")
    found = found.agg(F.bool_or("kept").alias("any_kept"), F.count("*").alias("n")).filter("not any_kept or n > 1")
    found = materialize(found, "near-copies")
    # Only texts whose id may be in that table are moved.
    concerned = may_be_in(found, "doc_id")(F.xxhash64("doc_id")) & F.col("doc_id").isNotNull()
    gone = found.filter("not any_kept").select("doc_id")
    rest = docs.filter(concerned).join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return docs.filter(~concerned).unionAll(rest.select(docs.columns))
