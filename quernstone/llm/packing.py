"""Packing token pieces into sequences by the configuration linear program of their lengths.

A document's ids end with the end token. Only documents longer than a sequence are cut, into full
pieces behind a first piece that takes the rest. The lengths' histogram has at most ``capacity``
rows and is all the driver sees.

- A configuration says how many pieces of each length share a sequence; the linear program covers
  the histogram with as few as possible. Multiplicative weights solve it (``solve``): a length's price
  starts at its size and falls as it is covered; each round the most valuable configuration at these
  prices comes from a knapsack by dynamic programming and gets an equal share of the sequences. The
  average of the rounds is the fractional solution. The prices of each round, scaled so that no
  configuration is worth more than one, are a solution of the dual: the demand at these prices is a
  lower bound of any packing, and the best one tells how far off the result can be.
- The solution is rounded to whole sequences without exceeding the demand. What is left is covered
  the same way, round by round at prices of what is still uncovered (``cover``), and then placed, longest first,
  where it leaves the least room; bins are handled in groups of equal content, so the work depends on
  the number of lengths and not on the number of pieces. Of this, of covering from the start and of
  placing alone the shortest packing is taken.
- Pieces are ranked within their length, which gives each its sequence and offset in closed form.

Ranks are counted in blocks of hashed rows with the blocks' counts before them, so no length has to
fit a task; equal pieces are counted as one row first. Null and empty texts are an end token alone.
Repeated rows and null ids are pieces like any other. Ties are broken by id, piece and content. An
empty table packs to nothing. Extra columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import materialize
from quernstone.llm.tokens import encoder

AVERAGED = 400  # rounds of multiplicative weights whose average solves the program
CHANGE = 12.0  # e-folds by which a price falls while its length is covered once
CLOSE = 1.002  # of the lower bound: near enough to stop
ROUNDS = 1500  # of covering what rounding leaves, at most
SHARES = (0.05, 0.7)  # of the coverable demand a round takes: the less, the fewer lengths there are
RATE = 1.0
TILT = 0.1  # by which a full-length piece is dearer per token than a tiny one: long pieces are hard to place
COVERED = 0.995  # of the tokens: enough to stop
PER_BLOCK = 50_000  # pieces of a block of ranks, about

Group = tuple[dict[int, int], int]  # pieces by length in one sequence, number of such sequences


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    cuts = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _pieces_udf(vocabulary: str, capacity: int, end: int):
    last = int(end).to_bytes(4, "little")
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    def run(texts: pa.Array) -> pa.Array:
        encode, out = encoder(vocabulary).ids, []
        for text in texts:
            ids = encode(text.as_py()).astype("<u4").tobytes() + last
            out.append(
                [
                    {"piece": k, "start": at, "length": n, "ids_crc32": crc32(ids[4 * at : 4 * (at + n)])}
                    for k, (at, n) in enumerate(piece_bounds(len(ids) // 4, capacity))
                ]
            )
        return pa.array(out, kind)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<piece int, start long, length long, ids_crc32 long>>")


def knapsack(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The most valuable multiset of lengths within ``capacity``; prices[l] is -inf where l is missing."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    total = np.empty(capacity)
    for room in range(1, capacity + 1):
        # best[room - l] + prices[l] for l = 1 .. room
        np.add(best[room - 1 :: -1] if room < capacity + 1 else best[::-1], prices[1 : room + 1], out=total[:room])
        k = int(total[:room].argmax())
        if total[k] > best[room - 1]:
            best[room], take[room] = total[k], k + 1
        else:
            best[room] = best[room - 1]
    found: dict[int, int] = {}
    room = capacity
    while room:
        if take[room]:
            found[int(take[room])] = found.get(int(take[room]), 0) + 1
            room -= int(take[room])
        else:
            room -= 1
    return found


def solve(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[dict[int, int], float]], float]:
    """The fractional solution, and a lower bound of the number of sequences."""
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[length] for length in lengths], float)
    bound = float(lengths @ demand) / capacity
    covered, used, dual = np.zeros(len(lengths)), {}, np.zeros(len(lengths))

    def best(weight: np.ndarray) -> tuple[dict[int, int], np.ndarray]:
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = weight
        found = knapsack(prices, capacity)
        taken = np.zeros(len(lengths))
        taken[np.searchsorted(lengths, list(found))] = list(found.values())
        return found, taken

    for k in range(AVERAGED):
        weight = lengths * np.exp(-CHANGE * (covered - covered.min()))
        found, taken = best(weight)
        key = tuple(sorted(found.items()))
        bound = max(bound, float(demand @ weight) / float(taken @ weight))
        dual += weight / float(demand @ weight)
        if k % 50 == 49:  # so is the average of their prices, which settles as the rounds go on
            bound = max(bound, float(demand @ dual) / float(best(dual)[1] @ dual))
            dual *= 0.5
        # A share of all sequences, or less if that covers one of its lengths.
        times = min(bound / AVERAGED, float((demand[taken > 0] / taken[taken > 0]).min()))
        used[key] = used.get(key, 0.0) + times
        covered += taken * times / demand
        if covered.min() > 0 and sum(used.values()) / covered.min() <= CLOSE * bound:
            break
    scale = 1 / covered.min() if covered.min() > 0 else 1.0
    return [(dict(key), times * scale) for key, times in used.items()], bound


def cover(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is used, taken one after another from what is uncovered."""
    demand = np.zeros(capacity + 1)
    for length, n in histogram.items():
        demand[length] = n
    sizes = np.arange(capacity + 1)
    left, used = demand.copy(), {}
    share = min(SHARES[1], max(SHARES[0], len(histogram) / ROUNDS))
    for _ in range(ROUNDS):
        if (left * sizes).sum() <= (1 - COVERED) * (demand * sizes).sum():
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            covered = np.where(demand > 0, 1 - left / demand, 1)
        prices = np.where(left > 1e-9, sizes * (1 + TILT * sizes / capacity) * np.exp(-RATE * covered), -np.inf)
        found = knapsack(prices, capacity)
        if not found:
            break
        most = min(left[length] / n for length, n in found.items())
        times = most if most <= 1 else max(1.0, share * most)
        for length, n in found.items():
            left[length] -= times * n
        key = tuple(sorted(found.items()))
        used[key] = used.get(key, 0.0) + times
    return [(dict(key), times) for key, times in used.items()]


def rounded(solution: list[tuple[dict[int, int], float]], histogram: dict[int, int]) -> tuple[list[Group], dict[int, int]]:
    """Whole sequences within the demand, and what they leave."""
    left, groups = dict(histogram), []
    for found, times in sorted(solution, key=lambda s: (-s[1], sorted(s[0].items()))):
        n = min(int(times + 0.5), *(left[length] // count for length, count in found.items()))
        if n > 0:
            groups.append((found, n))
            for length, count in found.items():
                left[length] -= n * count
    return groups, {length: n for length, n in left.items() if n}


def best_fit(groups: list[Group], left: dict[int, int], capacity: int) -> list[Group]:
    """Place what is left, longest first, into the group of sequences with the least sufficient room."""
    by_room: dict[int, list[Group]] = {}

    def put(found: dict[int, int], n: int) -> None:
        by_room.setdefault(capacity - sum(a * b for a, b in found.items()), []).append((found, n))

    for group in groups:
        put(*group)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r, held in by_room.items() if r >= length and held), default=None)
            if room is None:
                each = min(capacity // length, n)
                found, times = {length: each}, n // each
                put(found, times)
            else:
                found, have = by_room[room].pop()
                each = 1
                times = min(have, n)
                put({**found, length: found.get(length, 0) + 1}, times)
                if have > times:
                    by_room[room].append((found, have - times))
            n -= each * times
    return [group for held in by_room.values() for group in held]


def _bins(groups: list[Group]) -> int:
    return sum(n for _, n in groups)


def pack_histogram(histogram: dict[int, int], capacity: int) -> tuple[list[Group], int]:
    """The packing, and the number of sequences that no packing goes below."""
    if not histogram:
        return [], 0
    solution, bound = solve(histogram, capacity)
    least, found = int(np.ceil(bound - 1e-6)), []
    for start in (solution, [], None):
        groups, left = rounded(start or [], histogram)
        if start is not None and left:
            more, left = rounded(cover(left, capacity), left)
            groups = groups + more
        found.append(best_fit(groups, left, capacity))
        if _bins(found[-1]) == least:
            break
    return min(found, key=_bins), least


def places(groups: list[Group]) -> dict[int, np.ndarray]:
    """Per length rows of (first rank, pieces per sequence, first sequence, first offset), by first rank."""
    out: dict[int, list[tuple]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for found, times in groups:
        offset = 0
        for length, count in sorted(found.items(), reverse=True):
            out.setdefault(length, []).append((next_rank.get(length, 0), count, sequence, offset))
            next_rank[length] = next_rank.get(length, 0) + count * times
            offset += length * count
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def _place_udf(table: dict[int, np.ndarray]):
    def run(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for one in np.unique(length):
            rows, here = table[int(one)], np.flatnonzero(length == one)
            first, count, start, at = rows[np.searchsorted(rows[:, 0], rank[here], side="right") - 1].T
            nth = rank[here] - first
            sequence[here] = start + nth // count
            offset[here] = at + nth % count * one
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    run.__annotations__ = {"lengths": pa.Array, "ranks": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    cut = _pieces_udf(vocabulary, capacity, end)
    pieces = docs.select(docs[doc_id].alias("doc_id"), F.explode(cut(docs[text])).alias("p")).select("doc_id", "p.*")
    pieces = materialize(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows
    table = places(pack_histogram(histogram, capacity)[0])

    blocks = max(1, sum(histogram.values()) // PER_BLOCK)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    counted = pieces.groupBy(*columns).agg(F.count("*").alias("copies"))
    counted = counted.withColumn("block", F.pmod(F.xxhash64(*columns), F.lit(blocks)))
    sizes = pieces.groupBy("length", F.pmod(F.xxhash64(*columns), F.lit(blocks)).alias("block")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32", "start")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("within", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(sizes, ["length", "block"])
    ranked = ranked.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    rank = F.col("before") + F.col("within") + F.col("copy")
    placed = ranked.select(*columns, _place_udf(table)("length", rank).alias("at"))
    return placed.select(*columns, "at.*")
