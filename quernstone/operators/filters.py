"""Filters that keep rows without a partner out of a shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_BITS = 1 << 26  # 8 MB at most, whatever the number of keys
LEAST_BITS = 1 << 18
BITS_PER_KEY = 32
PROBES = 4
_filters: list = []  # broadcast by this driver and not yet released


def release_filters() -> None:
    """Let executors drop the filters broadcast so far; one still in use is sent again."""
    while _filters:
        _filters.pop().unpersist()


def filter_bits(n: int, most: int = SKETCH_BITS, per_key: int = BITS_PER_KEY) -> int:
    """A power of two with ``per_key`` bits for each of ``n`` keys, ``most`` at most."""
    return min(most, max(LEAST_BITS, 1 << (n * per_key - 1).bit_length()))


def membership(keys: DataFrame, value: Column, bits: int = SKETCH_BITS) -> Callable[[np.ndarray], np.ndarray]:
    """A test of well-mixed 64-bit values: false only for values not among ``value`` of ``keys``.

    A Bloom filter of ``bits`` is broadcast: with thirty-two bits a key one other value in 5000 passes,
    with sixteen one in 400, with eight one in 40, with one nearly all.
    """
    # Places step from the low bits by the high ones; both sides of the test compute them alike.
    low, step = value.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(value, 32).bitwiseOR(F.lit(1))
    places = F.array(*((low + step * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)))
    place = F.col("place") + 1
    parts = keys.select(F.explode(places).alias("place")).groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    filled = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():  # at most ``bits`` bits
        part = np.frombuffer(bytes(row.bits), np.uint8)
        filled[(row.part - 1) * len(part) : row.part * len(part)] = part
    held = keys.sparkSession.sparkContext.broadcast(filled)
    _filters.append(held)

    def known(values: np.ndarray) -> np.ndarray:
        values = values.view(np.uint64)
        step, found = (values >> np.uint64(32)) | np.uint64(1), np.ones(len(values), bool)
        for i in range(PROBES):
            at = (values + step * np.uint64(i)) & np.uint64(bits - 1)
            found &= (held.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    return known


def may_be_in(keys: DataFrame, *key: str):
    """A UDF on ``xxhash64`` of a key of one or more columns: false only for keys not in ``keys``, a written table.

    It keeps most rows without a partner out of a shuffle as long as keys are few against the bits of
    the bitmap (``membership``), and never leaves out a row with one. Few keys make a small filter: the
    driver and every Python worker hold a copy.
    """
    test = membership(keys, F.xxhash64(*key), filter_bits(keys.count()))

    def known(hashes: pa.Array) -> pa.Array:
        return pa.array(test(hashes.to_numpy(zero_copy_only=False)))

    known.__annotations__ = {"hashes": pa.Array, "return": pa.Array}
    return F.arrow_udf(known, "boolean")
