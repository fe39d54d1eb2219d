"""Extendible hashing: shards by hash prefix; only buckets over the byte limit split on another bit.

Every row gets a 60-bit hash of its key and its bytes (``octet_length`` of the text). A bucket is a
prefix of the hash; it is a shard as soon as its rows fit ``max_bytes``, else it splits on the next
bit. The directory has 2^g entries for the deepest shard's g bits, of which those sharing a shard
agree in its first ``depth`` bits; ``directory`` lists the shards, not the entries.

Only functions of the DataFrame API are used. Sizes are summed once to cells of equal leading bits,
combined in every task before the shuffle, and each level reads only the cells still too large.

- Rows that are equal in key and text cannot be told apart by any bit. What still exceeds the limit
  at the last bit is dealt to numbered pages of one shard prefix, each within the limit.
- A single row larger than the limit has a shard (page) of its own, the only way to be over it.
- Null texts and empty texts have 0 bytes; null keys hash like the word ``null``. An empty table has
  no shards. Extra columns are left out of the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import materialize

BITS = 60
STEP = 8  # bits by which the cells are refined at a time


def row_hash(key: Column, text: Column) -> Column:
    """60 bits of the md5 of key and text, as a long."""
    digest = F.md5(F.concat_ws("\x1f", F.coalesce(key.cast("string"), F.lit("null")), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def prefix(h: Column | str, depth: int) -> Column:
    return F.shiftright(F.col(h) if isinstance(h, str) else h, BITS - depth)


def hashed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bytes, h): all that placing a row needs."""
    size = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long")
    return docs.select(docs[key].alias("key"), size.alias("bytes"), row_hash(docs[key], docs[text]).alias("h"))


def split_steps(rows: DataFrame, max_bytes: int) -> list[tuple[int, DataFrame]]:
    """Per step its bits and (cell, depth, bits, shard_bytes, shard_rows) of the cells whose shard is found.

    A step refines what is still too large by ``STEP`` bits, sums it to cells of that many leading
    bits and gives each cell the shallowest prefix that fits; it is one job over one scan.
    """
    steps, open_rows, depth = [], rows.select("h", "bytes"), 0
    while True:
        deeper = min(BITS, depth + STEP)
        cells = open_rows.groupBy(prefix("h", deeper).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n_rows")
        )
        chosen = None
        for level in range(deeper, depth - (depth == 0), -1):  # the shallowest that fits wins
            bits = F.shiftright("cell", deeper - level)
            bucket = Window.partitionBy(bits)
            size, n = F.sum("bytes").over(bucket), F.sum("n_rows").over(bucket)
            found = F.struct(F.lit(level).alias("depth"), bits.alias("bits"), size.alias("shard_bytes"), n.alias("shard_rows"))
            fits = (size <= max_bytes) | (n == 1) | F.lit(level == BITS)
            chosen = F.when(fits, found) if chosen is None else F.when(fits, found).otherwise(chosen)
        cells = materialize(cells.select("cell", chosen.alias("s")), "shard-cells")
        steps.append((deeper, cells.filter("s is not null").select("cell", "s.*")))
        still = cells.filter("s is null").select("cell")
        if still.isEmpty():
            return steps
        open_rows, depth = open_rows.join(still, prefix("h", deeper) == still["cell"], "left_semi"), deeper


def directory(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Shards as (depth, bits, shard_bytes, shard_rows) from ``hashed_rows``; depth 60 may exceed the limit."""
    found = [cells.select("depth", "bits", "shard_bytes", "shard_rows") for _, cells in split_steps(rows, max_bytes)]
    return reduce(DataFrame.unionAll, found).distinct()


def assign(docs: DataFrame, max_bytes: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bytes, depth, shard, page, shard_bytes): the shard of every row.

    ``shard`` is the hash prefix written in bits (empty at depth 0); with ``page`` it names the shard.
    """
    rows = materialize(hashed_rows(docs, key, text), "shard-rows")
    placed = [rows.join(cells, prefix("h", bits) == cells["cell"]) for bits, cells in split_steps(rows, max_bytes)]
    placed = reduce(DataFrame.unionAll, placed)
    shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr(f"right(lpad(bin(bits), {BITS}, '0'), depth)"))
    over = (F.col("shard_bytes") > max_bytes) & (F.col("shard_rows") > 1)
    one = placed.filter(~over).select("key", "bytes", "depth", shard.alias("shard"), F.lit(0).alias("page"), "shard_bytes")
    # Equal rows beyond the limit at the last bit: counted in every task, then so many to a page.
    equal = placed.filter(over).groupBy("key", "bytes", "depth", "bits").agg(F.count("*").alias("copies"))
    equal = equal.withColumn("per_page", F.greatest(F.lit(1), F.floor(F.lit(max_bytes) / F.greatest("bytes", F.lit(1)))))
    pages = equal.withColumn("page", F.explode(F.expr("sequence(0, cast((copies - 1) div per_page as int))")))
    on_page = F.least(F.col("per_page"), F.col("copies") - F.col("page") * F.col("per_page"))
    pages = pages.withColumn("on_page", on_page).withColumn("copy", F.explode(F.expr("sequence(1L, on_page)")))
    many = pages.select(
        "key", "bytes", "depth", shard.alias("shard"), "page", (F.col("bytes") * F.col("on_page")).cast("long").alias("shard_bytes")
    )
    return one.unionAll(many)
