"""Long keys made of a long and a position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 1_000_000
WIDEST = (2**63 - 1) // PLACES - 1


def pair_key(whole: Column | str, part: Column | str) -> Column:
    """``whole * PLACES + part`` where that range holds both, else a negative hash of the pair.

    The first kind is never negative and unique; the second has 60 bits of an md5, so no size of
    either number fails and none meets the key of another pair in range.
    """
    whole, part = (F.col(c) if isinstance(c, str) else c for c in (whole, part))
    whole, part = whole.cast("long"), part.cast("long")
    fits = whole.between(0, WIDEST) & part.between(0, PLACES - 1)
    digest = F.md5(F.concat_ws("-", whole, part))
    hashed = -F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") - 1
    made = F.when(fits, whole * PLACES + part).otherwise(hashed)
    return F.when(whole.isNotNull() & part.isNotNull(), made)
