"""Samples of a stated size that do not depend on how rows are spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of rows above what is needed that pass the first cut, so that it seldom has to be widened.
SPARE = 1.25
HASH_RANGE = 1 << 32


def hash_order(key: str | Column, seed: int) -> Column:
    """MD5 of seed and key as text: an order of rows that looks random and every engine can repeat."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def bottom_k(df: DataFrame, rows: int, key: str | Column, seed: int = 42, ties: Sequence[str] = ()) -> DataFrame:
    """Exactly ``rows`` rows, all if there are fewer: those whose ``key`` hashes smallest, ``ties`` deciding among equal ones.

    The hash of a key is compared with a cut that lets through a little more than ``rows``
    of all rows, in the scan; only these few are sorted for the exact number. Should too few
    pass, as can happen where keys repeat, the cut is doubled. The same keys give the same
    sample under any partitioning. The rows are counted first, which reads no more than
    the key.
    """
    if rows < 0:
        raise ValueError("a sample has no negative size")
    order = hash_order(key, seed)
    total = df.count()
    marked = df.withColumn("_hash", order)
    place = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    share = SPARE * (rows + 100) / max(total, 1)
    while share < 1:
        cut = marked.where(place < int(share * HASH_RANGE))
        if cut.count() >= min(rows, total):
            break
        share *= 2
    else:
        cut = marked
    return cut.orderBy("_hash", *ties).limit(rows).drop("_hash")
