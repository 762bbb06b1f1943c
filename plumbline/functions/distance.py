"""Distances between grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.numbers import as_column


def grid_distance(
    row1: Column | str, col1: Column | str, row2: Column | str, col2: Column | str, kind: str = "manhattan"
) -> Column:
    """Distance as double; ``kind`` is manhattan, euclidean or chebyshev."""
    down = F.abs(as_column(row1) - as_column(row2)).cast("double")
    across = F.abs(as_column(col1) - as_column(col2)).cast("double")
    if kind == "manhattan":
        return down + across
    if kind == "euclidean":
        return F.sqrt(down * down + across * across)
    if kind == "chebyshev":
        return F.greatest(down, across)
    raise ValueError(f"unknown distance {kind!r}")
