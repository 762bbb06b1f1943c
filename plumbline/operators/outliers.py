"""Rows far above the mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_of(df: DataFrame, value: str) -> Column:
    """Mean and population deviation of a column as one scalar subquery.

    The statistics are computed once per query and reach the tasks as literals:
    no join, no shuffle of the rows they are compared with.
    """
    stats = F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    return df.agg(stats.alias("spread")).scalar()


def above_spread(df: DataFrame, value: str, times: float, score: str | None = None) -> DataFrame:
    """Rows whose value exceeds mean + ``times`` deviations; ``score`` names a column for the z-score."""
    spread = spread_of(df, value)
    found = df.where(F.col(value) > spread["mean"] + F.lit(float(times)) * spread["sd"])
    if score is None:
        return found
    return found.withColumn(score, F.round(F.try_divide(F.col(value) - spread["mean"], spread["sd"]), 2))
