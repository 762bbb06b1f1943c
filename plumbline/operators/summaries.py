"""Grouped counts, totals and means, in a form that can be summed up again.

``summarise`` yields one row per key with partial results: ``_rows`` and, per
measure, ``_sum_<name>`` and ``_n_<name>``. Handed such a table as a
:class:`Rollup` it adds the partial results up. So each report accepts either the
fact table or a rollup made once for several reports, and a rollup of 100 TB of
facts costs one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numbers import percent, summable

ROWS = "_rows"


@dataclass(frozen=True)
class Rollup:
    """A table of partial results, told apart from facts by type and not by its columns."""

    frame: DataFrame

    def persist(self) -> Rollup:
        self.frame.persist()
        return self

    def unpersist(self) -> None:
        self.frame.unpersist()


def summarise(
    df: DataFrame | Rollup, keys: Sequence[str], measures: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Partial results per key; see :func:`plumbline.functions.numbers.summable` for ``digits``."""
    if isinstance(df, Rollup):
        df = df.frame
        columns = [F.sum(ROWS).alias(ROWS)]
        for name in measures:
            columns += [F.sum(f"_{part}_{name}").alias(f"_{part}_{name}") for part in ("sum", "n")]
    else:
        columns = [F.count(F.lit(1)).alias(ROWS)]
        for name in measures:
            columns.append(F.sum(summable(name, digits)).alias(f"_sum_{name}"))
            columns.append(F.count(name).alias(f"_n_{name}"))
    return df.groupBy(*keys).agg(*columns)


def row_count() -> Column:
    """COUNT(*); zero rather than null over an empty rollup."""
    return F.coalesce(F.col(ROWS), F.lit(0)).cast("bigint")


def value_count(name: str) -> Column:
    return F.col(f"_n_{name}")


def total(name: str) -> Column:
    return F.col(f"_sum_{name}").cast("double")


def mean(name: str) -> Column:
    return F.try_divide(total(name), value_count(name))


def share_of_rows(summary: DataFrame, out: str, digits: int) -> DataFrame:
    """Add each row's share in the count of all rows.

    The window spans the whole summary, that is one row per key, never the facts.
    """
    everything = F.sum(ROWS).over(Window.partitionBy())
    return summary.withColumn(out, percent(F.col(ROWS), everything, digits))


def growth(summary: DataFrame, period: str, value: str, previous: str, out: str) -> DataFrame:
    """Add the value of the previous period present and the growth over it in percent.

    Growth is null in the first period and after a zero. The window has one row
    per period.
    """
    before = F.lag(value).over(Window.orderBy(period))
    change = F.try_divide((F.col(value) - F.col(previous)) * F.lit(100.0), F.col(previous))
    return summary.withColumn(previous, before).withColumn(out, F.round(change, 2))
