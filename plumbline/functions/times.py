"""Date and time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.numbers import as_column


def to_timestamp(value: Column | str, formats: tuple[str, ...] = ()) -> Column:
    """Zone-free timestamp or null. ISO text is read as is; ``formats`` are tried after that."""
    column = as_column(value)
    tries = [column.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(column.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end`` with fractions, negative if ``end`` is earlier."""
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / F.lit(6e7)


def hour_of_day(value: Column | str) -> Column:
    return F.hour(as_column(value))


def day_of_week(value: Column | str) -> Column:
    """English day name in full."""
    return F.date_format(as_column(value), "EEEE")


def year_month(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def month_number(text: Column | str) -> Column:
    """A 'yyyy-MM' text as a running number of months, which aggregates by hash where text would be sorted."""
    column = as_column(text)
    return F.substring(column, 1, 4).cast("int") * 12 + F.substring(column, 6, 2).cast("int") - 1


def month_text(number: Column | str) -> Column:
    """The 'yyyy-MM' text of a running number of months."""
    column = as_column(number)
    return F.format_string("%04d-%02d", F.floor(column / 12), column % 12 + 1)


def months_apart(first: Column | str, second: Column | str) -> Column:
    """Whole months between two 'yyyy-MM' texts."""
    return month_number(second) - month_number(first)
