"""Text column expressions and name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.numbers import as_column


def collapse_blanks(value: Column | str) -> Column:
    """Runs of two or more whitespace characters become one blank; ends are trimmed.

    A single newline or tab inside the text stays.
    """
    return F.regexp_replace(F.regexp_replace(as_column(value), r"\s{2,}", " "), r"^\s+|\s+$", "")


def word_count(value: Column | str) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.filter(F.split(as_column(value), r"\s+"), lambda word: word != ""))


def padded_id(prefix: str, number: Column | str, width: int) -> Column:
    """For example ``ORD-000042``."""
    return F.format_string(f"{prefix}-%0{width}d", as_column(number))


def tidy_name(name: str, blank_to: str | None = None) -> str:
    """Column name without outer blanks, in lower case, inner blanks replaced if asked."""
    tidy = name.strip().lower()
    return tidy if blank_to is None else tidy.replace(" ", blank_to)
