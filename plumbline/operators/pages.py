"""Structured records from raw web pages.

Every operator adds columns to the page table it is given. Only the HTML goes to
Python, in Arrow batches, and only the columns asked for come back; all other
columns stay in the JVM. Where a marker shows in the JVM that a page cannot hold
what is looked for, the page is not sent at all.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.html_page import read_page
from plumbline.session import ship_package

IMAGE = "struct<src:string,alt:string>"
# Result columns of the page reader, with their Spark types.
FIELDS = {
    "text": "string",
    "images": f"array<{IMAGE}>",
    "tables": "array<array<map<string,string>>>",
    "json_ld": "array<string>",
    "title": "string",
    "description": "string",
    "h1s": "array<string>",
    "word_count": "int",
    "next_link": "string",
}
_ARROW = {
    "text": pa.string(),
    "images": pa.list_(pa.struct([("src", pa.string()), ("alt", pa.string())])),
    "tables": pa.list_(pa.list_(pa.map_(pa.string(), pa.string()))),
    "json_ld": pa.list_(pa.string()),
    "title": pa.string(),
    "description": pa.string(),
    "h1s": pa.list_(pa.string()),
    "word_count": pa.int32(),
    "next_link": pa.string(),
}


def page_fields(html: Column | str, fields: Sequence[str], strip_head: bool = True) -> Column:
    """The named fields of each page as one struct column; an empty page gives a null struct."""
    ship_package(SparkSession.active())
    fields = list(fields)
    arrow_type = pa.struct([(name, _ARROW[name]) for name in fields])
    spark_type = "struct<" + ",".join(f"{name}:{FIELDS[name]}" for name in fields) + ">"

    def rows_of(table: list[dict[str, str]]) -> list[list[tuple[str, str]]]:
        return [list(row.items()) for row in table]

    def one(text: str | None) -> dict[str, object] | None:
        if not text:
            return None
        page = read_page(text, not strip_head, fields)
        record = {name: page[name] for name in fields}
        if "tables" in record:
            record["tables"] = [rows_of(table) for table in record["tables"]]
        return record

    @F.arrow_udf(spark_type)
    def read(batch: pa.Array) -> pa.Array:
        return pa.array([one(text.as_py()) for text in batch], type=arrow_type)

    # Without this mark the optimizer may copy the call, say into a filter before an explode.
    return read.asNondeterministic()(F.col(html) if isinstance(html, str) else html)


def dealt(pages: DataFrame, tasks: int | None = None) -> DataFrame:
    """``pages`` dealt evenly over so many tasks; as they are if none is named.

    For tables in fewer row groups than there are cores: reading a page takes far longer
    than sending it. Tables in many files need no such shuffle.
    """
    return pages if tasks is None else pages.repartition(tasks)


def may_contain(html: Column | str, marker: str) -> Column:
    """False only for pages that cannot hold the (lower-case) marker."""
    return F.contains(F.lower(html), F.lit(marker))


def resolve_source(src: Column, base_url: str, resolve_relative: bool = True) -> Column:
    """Absolute image address: ``/x`` goes below the base; other relative ones only if asked."""
    base = base_url.rstrip("/")
    address = F.when(src.startswith("/"), F.concat(F.lit(base), src))
    if resolve_relative:
        below = F.concat(F.lit(base + "/"), F.regexp_replace(src, "^/+", ""))
        address = address.when(~src.startswith("http"), below)
    return address.otherwise(src)


def _resolved(images: Column, base_url: str, resolve_relative: bool) -> Column:
    def one(image: Column) -> Column:
        return F.struct(
            resolve_source(image["src"], base_url, resolve_relative).alias("src"), image["alt"].alias("alt")
        )

    return F.transform(images, one)


def _empty(field: str) -> Column:
    return F.array().cast(FIELDS[field])


def _with(pages: DataFrame, field: str, otherwise: Column, marker: str | None = None, **options) -> DataFrame:
    html = F.col("html") if marker is None else F.when(may_contain("html", marker), F.col("html"))
    found = page_fields(html, [field], **options)
    return pages.withColumn("_page", found).withColumn(field, F.coalesce(F.col(f"_page.{field}"), otherwise)).drop("_page")


def extract_text(pages: DataFrame, strip_head: bool = True) -> DataFrame:
    """Visible text; with ``strip_head=False`` the title comes first."""
    return _with(pages, "text", F.lit(""), strip_head=strip_head)


def extract_images(pages: DataFrame, base_url: str = "", resolve_relative: bool = True) -> DataFrame:
    """Array of ``{src, alt}`` in page order, without empty and inline images."""
    found = _with(pages, "images", _empty("images"), "<img")
    return found.withColumn("images", _resolved(F.col("images"), base_url, resolve_relative))


def image_table(pages: DataFrame, base_url: str = "", resolve_relative: bool = True) -> DataFrame:
    """One row per image: url, position, src, alt. Pages without images are dropped before parsing."""
    some = pages.select("url", "html").where(may_contain("html", "<img"))
    images = extract_images(some, base_url, resolve_relative)
    return images.select("url", F.posexplode("images").alias("position", "image")).select(
        "url", "position", "image.src", "image.alt"
    )


def extract_tables(pages: DataFrame) -> DataFrame:
    """Array of tables, each an array of maps from header to cell text."""
    return _with(pages, "tables", _empty("tables"), "<table")


def table_cells(pages: DataFrame) -> DataFrame:
    """One row per table cell: url, table_no, row_no, header, value."""
    some = pages.select("url", "html").where(may_contain("html", "<table"))
    rows = (
        extract_tables(some)
        .select("url", F.posexplode("tables").alias("table_no", "rows"))
        .select("url", "table_no", F.posexplode("rows").alias("row_no", "cells"))
    )
    return rows.select("url", "table_no", "row_no", F.explode("cells").alias("header", "value"))


def extract_json_ld(pages: DataFrame) -> DataFrame:
    """Array of JSON texts, one per structured-data object; lists are flattened, what is no JSON is left out."""
    return _with(pages, "json_ld", _empty("json_ld"), "<script")


def extract_metadata(pages: DataFrame, strip_head: bool = True) -> DataFrame:
    """Struct of title, description, h1s and word_count; its fields are null for an empty page."""
    found = page_fields("html", ["title", "description", "h1s", "word_count"], strip_head)
    return pages.withColumn("_page", found).withColumn("metadata", _metadata()).drop("_page")


def _metadata() -> Column:
    return F.struct(*[F.col(f"_page.{n}").alias(n) for n in ("title", "description", "h1s", "word_count")])


def extract_next_link(pages: DataFrame) -> DataFrame:
    """Address in ``li.next > a``, or null."""
    return _with(pages, "next_link", F.lit(None).cast("string"), "<li")


def parse_pages(
    pages: DataFrame, base_url: str = "", strip_head: bool = True, resolve_relative: bool = True
) -> DataFrame:
    """One record per page: url, text, images, tables, json_ld, metadata; each page is read once."""
    fields = ["text", "images", "tables", "json_ld", "title", "description", "h1s", "word_count"]
    read = pages.select("url", page_fields("html", fields, strip_head).alias("_page"))
    images = _resolved(F.col("_page.images"), base_url, resolve_relative)
    return read.select(
        "url",
        F.coalesce("_page.text", F.lit("")).alias("text"),
        F.coalesce(images, _empty("images")).alias("images"),
        F.coalesce("_page.tables", _empty("tables")).alias("tables"),
        F.coalesce("_page.json_ld", _empty("json_ld")).alias("json_ld"),
        _metadata().alias("metadata"),
    )


def page_stats(records: DataFrame) -> DataFrame:
    """Words and images per record."""
    return records.select(
        "url",
        F.coalesce("metadata.word_count", F.lit(0)).alias("word_count"),
        F.size("images").alias("image_count"),
    )
