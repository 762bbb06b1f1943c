"""Readers and writers for Parquet, CSV and JSON lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from plumbline.operators.cleaning import dedupe
from plumbline.session import remove_path

# A row number holds the place in the file below the file's number.
ROW_BITS = 40
MOST_BROADCAST_FILES = 100_000
BAD_LINE = "_bad_line"
MANIFEST = "version string, files bigint, bytes bigint, marks bigint, rows bigint"


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, size) of the files of a folder whose names fit; their content is not read."""
    # Folders below count as well, also those that would otherwise be read as partitions.
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = reader.option("pathGlobFilter", pattern).load(folder)
    return listing.select("path", F.col("length").alias("size"))


def _listed(path: str) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _read_from() -> Column:
    """The file of a row, spelled as :func:`_listed` spells it; row metadata holds an encoded address."""
    encoded = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
    return F.regexp_replace(F.url_decode(encoded), "^file:/+", "/")


def read_parquet(spark: SparkSession, folder: str, merge_schema: bool = True) -> DataFrame:
    """All Parquet files of a folder as one table; a file that cannot be read is an error.

    ``merge_schema`` takes the union of the files' columns and can be turned off
    when they agree.
    """
    return spark.read.option("mergeSchema", merge_schema).option("pathGlobFilter", "*.parquet").parquet(folder)


def read_parquet_without(
    spark: SparkSession, folder: str, names: Sequence[str], merge_schema: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The table without the files called ``names``, and (path, size) of those left out.

    For files known to be damaged: each is left out whole or not at all.
    """
    listing = list_files(spark, folder, "*.parquet")
    named = F.substring_index("path", "/", -1).isin(list(names))
    # One path per file, which the driver lists for any read.
    paths = [r.path for r in listing.where(~named).orderBy("path").select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no other Parquet files in {folder}")
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths), listing.where(named)


def file_order() -> list[Column]:
    """Where a row of a Parquet table lies: its file and its place in it, the order in which one reader sees the rows.

    Only columns of the table as it was read have it, before any join or aggregation.
    """
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def has_file_order(df: DataFrame) -> bool:
    """Whether the rows of ``df`` still know their place in a Parquet file."""
    try:
        df.select(*file_order())
        return True
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise


def with_row_number(df: DataFrame, name: str) -> DataFrame:
    """A Parquet table as read, with a number for each row that is the same in every scan.

    It is made of the file's number by path and the row's place in the file, so neither the
    cut of a scan into tasks nor lost executors change it, and nothing has to be written.
    """
    path, place = file_order()
    paths = df.select(path.alias("path")).distinct()
    numbers = paths.select(F.col("path").alias(f"{name}_path"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("path")).cast("bigint").alias(f"{name}_file"))
    # One short row per file; a table of very many files is left to Spark to join.
    numbers = F.broadcast(numbers) if paths.count() <= MOST_BROADCAST_FILES else numbers
    found = df.select("*", path.alias(f"{name}_at"), place.alias(f"{name}_place")).join(numbers, F.col(f"{name}_at") == F.col(f"{name}_path"))
    number = F.shiftleft(f"{name}_file", ROW_BITS).bitwiseOR(F.col(f"{name}_place"))
    return found.withColumn(name, number).drop(*[f"{name}_{c}" for c in ("at", "place", "path", "file")])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV files with a header line; without a schema all columns are text, for the cleaner to type."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _made_from(df: DataFrame, version: str) -> dict[str, object]:
    """What a table made from ``df`` depends on: the files read, by path, size and time, and the version of the code."""
    spark, paths = df.sparkSession, df.inputFiles()
    found = {"files": 0, "bytes": 0, "marks": 0}
    if paths:
        listing = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
        found = listing.agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("marks")
        ).first().asDict()
    return {"version": version, **found}


def _manifest_of(path: str) -> str:
    return f"{path.rstrip('/')}-manifest"


def read_manifest(spark: SparkSession, path: str) -> dict[str, object] | None:
    """The manifest of the table at ``path``, or None if it was never finished."""
    rows = read_jsonl(spark, _manifest_of(path), MANIFEST).collect()
    return rows[0].asDict() if len(rows) == 1 else None


def write_cleaned(df: DataFrame, path: str, force_refresh: bool = False, version: str = "") -> DataFrame:
    """The cleaned table at ``path``: reused if it was finished and is still up to date, else written from ``df``.

    A manifest beside the table, written last, says which files it was made from (number,
    bytes and a hash over paths, sizes and times), by which ``version`` of the caller's
    code, and how many rows it has. A table without one, with other inputs, another version
    or another number of rows is written again. Inputs that are no files do not count.
    """
    spark = df.sparkSession
    wanted = _made_from(df, version)
    held = None if force_refresh else read_manifest(spark, path)
    if held is not None and {k: held[k] for k in wanted} == wanted:
        found = read_or_none(spark, path)
        if found is not None and found.count() == held["rows"]:
            return found
    remove_path(spark, _manifest_of(path))
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    manifest = spark.createDataFrame([(wanted["version"], wanted["files"], wanted["bytes"], wanted["marks"], table.count())], MANIFEST)
    write_jsonl(manifest, _manifest_of(path), mode="overwrite")
    return table


def load_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table of a folder: all its Parquet files, or else all its CSV files.

    CSV columns are matched by name: each set of files with one header is read by
    that header, and columns a file lacks are null.
    """
    if not list_files(spark, folder, "*.parquet").isEmpty():
        return read_parquet(spark, folder)
    paths = [r.path for r in list_files(spark, folder, "*.csv").orderBy("path").select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"neither Parquet nor CSV files in {folder}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        by_header.setdefault(tuple(read_csv(spark, path).columns), []).append(path)
    tables = [read_csv(spark, group, ", ".join(f"`{c}` string" for c in header)) for header, group in by_header.items() if header]
    if not tables:
        raise FileNotFoundError(f"only empty CSV files in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def load_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several Parquet tables that exists; generated data never steps in silently."""
    for path in paths:
        found = read_or_none(spark, path)
        if found is not None:
            return found
    raise FileNotFoundError(f"none of these tables exists: {', '.join(paths)}")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line, nulls included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with blank and malformed lines left out; a missing path gives an empty table."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_jsonl_checked(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JSON lines in three tables: the rows, the lines that are malformed, and the counts of each file.

    Rows are those :func:`read_jsonl` gives. Rejects are (file, line), for a table of their
    own. Counts are (file, lines, good, bad, blank), and good, bad and blank add up to
    lines. A line is bad if it is no JSON object or a value does not fit the schema; it is
    kept whole. A missing path gives three empty tables. Each table is one scan.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = StructType([*fields.fields, StructField(BAD_LINE, StringType())])
    try:
        lines = spark.read.text(path).select("value", _read_from().alias("file"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string, file string")
    parsed = F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    lines = lines.select("file", "value", (F.trim("value") == "").alias("blank"), parsed.alias("row"))
    bad = F.col("row").isNull() | F.col("row")[BAD_LINE].isNotNull()
    rows = lines.where(~F.col("blank") & ~bad).select(*[F.col("row")[f.name].alias(f.name) for f in fields.fields])
    rejects = lines.where(~F.col("blank") & bad).select("file", F.col("value").alias("line"))
    counts = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("blank") & ~bad).alias("good"), F.count_if(~F.col("blank") & bad).alias("bad"), F.count_if("blank").alias("blank")
    )
    return rows, rejects, counts


def quarantine_jsonl(spark: SparkSession, path: str, schema: StructType | str, rejects_path: str) -> DataFrame:
    """The good rows of JSON lines; malformed lines are added to a Parquet table (file, line) at ``rejects_path``."""
    rows, rejects, _ = read_jsonl_checked(spark, path, schema)
    rejects.write.mode("append").parquet(rejects_path)
    return rows


def jsonl_line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines that are not blank, malformed ones included, as one row."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("line_count"))


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the table known to ``spark.sql`` under a name; nothing is copied."""
    df.createOrReplaceTempView(name)
    return df


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name, size and row count of every Parquet and CSV file, empty ones included; no data column is read."""
    counts = [
        read.groupBy(_read_from().alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        for pattern, read in (
            ("*.parquet", lambda r: r.parquet(folder)),
            ("*.csv", lambda r: r.option("header", True).csv(folder)),
        )
        if not list_files(spark, folder, pattern).isEmpty()
        for read in [read(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern))]
    ]
    listing = list_files(spark, folder, "*.parquet").unionByName(list_files(spark, folder, "*.csv"))
    found = listing.select(F.col("path").alias("file_path"), _listed("path").alias("key"), F.col("size").alias("file_size"))
    if counts:
        known = reduce(lambda a, b: a.unionByName(b), counts)
        found = found.join(known, "key", "left")
    else:
        found = found.withColumn("rows", F.lit(None).cast("bigint"))
    return found.select(
        "file_path",
        F.substring_index("key", "/", -1).alias("file_name"),
        "file_size",
        F.coalesce("rows", F.lit(0)).alias("row_count"),
    ).orderBy("file_path")


def write_report(
    tables: Mapping[str, DataFrame], path: str, rounded: Sequence[str] = ("summary_stats",), digits: int = 4
) -> None:
    """One JSON folder per report table; floats of the ``rounded`` tables to four digits."""
    for name, table in tables.items():
        if name in rounded:
            floats = [f.name for f in table.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))]
            table = table.withColumns({c: F.round(c, digits) for c in floats}) if floats else table
        write_jsonl(table, f"{path.rstrip('/')}/{name}", mode="overwrite")


def append_new(batch: DataFrame, path: str, key: str = "url") -> None:
    """Append the rows whose key the JSON-lines table at ``path`` does not hold yet.

    Rows without a key cannot be recognised again: they raise, with their number,
    before anything is written. Several rows with one new key count once, the first
    by a hash of the row and then its JSON text, so the result does not depend on how
    rows were spread over tasks.

    The keys lie in a Parquet table beside the store (``<path>-keys``), with the file
    each came from. Files of the store that it does not know yet, such as those of an
    append that was cut off, are read once for their keys; all others are never read
    again. Running the same batch again adds nothing.
    """
    spark = batch.sparkSession
    missing = batch.where(F.col(key).isNull()).count()
    if missing:
        raise ValueError(f"{missing} rows have no {key}")
    known = _store_keys(spark, path, key)
    row = F.struct(*batch.columns)
    once = dedupe(batch, [key], [F.xxhash64(F.to_json(row)), F.to_json(row)])
    write_jsonl(once.join(known.select(F.col("key").alias(key)), key, "left_anti").select(*batch.columns), path, mode="append")


def _store_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, file) of all rows of the store, from the key table brought up to date."""
    table = f"{path.rstrip('/')}-keys"
    schema = "key string, file string"
    held = read_or_none(spark, table)
    held = held if held is not None else spark.createDataFrame([], schema)
    try:
        listing = list_files(spark, path, "*.json")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return held
    fresh = listing.withColumn("file", _listed("path")).join(held.select("file").distinct(), "file", "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]
    if not paths:
        return held
    rows = spark.read.schema(f"`{key}` string").option("mode", "DROPMALFORMED").json(paths)
    rows.select(F.col(key).alias("key"), _read_from().alias("file")).write.mode("append").parquet(table)
    return spark.read.schema(schema).parquet(table)
