"""A corpus from raw documents in five stages; each reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, language_id, line_dedup, source_mixing
from plumbline.llm.common import read_table, settled
from plumbline.session import drop_scratch, free_shuffles, scratch_scope
from plumbline.sources.files import has_file_order, with_row_number

# Texts whose best language has less than this share of the evidence are in none of the languages.
LEAST_SCORE = 0.4
# Documents are near copies if four fifths of all their five-word shingles are common to both.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
ROW = "corpus_row"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Scratch tables of the last stage of each application.
_stage_scratch: dict[str, list[str]] = {}


def _release(spark: SparkSession) -> None:
    """Delete what the last stage left behind: by now its result has been written."""
    drop_scratch(spark, _stage_scratch.pop(spark.sparkContext.applicationId, []))
    free_shuffles(spark)


def _staged(stage: Stage) -> Stage:
    """``stage``, preceded by the deletion of the scratch tables of the stage before."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        _release(spark)
        with scratch_scope(spark) as made:
            found = stage(spark, docs, folder)
        _stage_scratch[spark.sparkContext.applicationId] = made
        return found

    return run_stage


def _with_row(docs: DataFrame, without: str | None = None) -> DataFrame:
    """The columns operators read, beside the whole row as one column, or the row ``without`` one of its columns."""
    return docs.select("doc_id", "text", "lang", "source", F.struct(*[c for c in docs.columns if c != without]).alias(ROW))


def _columns(docs: DataFrame, frame: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the packed row."""
    return frame.select(*[F.col(ROW)[c].alias(c) for c in docs.columns])


@_staged
def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops texts without a letter, null ones among them, and texts that resemble no language.

    Learns from ``docs`` itself. Repeated rows and rows without id are judged like others.
    """
    found = language_id.identify(_with_row(docs), language_id.learn(docs), keep=(ROW,))
    return _columns(docs, found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


@_staged
def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Removes later copies of runs of lines; texts of which nothing but white space is left go.

    A text that loses lines gets the ``n_chars`` of what is left. Null and empty texts stay.
    """
    found = line_dedup.dedup_lines(_with_row(docs, without="text"), keep=(ROW,))
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    found = found.where(~F.coalesce(emptied, F.lit(False)))
    counted = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(ROW)["n_chars"]).cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("text"), "n_chars": counted}
    return found.select(*[changed.get(c, F.col(ROW)[c]).alias(c) for c in docs.columns])


@_staged
def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of linked ones, that with the smallest ``doc_id``.

    Of rows with equal ids the first one stays; ids that are null name a group only where
    all are. Texts without a word are in no group. A row is known by its file and its place
    there, so that only numbers of rows go through the search; documents that are not a
    Parquet table as read are written to one first.
    """
    docs = docs if has_file_order(docs) else settled(docs, "documents")
    rows = with_row_number(docs.select("doc_id", "text"), "row_id").select("row_id", F.col("doc_id").alias("id"), "text")
    gone = jaccard_join.near_duplicates(rows, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT).where("NOT first").select(F.col("row_id").alias("gone"))
    gone = settled(gone, "gone")
    free_shuffles(spark)
    packed = with_row_number(docs.select(F.struct("*").alias(ROW)), "row_id")
    return _columns(docs, packed.join(gone, F.col("row_id") == F.col("gone"), "left_anti"))


@_staged
def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold a test item. Null and empty texts hold none; an empty benchmark drops nothing."""
    found = decontaminate.find_leaks(_with_row(docs), read_table(spark, folder, "benchmark"), keep=(ROW,))
    return _columns(docs, found.where(F.size("leaks") == 0))


@_staged
def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents of the mix, with ``domain``, ``tokens`` and ``epoch``; one row per reading.

    Documents without text have no tokens and are in no mix.
    """
    return source_mixing.mix(docs, keep=("doc_id", "text", "lang", "source", "n_chars"))


# Each result has to be written before the next stage begins: that one deletes what it was read from.
STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("mixing", mixing),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    An empty table gives an empty result. Columns besides those of ``documents`` go along
    up to the last stage.
    """
    docs, before = read_table(spark, folder, "documents"), []
    for name, stage in STAGES[:-1]:
        found = stage(spark, docs, folder)
        with scratch_scope(spark) as written:
            docs = settled(found, f"stage-{name}")
        drop_scratch(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, folder)
