"""Small tables with every awkward case, shared by the tests of the text operators."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997}" for i in range(40_000))

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside or give to their results.
        T.StructField("row_id", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("epoch", T.StringType()),
        T.StructField("k_0", T.StringType()),
        T.StructField("leaks", T.StringType()),
        T.StructField("n_removed", T.StringType()),
    ]
)


def documents(spark, rows):
    """``rows`` of (doc_id, text[, lang, source]); the clashing columns are filled."""
    full = [(r[0], r[1], *(list(r[2:4]) + [None, None])[:2], None if r[1] is None else len(r[1]), *["x"] * 7) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd_rows():
    return [
        (1, None, "en", "src1"),
        (2, "", "en", "src1"),
        (3, "   \n\t ", None, None),
        (4, LONG, "en", "src2"),
        (4, LONG, "en", "src2"),
        (None, "a row without id holds a text", None, "src3"),
        (None, None, None, None),
        (5, "12345 !!! 67", "de", "src1"),
        (6, "same words here", "en", "src1"),
        (7, "same words here", "en", "src1"),
        (8, "\U0001f600 émoji ünd\nzwei", "de", "s\nrc4"),
    ]
