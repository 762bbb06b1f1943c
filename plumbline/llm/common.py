"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import scratch_table_path

# Rows of a small table up to which it is sent to every executor.
BROADCAST_ROWS = 20_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = scratch_table_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small(frame: DataFrame) -> DataFrame:
    """``frame`` marked for broadcast if a count shows it small, unmarked otherwise. Pass settled tables."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of every row beside ``row_id``, which tells rows with equal ``doc_id`` apart.

    The ids follow the cut of ``docs`` into partitions, which may differ each time it is
    evaluated: even a scan of files is cut by the cores there are. Read it in one job only.
    """
    return docs.select(F.monotonically_increasing_id().alias("row_id"), *columns)


def row_ids(docs: DataFrame, *columns: Column) -> DataFrame:
    """:func:`numbered` rows, settled: the ids are the same however often they are read."""
    return settled(numbered(docs, *columns), "rows")


def ranked(rows: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 within each group by ``order``, and ``size``, the rows of the group; settled.

    ``groups`` hold no nulls; nulls in ``order`` come first, equal rows in any order. The
    rows are range partitioned by both, so that a group of any size spreads over tasks. A
    rank is the place within its partition, plus what earlier partitions hold of the group.
    """
    keys = [*groups, *order]
    cut = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
    cut = settled(cut.drop("tie").withColumn("place", F.monotonically_increasing_id()), "places")
    part = F.shiftright("place", 33)
    pieces = cut.groupBy(*groups, part.alias("part")).agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*groups, "part", (F.col("start") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("origin"), F.sum("n").over(whole).alias("size"))
    pieces = small(settled(pieces, "pieces"))
    found = cut.withColumn("part", part).join(pieces, [*groups, "part"])
    return found.select(*rows.columns, (F.col("place") - F.col("origin")).alias("rank"), "size")


def running_total(values: Column) -> Column:
    """Inclusive running sums of an array of longs, in blocks so that long arrays stay cheap."""
    block = 256

    def sums(items: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("total"))
        step = lambda acc, x: F.struct(
            F.concat(acc["out"], F.array(acc["total"] + x)).alias("out"), (acc["total"] + x).alias("total")
        )
        return F.aggregate(items, start, step, lambda acc: acc["out"])

    blocks = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(block)), lambda i: F.slice(values, i + 1, block))
    inner = F.transform(blocks, sums)
    heads = sums(F.transform(inner, lambda x: F.element_at(x, -1)))
    both = F.zip_with(inner, F.concat(F.array(F.lit(0).cast("bigint")), F.slice(heads, 1, F.size(heads) - 1)), lambda x, h: F.transform(x, lambda v: v + h))
    return F.when(F.size(values) > 256, F.flatten(both)).when(F.size(values) > 0, sums(values)).otherwise(F.array().cast("array<bigint>"))


def as_longs(values: Column) -> Column:
    return values.cast("array<bigint>")


def crc32_sql(number: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an integer's decimal text."""
    text = f"({number})::VARCHAR"
    shifted = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda crc, i: xor(crc >> 1, 3988292384 * (crc & 1)), xor(state, byte))"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::BIGINT)"
    return f"xor(list_reduce({codes}, lambda state, byte: {shifted}, 4294967295::BIGINT), 4294967295)"
