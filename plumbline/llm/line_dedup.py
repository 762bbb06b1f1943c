"""Removal of repeated runs of lines, by a suffix array over line ids.

Only lines that occur more than once can be part of a repeated run, so only they get
suffixes. Prefix doubling names suffixes by their rank among all runs of 1, 2, 4, ...
lines; a rank is the place in the suffix array at which the suffixes sharing that run
begin. A suffix whose run has become unique is settled and leaves (doubling with
discarding), so each round works on a fraction of the one before.

The suffixes that share a run of a given length are the interval of the suffix array in
which longest common prefixes reach that length. An interval's smallest text position is
its first copy; all others are later ones. A maximal run of enough words is the union of
its shortest qualifying windows, so intervals are formed at just those lengths: a window
of ``n`` lines is named by the ranks of its first and last ``2**a`` lines, ``2**a <= n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import row_ids, settled

MIN_WORDS = 50
# Line hashes are dealt to this many ordered buckets to rank them without sorting them in one task.
RANK_BUCKETS = 4096


def word_count(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _lines(rows: DataFrame) -> DataFrame:
    """(row_id, id, pos, h0, h1, words) of every line."""
    lines = rows.select("row_id", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    hashes = [F.xxhash64(F.lit(seed), F.col("line")).alias(f"h{i}") for i, seed in enumerate((3, 5))]
    return lines.select("row_id", "id", "pos", *hashes, word_count(F.col("line")).alias("words"))


def _line_ranks(lines: DataFrame) -> DataFrame:
    """(h0, h1, rank) of lines that occur more than once, in hash order."""
    repeated = lines.groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # The top 12 bits, shifted to keep the order of signed hashes.
    repeated = settled(repeated.withColumn("bucket", F.shiftright("h0", 52)), "line-ids")
    sizes = repeated.groupBy("bucket").agg(F.sum("n").alias("size"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("bucket").alias("b"), F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    within = Window.partitionBy("bucket").orderBy("h0", "h1").rowsBetween(Window.unboundedPreceding, -1)
    ranked = repeated.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # One row for each of at most RANK_BUCKETS buckets.
    return ranked.join(F.broadcast(offsets), F.col("bucket") == F.col("b")).select("h0", "h1", (F.col("offset") + F.col("inner")).alias("rank"))


def _doubled(ranks: DataFrame, length: int) -> DataFrame:
    """Ranks of runs of ``2 * length`` lines that occur more than once."""
    later = ranks.select(F.col("row_id"), (F.col("pos") - length).alias("pos"), F.col("rank").alias("next"))
    pairs = ranks.join(later, ["row_id", "pos"])
    classes = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("rank").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.where("n > 1").select(F.col("rank").alias("r"), F.col("next").alias("x"), (F.col("rank") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("longer"))
    return pairs.join(classes, (F.col("rank") == F.col("r")) & (F.col("next") == F.col("x"))).select("row_id", "pos", F.col("longer").alias("rank"))


def _windows(active: DataFrame, min_words: int) -> DataFrame:
    """(row_id, id, pos, n): shortest windows of repeated lines with enough words, by start and by end."""
    by_row = Window.partitionBy("row_id").orderBy("pos")
    stretches = active.withColumn("stretch", F.col("pos") - F.row_number().over(by_row))
    upto = Window.partitionBy("row_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stretches = stretches.withColumn("after", F.sum("words").over(upto))
    whole = Window.partitionBy("row_id", "stretch")
    stretches = stretches.withColumn("all", F.sum("words").over(whole)).where(F.col("all") >= min_words)
    edges = stretches.select("row_id", "id", "stretch", "pos", F.explode(F.array(F.struct((F.col("after") - F.col("words")).alias("at"), F.lit(True).alias("opens")), F.struct(F.col("after").alias("at"), F.lit(False).alias("opens")))).alias("edge"))
    edges = edges.select("row_id", "id", "stretch", "pos", "edge.at", "edge.opens")
    group = Window.partitionBy("row_id", "stretch")
    # Growing frames on either side of the current number of words; sums over them are kept, not redone.
    ends = group.orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -min_words)
    starts = group.orderBy("at").rangeBetween(Window.unboundedPreceding, -min_words)
    edges = edges.select(
        "row_id", "id", "pos", "opens",
        F.min(F.when(~F.col("opens"), F.col("pos"))).over(ends).alias("end"),
        F.max(F.when(F.col("opens"), F.col("pos"))).over(starts).alias("start"),
    )
    first, last = F.when(F.col("opens"), F.col("pos")).otherwise(F.col("start")), F.when(F.col("opens"), F.col("end")).otherwise(F.col("pos"))
    found = edges.select("row_id", "id", first.alias("pos"), (last - first + 1).alias("n"))
    return found.where(F.col("n").isNotNull()).distinct()


def later_copies(rows: DataFrame, min_words: int) -> DataFrame:
    """(row_id, pos, n): windows of lines that repeat an earlier one. ``rows`` has row_id, id, text."""
    lines = settled(_lines(rows), "lines")
    ranks = _line_ranks(lines)
    active = settled(lines.join(ranks, ["h0", "h1"]).select("row_id", "id", "pos", "words", "rank"), "suffixes")
    windows = settled(_windows(active, min_words), "windows").withColumn("level", F.floor(F.log2("n") + 1e-9).cast("int"))
    levels = [active.select("row_id", "pos", "rank")]
    deepest = windows.agg(F.max("level")).first()[0]
    for level in range(deepest or 0):
        levels.append(settled(_doubled(levels[-1], 1 << level), f"ranks-{2 << level}"))
    table = None
    for level, ranked in enumerate(levels):
        marked = ranked.withColumn("level", F.lit(level))
        table = marked if table is None else table.unionByName(marked)
    named = windows.join(table.withColumnRenamed("rank", "head"), ["level", "row_id", "pos"])
    # Java's shift takes no column, so the start of the last 2**level lines comes from a power.
    named = named.withColumn("tail_pos", (F.col("pos") + F.col("n") - F.pow(F.lit(2), F.col("level"))).cast("int"))
    tails = table.select("level", "row_id", F.col("pos").alias("tail_pos"), F.col("rank").alias("tail"))
    named = named.join(tails, ["level", "row_id", "tail_pos"]).select("row_id", "id", "pos", "n", "head", "tail")
    place = F.struct("id", "row_id", "pos")
    key = ["n", "head", "tail"]
    intervals = named.groupBy(*key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return named.join(intervals.drop("copies"), key).where(place != F.col("first")).select("row_id", "pos", "n")


def _kept_slices(copies: DataFrame) -> DataFrame:
    """(row_id, gone): per row, the disjoint removed stretches of lines as (start, end), by start."""
    spans = copies.groupBy("row_id", "pos").agg(F.max(F.col("pos") + F.col("n")).cast("int").alias("end"))
    earlier = Window.partitionBy("row_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("new", (F.col("pos") > F.coalesce(F.max("end").over(earlier), F.lit(-1))).cast("int"))
    spans = spans.withColumn("part", F.sum("new").over(upto))
    parts = spans.groupBy("row_id", "part").agg(F.min("pos").alias("start"), F.max("end").alias("end"))
    return parts.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``text`` without later copies, ``n_lines`` before and ``n_removed``.

    A run of consecutive lines of one text, of ``min_words`` words or more, goes if the same
    run begins earlier: in a text with a smaller ``doc_id`` (null smallest, equal ids by
    place of the row), or further up in the same text, overlapping or not. Lines are equal
    byte for byte; words are what white space separates. Every row stays: a text whose lines
    all go becomes empty, a null text stays null with 0 lines, an empty text has one line.
    Columns of ``docs`` not in ``keep`` are left out, whatever their names.
    """
    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = row_ids(docs, F.col("doc_id").alias("id"), F.col("text"), *hidden)
    gone = _kept_slices(later_copies(rows.select("row_id", "id", "text").where("text is not null"), min_words))
    rows = rows.join(gone.withColumnRenamed("row_id", "r"), F.col("row_id") == F.col("r"), "left")
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<struct<start: int, end: int>>")
    spans = F.coalesce("gone", none)
    edge = lambda at: F.array(F.struct(at.cast("int").alias("start"), at.cast("int").alias("end")))
    gaps = F.zip_with(F.concat(edge(F.lit(0)), spans), F.concat(spans, edge(F.size(lines))), lambda a, b: F.struct(a["end"].alias("from"), (b["start"] - a["end"]).alias("count")))
    kept = F.flatten(F.transform(F.filter(gaps, lambda g: g["count"] > 0), lambda g: F.slice(lines, g["from"] + 1, g["count"])))
    removed = F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        removed.cast("bigint").alias("n_removed"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l),
p AS (
  SELECT b.doc_id, b.pos, b.words, a.doc_id AS other, b.pos - a.pos AS shift
  FROM w a JOIN w b ON a.line = b.line AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.pos < b.pos)),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY pos) AS run FROM p),
g AS (SELECT doc_id, min(pos) AS s, max(pos) AS e FROM r GROUP BY doc_id, other, shift, run HAVING sum(words) >= {MIN_WORDS}),
dead AS (SELECT DISTINCT w.doc_id, w.pos FROM w JOIN g ON w.doc_id = g.doc_id AND w.pos BETWEEN g.s AND g.e),
t AS (
  SELECT w.doc_id, string_agg(line, chr(10) ORDER BY w.pos) FILTER (dead.pos IS NULL) AS text, count(dead.pos) AS n_removed, count(*) AS n_lines
  FROM w LEFT JOIN dead ON w.doc_id = dead.doc_id AND w.pos = dead.pos GROUP BY w.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text, coalesce(t.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
"""
