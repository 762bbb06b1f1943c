"""A trie over conversations: every distinct beginning is a node with figures of what lies below it.

Turns become ids in positional columns, and one ROLLUP over them yields all beginnings of all
conversations; ``grouping_id`` tells their depth. A longer conversation goes on in further
rows of columns, keyed by the id of the node that the columns before end at, so all blocks
of columns are one ROLLUP. Sums over subtrees need no walk: each node belongs to its
smallest member, a conversation owns the nodes of its path from some depth on, and what
members own is summed by the same ROLLUP.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import crc32_sql, ranked, settled

WIDTH = 8  # turn-id columns
CHUNK = 512  # blocks of one conversation that are summed before the rest
PIECE = 256  # ids of a node's ends that become one string before they meet
SEEDS = (17, 43)
# Conversations of a hundred share their opening turns, at most five.
FAMILY, OPENING = 100, 6
NODE = ["depth", "i0", "i1"]


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, length, turn): each turn's place in its conversation from 0, and its id with its code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"), F.length(text).alias("chars"))
    light = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("place_given"), role.alias("role"), F.md5(text).alias("mark"), turn.alias("turn")
    )
    placed = ranked(light.where("conv_id IS NOT NULL"), ["conv_id"], ["place_given", "role", "mark"])
    return placed.select("conv_id", F.col("rank").alias("at"), F.col("size").alias("length"), "turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """:func:`positions` where conversation c begins with the first turns of c - c % 100 in place of its own.

    Their number is crc32(c) % 6, or what that conversation has. One left without turns
    stays as a row whose ``at`` and ``turn`` are null.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    opening = turns.where((F.col("at") < OPENING - 1) & (F.col("conv_id") % FAMILY == 0))
    opening = opening.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "turn"))).alias("opening"))
    heads = turns.where("at = 0").select("conv_id", base.alias("base"), "length", shared.alias("shared")).join(opening, "base", "left")
    taken = F.slice(F.coalesce("opening", F.array().cast(opening.schema["opening"].dataType)), F.lit(1), F.col("shared").cast("int"))
    heads = heads.withColumn("taken", taken).withColumn("n_taken", F.size("taken"))
    heads = settled(heads.select("conv_id", "shared", "n_taken", (F.col("n_taken") + F.greatest(F.col("length") - F.col("shared"), F.lit(0))).alias("length"), "taken"), "openings")
    front = heads.select("conv_id", "length", F.inline("taken"))
    own = turns.select("conv_id", "at", "turn").join(heads.select("conv_id", "shared", "n_taken", "length"), "conv_id").where("at >= shared")
    own = own.select("conv_id", (F.col("at") - F.col("shared") + F.col("n_taken")).alias("at"), "length", "turn")
    bare = heads.where("length = 0").select("conv_id", F.lit(None).cast("bigint").alias("at"), "length", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"))
    return front.select("conv_id", "at", "length", "turn").unionByName(own).unionByName(bare)


def _mark(at: Column, turn: Column, i: int) -> Column:
    return F.xxhash64(F.lit(SEEDS[i]), at.cast("bigint"), turn["key"])


def _blocks(turns: DataFrame) -> DataFrame:
    """Rows of columns: (conv_id, length, block, prior node p0 p1, before, t1..t8, x0, x1, chars)."""
    at, turn = F.col("at"), F.col("turn")
    block = F.coalesce(F.floor(at / WIDTH), F.lit(0)).cast("bigint")
    rows = turns.groupBy("conv_id", "length", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.when(at.isNotNull(), F.struct("at", "turn")))).alias("turns"),
        *[F.coalesce(F.bit_xor(F.when(at.isNotNull(), _mark(at, turn, i))), F.lit(0)).cast("bigint").alias(f"x{i}") for i in range(2)],
        F.coalesce(F.sum(turn["chars"]), F.lit(0)).cast("bigint").alias("chars"),
    )
    columns = [F.get("turns", F.lit(i))["turn"].alias(f"t{i + 1}") for i in range(WIDTH)]
    rows = settled(rows.select("conv_id", "length", "block", "x0", "x1", "chars", *columns), "turn-columns")
    zero = F.lit(0).cast("bigint")
    first = rows.where("block = 0").withColumns({"p0": zero, "p1": zero, "before": zero})
    # What precedes a block is summed in chunks of blocks, so that a huge conversation is no single task.
    chunk = F.floor(F.col("block") / CHUNK)
    further = rows.where(F.col("length") > WIDTH).withColumn("chunk", chunk)

    def earlier(window) -> list[Column]:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        sums = (F.bit_xor("x0"), F.bit_xor("x1"), F.sum("chars"))
        return [F.coalesce(s.over(window), zero) for s in sums]

    chunks = further.groupBy("conv_id", "chunk").agg(F.bit_xor("x0").alias("x0"), F.bit_xor("x1").alias("x1"), F.sum("chars").alias("chars"))
    c = earlier(Window.partitionBy("conv_id").orderBy("chunk"))
    chunks = chunks.select("conv_id", "chunk", c[0].alias("c0"), c[1].alias("c1"), c[2].alias("ahead"))
    w = earlier(Window.partitionBy("conv_id", "chunk").orderBy("block"))
    further = further.withColumns({"p0": w[0], "p1": w[1], "before": w[2]}).where("block > 0").join(chunks, ["conv_id", "chunk"])
    further = further.withColumns({"p0": F.col("p0").bitwiseXOR(F.col("c0")), "p1": F.col("p1").bitwiseXOR(F.col("c1")), "before": F.col("before") + F.col("ahead")})
    return first.unionByName(further.select(*first.columns))


def _rolled(rows: DataFrame, figures: str) -> DataFrame:
    """One row per node: depth, id, its parent's id, chars before its last turn and of it, and ``figures``."""
    turns = ", ".join(f"t{i + 1}" for i in range(WIDTH))
    rolled = rows.sparkSession.sql(
        f"SELECT block, p0, p1, array({turns}) AS path, {WIDTH} - bit_count(grouping_id()) AS filled, max(before) AS before, {figures} "
        f"FROM {{rows}} GROUP BY block, p0, p1, ROLLUP({turns})",
        rows=rows,
    )
    # Columns past a conversation's end are null: their groupings repeat the last real one. Blocks but the first have their top node in the block before.
    rolled = rolled.where("CASE WHEN filled = 0 THEN block = 0 ELSE get(path, filled - 1) IS NOT NULL END")
    begin = F.col("block") * WIDTH

    def node(i: int, count: Column) -> Column:
        marks = F.transform(F.slice("path", F.lit(1), count), lambda t, k: _mark(begin + k, t, i))
        return F.aggregate(marks, F.col(f"p{i}"), lambda a, b: a.bitwiseXOR(b))

    upper = F.greatest(F.col("filled") - 1, F.lit(0))
    within = F.aggregate(F.slice("path", F.lit(1), upper), F.lit(0).cast("bigint"), lambda a, t: a + t["chars"])
    names = [c for c in rolled.columns if c not in ("block", "p0", "p1", "path", "filled", "before")]
    return rolled.select(
        (begin + F.col("filled")).alias("depth"), *[node(i, F.col("filled")).alias(f"i{i}") for i in range(2)],
        *[node(i, upper).alias(f"u{i}") for i in range(2)], (F.col("before") + within).alias("before"), *names,
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, i0, i1, ends_sha256) from (depth, i0, i1, conv_id): ids as text, ascending, hashed as a stream.

    A hash over a list has to be taken in order, by one task a node. That task gets one
    string per :data:`PIECE` ids and holds one batch of them.
    """
    placed = ranked(ends, NODE, ["conv_id"])
    pieces = placed.groupBy(*NODE, F.floor(F.col("rank") / PIECE).alias("piece")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            done = []
            for depth, i0, i1, ids in zip(batch["depth"], batch["i0"], batch["i1"], batch["ids"]):
                if (depth, i0, i1) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (depth, i0, i1), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    return ordered.mapInPandas(hashed, "depth bigint, i0 bigint, i1 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns`` as :func:`positions` or :func:`rebuilt` give them, one row per node.

    ``conv_id`` (smallest member; with ``depth`` it names the node), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (code points that need not be stored again, over the subtree) and
    ``ends_sha256`` of the members that end here.

    Rows with a null ``conv_id`` belong to no conversation and take no part. Turns are in
    order of ``turn``, null first; equal ones by role, then by the MD5 of their text, and
    repeated rows are turns of their own. Null roles and texts count as empty. Turns are
    compared by 128 bits of their role and text, nodes by 128 bits over their turns. An
    empty table has no root. Further columns take no part.
    """
    rows = settled(_blocks(turns), "trie-rows")
    nodes = _rolled(rows, "count(*) AS n, min(conv_id) AS conv_id, max(length) AS longest")
    # A conversation owns the nodes whose smallest member it is: all of its path from some depth on, or none.
    owners = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "before")).alias("top"), F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf")
    )
    owners = rows.groupBy("conv_id").agg(F.sum("chars").alias("total")).join(owners, "conv_id", "left")
    owners = owners.select("conv_id", "total", F.col("top.depth").alias("since"), F.col("top.before").alias("skipped"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    owned = rows.join(settled(owners, "owners"), "conv_id").withColumn("own", F.when(F.col("since").isNotNull(), F.col("total") - F.col("skipped")).otherwise(0))
    nodes = _rolled(
        owned, "count(*) AS n_convs, sum(total) AS total, sum(own) AS own, sum(leaf) AS n_leaves, min(struct(conv_id, since, skipped, length)) AS least"
    )
    # Of what members own, the smallest one owns the part above this node too.
    saved = F.col("total") - F.col("n_convs") * F.col("before") - (F.col("own") + F.col("least.skipped") - F.col("before"))
    nodes = settled(
        nodes.select(*NODE, "u0", "u1", "least.conv_id", "least.since", (F.col("least.length") > F.col("depth")).alias("goes_on"), "n_convs", "n_leaves", saved.alias("saved_tokens")),
        "trie-nodes",
    )
    branches = nodes.where("depth > 0 AND depth = since")
    forks = branches.groupBy((F.col("depth") - 1).alias("depth"), F.col("u0").alias("i0"), F.col("u1").alias("i1")).agg(F.count(F.lit(1)).alias("forks"))
    last = rows.where((F.col("block") + 1) * WIDTH >= F.col("length"))
    ends = last.select(F.col("length").cast("bigint").alias("depth"), *[F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"i{i}") for i in range(2)], "conv_id")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("i0").alias("u0"), F.col("i1").alias("u1"), F.col("conv_id").alias("parent_conv_id"))
    root = nodes.where("depth = 0").select("conv_id").scalar()
    columns = [*nodes.columns, "parent_conv_id"]
    # Most nodes share the smallest member of their parent, and those at depth 1 have the root: only real forks are joined.
    with_parent = nodes.where("depth = 0 OR depth > since").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))).select(*columns)
    with_parent = with_parent.unionByName(branches.where("depth = 1").withColumn("parent_conv_id", root).select(*columns))
    with_parent = with_parent.unionByName(branches.where("depth > 1").join(parents, ["depth", "u0", "u1"]).select(*columns))
    found = with_parent.join(forks, NODE, "left").join(_end_digests(ends), NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        (F.coalesce("forks", F.lit(0)) + F.col("goes_on").cast("bigint")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


ORACLE = f"""
WITH t AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS own,
    ({crc32_sql("conv_id")} % 6)::INT AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns
  FROM t c LEFT JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM r),
n AS (
  SELECT depth, turns[1:depth] AS seq, min(conv_id) AS conv_id, count(*) AS n_convs, length(turns[1:depth][-1].text) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, turns[1:depth]),
kids AS (
  SELECT c.depth, c.seq, p.conv_id AS parent_conv_id FROM n c JOIN n p ON p.depth = c.depth - 1 AND p.seq = c.seq[1:c.depth - 1]),
counts AS (SELECT depth - 1 AS depth, seq[1:depth - 1] AS seq, count(*) AS n_children FROM kids GROUP BY ALL),
below AS (
  SELECT n.depth, n.seq, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
    sum((s.n_convs - 1) * coalesce(s.chars, 0))::BIGINT AS saved_tokens
  FROM n JOIN n s ON s.depth >= n.depth AND s.seq[1:n.depth] = n.seq
  LEFT JOIN counts k ON k.depth = s.depth AND k.seq = s.seq GROUP BY n.depth, n.seq)
SELECT n.conv_id, n.depth, parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM n JOIN below b ON b.depth = n.depth AND b.seq = n.seq
LEFT JOIN kids k ON k.depth = n.depth AND k.seq = n.seq LEFT JOIN counts c ON c.depth = n.depth AND c.seq = n.seq
"""
