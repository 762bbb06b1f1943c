"""Shortest paths block by block: a task searches one block of a graph to its end, rounds carry costs between blocks."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import drop_scratch, scratch_table_path, ship_package

LABELS = "node bigint, cost double, hops int, own boolean"


def _first_of_each(node: np.ndarray, cost: np.ndarray, hops: np.ndarray) -> np.ndarray:
    """Places of the lowest (cost, hops) of each node."""
    order = np.lexsort((hops, cost, node))
    return order[np.append(True, node[order][1:] != node[order][:-1])] if len(order) else order


def spread(ways: pd.DataFrame, entries: pd.DataFrame, most: float = np.inf, target: int | None = None, whole: bool = False) -> pd.DataFrame:
    """What the costs in ``entries`` come to over the ways of one block.

    ``ways`` are (src, dst, weight, rest, leaves): rest is the least that is left to pay from dst,
    leaves says that dst lies in another block. The lowest offer to each node of other blocks and
    the block's own labels of ``target`` and of the nodes from which ways leave, so that offers which
    come back there are known to be beaten; or with ``whole`` the label of every node reached. What
    would cost more than ``most`` with its rest goes no further.
    """
    src, dst = ways["src"].to_numpy("int64"), ways["dst"].to_numpy("int64")
    weight, rest, leaves = ways["weight"].to_numpy("float64"), ways["rest"].to_numpy("float64"), ways["leaves"].to_numpy("bool")
    seeds = entries["node"].to_numpy("int64")
    nodes = np.unique(np.concatenate([src, dst[~leaves], seeds]))
    cost, hops = np.full(len(nodes), np.inf), np.zeros(len(nodes), "int32")
    at = np.searchsorted(nodes, src)
    order = np.argsort(np.where(leaves, len(nodes), at), kind="stable")[: len(src) - int(leaves.sum())]
    ends, price, left = np.searchsorted(nodes, dst[order]), weight[order], rest[order]
    first = np.searchsorted(at[order], np.arange(len(nodes) + 1))

    def improved(to: np.ndarray, c: np.ndarray, h: np.ndarray) -> np.ndarray:
        better = (c < cost[to]) | ((c == cost[to]) & (h < hops[to]))
        to, c, h = to[better], c[better], h[better]
        best = _first_of_each(to, c, h)
        cost[to[best]], hops[to[best]] = c[best], h[best]
        return to[best]

    front = improved(np.searchsorted(nodes, seeds), entries["cost"].to_numpy("float64"), entries["hops"].to_numpy("int32"))
    while len(front):
        n = first[front + 1] - first[front]
        way = np.repeat(first[front] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        c, h = np.repeat(cost[front], n) + price[way], np.repeat(hops[front] + 1, n)
        near = c + left[way] <= most
        front = improved(ends[way[near]], c[near], h[near])
    if whole:
        reached = cost < np.inf
        return pd.DataFrame({"node": nodes[reached], "cost": cost[reached], "hops": hops[reached], "own": True})
    c, h, to = cost[at[leaves]] + weight[leaves], hops[at[leaves]] + 1, dst[leaves]
    near = (c < np.inf) & (c + rest[leaves] <= most)
    to, c, h = to[near], c[near], h[near]
    best = _first_of_each(to, c, h)
    edge = np.unique(np.append(at[leaves], np.flatnonzero(nodes == target)))
    edge = edge[cost[edge] < np.inf]
    own = pd.DataFrame({"node": nodes[edge], "cost": cost[edge], "hops": hops[edge], "own": True})
    return pd.concat([own, pd.DataFrame({"node": to[best], "cost": c[best], "hops": h[best].astype("int32"), "own": False})])


def paths_by_block(
    ways: DataFrame, sources: DataFrame, block: Callable[[Column], Column], max_rounds: int | None = None,
    bound: Callable[[Column], Column] | None = None, target: int | None = None, reach: float = 0.0,
) -> DataFrame:
    """(node, cost, hops) of all nodes that can be reached from ``sources(node)`` over ``ways(src, dst, weight)``.

    Ways are dealt once by the block of their source. What rounds pass on and keep are entries:
    the best label known of each source and of each node at the end of a way between blocks. A round searches the blocks with an entry that has improved, each in one task from all its
    entries, and merges their offers to other blocks. Rounds are as many as the blocks a path
    crosses, not as its nodes; each writes the entries, and a lost executor's part is read from
    there. A last pass gives all nodes of the blocks reached.

    With ``target`` only nodes with cost plus ``bound`` up to the target's cost are found, and a
    round searches only blocks with an entry that has improved below a limit, which rises by
    ``reach``, twice as far each round.
    """
    spark = ways.sparkSession
    ship_package(spark)
    rest = bound or (lambda node: F.lit(0.0))
    dealt = ways.where("src IS NOT NULL AND dst IS NOT NULL").select(
        block(F.col("src")).alias("block"), "src", "dst", F.col("weight").cast("double").alias("weight"),
        rest(F.col("dst")).alias("rest"), (block(F.col("src")) != block(F.col("dst"))).alias("leaves"),
    )
    # As many partitions as shuffles have: entries then meet the ways where they lie.
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block").persist()
    total = F.col("cost") + rest(F.col("node"))

    def searched(some: DataFrame, entries: DataFrame, most: float, whole: bool) -> DataFrame:
        work = partial(spread, most=most, target=target, whole=whole)
        return some.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(work, LABELS)

    def settled(state: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_table_path(spark, "entries")
        state.write.parquet(path)
        return path, spark.read.schema(state.schema).parquet(path)

    start = sources.where("node IS NOT NULL").select("node").distinct()
    path, state = settled(start.select(block(F.col("node")).alias("block"), "node", F.lit(0.0).alias("cost"), F.lit(0).alias("hops"), F.lit(True).alias("waiting")))
    rounds, most, limit = 0, float("inf"), float("inf") if target is None else float("-inf")
    try:
        while True:
            if target is not None:
                best = state.where(F.col("node") == target).agg(F.min("cost")).first()[0]
                most = most if best is None else best * (1 + 1e-9) + 1e-9
            inside = state.where(total <= F.lit(most))
            least = inside.where("waiting").agg(F.min(total)).first()[0]
            if least is None:
                break
            if max_rounds is not None and rounds >= max_rounds:
                raise RuntimeError(f"no fixed point after {rounds} rounds")
            limit, reach = max(limit, least + reach), reach * 2
            # One short row per block.
            now = F.broadcast(inside.where(F.col("waiting") & (total <= F.lit(limit))).select("block").distinct())
            offers = searched(dealt.join(now, "block", "left_semi"), inside.join(now, "block", "left_semi"), most, False)
            held = inside.join(now.withColumn("now", F.lit(True)), "block", "left").select(
                "block", "node", "cost", "hops", (F.col("waiting") & F.col("now").isNull()).alias("waiting"), F.struct("cost", "hops").alias("old")
            )
            # A block's own labels are nothing new to it.
            fresh = offers.select(block(F.col("node")).alias("block"), "node", "cost", "hops", F.lit(False).alias("waiting"), F.when(F.col("own"), F.struct("cost", "hops")).alias("old"))
            merged = held.unionByName(fresh).groupBy("block", "node").agg(
                F.min(F.struct("cost", "hops")).alias("best"), F.max("waiting").alias("waiting"), F.min("old").alias("old")
            )
            improved = F.col("old").isNull() | (F.col("best") < F.col("old"))
            before = path
            path, state = settled(merged.select("block", "node", "best.cost", "best.hops", (F.col("waiting") | improved).alias("waiting")))
            drop_scratch(spark, [before])
            rounds += 1
        _, found = settled(searched(dealt.join(F.broadcast(inside.select("block").distinct()), "block", "left_semi"), inside, most, True).select("node", "cost", "hops"))
    finally:
        dealt.unpersist()
    return found
