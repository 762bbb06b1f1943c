"""Exact nearest vectors by integer inner product: a KD-tree per shard, searched best first.

Vectors are dealt to shards by hash. A shard's tree splits at medians and keeps, for each
node, the tight box around its vectors and their smallest id. The box bounds the product
of a query with any vector inside, so a search opens nodes by falling bound and ends at the
first bound below the worst of its k best. Queries travel in blocks: each block first
searches one shard, and the k-th score found there is the starting bound in all others.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import row_ids, settled
from plumbline.session import ship_package

SHARD_ROWS = 16_384
BLOCK_QUERIES = 256
LEAF = 256
NO_ID = np.iinfo(np.int64).max  # stands for a null vec_id, which loses every tie
NO_SCORE = np.iinfo(np.int64).min


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    held = arrays["vectors"]
    if held.size:
        # The narrowest type keeps blobs small: components of unit vectors fit in 16 bits.
        arrays["vectors"] = held.astype(np.result_type(np.min_scalar_type(held.min()), np.min_scalar_type(held.max()), np.int16))
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as held:
        return {name: held[name] for name in held.files}


def build_tree(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Nodes in heap order of their making: box, smallest id, children (or -1) and range of vectors."""
    order = np.arange(len(ids))
    lows, highs, least, kids, ranges = [], [], [], [], []

    def add(begin: int, end: int) -> int:
        part = vectors[order[begin:end]]
        lows.append(part.min(axis=0))
        highs.append(part.max(axis=0))
        least.append(ids[order[begin:end]].min())
        kids.append((-1, -1))
        ranges.append((begin, end))
        return len(least) - 1

    open_nodes = [add(0, len(ids))] if len(ids) else []
    while open_nodes:
        node = open_nodes.pop()
        begin, end = ranges[node]
        spread = highs[node] - lows[node]
        if end - begin <= leaf or not spread.any():
            continue
        # The median by position halves a node even where many values are equal.
        half = (end - begin) // 2
        order[begin:end] = order[begin:end][np.argpartition(vectors[order[begin:end], int(spread.argmax())], half)]
        kids[node] = (add(begin, begin + half), add(begin + half, end))
        open_nodes.extend(kids[node])
    pick = lambda x: x[order]
    return {
        "vectors": pick(vectors), "ids": pick(ids), "rows": pick(rows), "lows": np.array(lows), "highs": np.array(highs),
        "least": np.array(least), "kids": np.array(kids), "ranges": np.array(ranges),
    }


def _exact(tree: dict[str, np.ndarray], queries: np.ndarray) -> tuple[type, dict[str, np.ndarray]]:
    """float64 where every product is an exact integer there, else int64 (which wraps like any long)."""
    most = max((abs(float(x)) for a in (tree["lows"], tree["highs"]) if a.size for x in (a.min(), a.max())), default=0.0)
    ask = max((abs(float(x)) for x in (queries.min(), queries.max())), default=0.0) if queries.size else 0.0
    kind = np.float64 if most * ask * max(1, queries.shape[1]) < 2**53 else np.int64
    return kind, {name: tree[name].astype(kind) for name in ("vectors", "lows", "highs")}


def search(tree: dict[str, np.ndarray], queries: np.ndarray, query_rows: np.ndarray, floor_score: np.ndarray, floor_id: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """For each query the (score, id) that may be among its k best, best first; floors are its k-th so far."""
    if not len(tree["ids"]):
        return [[] for _ in queries]
    kind, held = _exact(tree, queries)
    asked = queries.astype(kind)
    bounds = np.maximum(asked, 0) @ held["highs"].T + np.minimum(asked, 0) @ held["lows"].T
    # Where products may wrap, bounds say nothing: every node is opened.
    if kind is np.int64:
        bounds = np.full(bounds.shape, np.iinfo(np.int64).max)
    kids, ranges, least, ids, rows = tree["kids"], tree["ranges"], tree["least"], tree["ids"], tree["rows"]
    found = []
    for i, query in enumerate(asked):
        best: list[tuple[int, int]] = []  # (-score, id), ascending
        worst = (-int(floor_score[i]), int(floor_id[i]))
        queue = [(-bounds[i, 0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if (int(bound), int(least[node])) > worst:
                if int(bound) > worst[0]:
                    break
                continue
            left, right = kids[node]
            if left >= 0:
                heapq.heappush(queue, (-bounds[i, left], left))
                heapq.heappush(queue, (-bounds[i, right], right))
                continue
            begin, end = ranges[node]
            scores = held["vectors"][begin:end] @ query
            near = np.flatnonzero((scores >= -worst[0]) & (rows[begin:end] != query_rows[i]))
            if len(near) > 4 * k:
                # The k best by (score, id) among equal scores too: ids settle ties.
                near = near[np.lexsort((ids[begin + near], -scores[near]))[:k]]
            best = sorted(best + [(-int(scores[j]), int(ids[begin + j])) for j in near])[:k]
            if len(best) == k:
                worst = min(worst, best[-1])
        found.append([(-s, v) for s, v in best if (s, v) <= worst or len(best) < k])
    return found


def _integers(lists: pd.Series) -> np.ndarray:
    scaled = np.floor(256.0 * np.stack(lists.to_numpy()).astype(np.float64))
    return np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best of each query, all if fewer.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; each is compared with
    all rows but itself, so rows that repeat a ``vec_id`` are candidates for each other and,
    if they are queries, give one set of ranks each. Ties go to the smaller ``vec_id``, null
    ids last. Vectors that are null, empty, or hold null or non-finite values take no part;
    vectors of different lengths are never compared. Scores are longs and wrap like them.
    Further columns are left out.
    """
    ship_package(vectors.sparkSession)
    v = F.col("v")
    rows = row_ids(vectors, F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("v"))
    rows = rows.withColumn("v", v.cast("array<double>"))
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & whole)
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    blocks = max(1, -(-total // (every * BLOCK_QUERIES)))
    rows = rows.select("row_id", F.coalesce("id", F.lit(int(NO_ID))).alias("id"), "v", F.size(v).alias("dim"), F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int").alias("shard"))

    def plant(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(_integers(group["v"]), group["id"].to_numpy(np.int64), group["row_id"].to_numpy(np.int64))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [_pack(**tree)]})

    trees = settled(rows.groupBy("dim", "shard").applyInPandas(plant, "dim int, shard int, tree binary"), "trees")

    def gather(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        blob = _pack(
            vectors=_integers(group["v"]), ids=group["id"].to_numpy(np.int64), rows=group["row_id"].to_numpy(np.int64),
            scores=np.full(n, NO_SCORE), others=np.full(n, NO_ID),
        )
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [blob]})

    asked = rows.where((F.col("id") != int(NO_ID)) & (F.col("id") % every == 0)).withColumn("block", F.pmod(F.xxhash64("row_id", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = asked.groupBy("dim", "block").applyInPandas(gather, "dim int, block int, queries binary")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                tree, q = _unpack(row.tree), _unpack(row.queries)
                found = search(tree, q["vectors"], q["rows"], q["scores"], q["others"], k)
                for i, best in enumerate(found):
                    if len(best) == k:
                        q["scores"][i], q["others"][i] = best[-1]
                flat = [(int(q["rows"][i]), int(q["ids"][i]), s, v) for i, best in enumerate(found) for s, v in best]
                yield pd.DataFrame({"dim": [row.dim], "block": [row.block], "shard": [row.shard], "queries": [_pack(**q)], "found": [flat]})

    shape = "dim int, block int, shard int, queries binary, found array<struct<row_id: bigint, query_id: bigint, score: bigint, id: bigint>>"
    # The pairs of blocks and shards have one row each with both blobs; small batches keep few of them in memory.
    home = asked.withColumn("shard", F.col("block") % shards)
    first = settled(home.join(trees, ["dim", "shard"], "left").where("tree is not null").mapInPandas(look, shape), "first-shard")
    misplaced = asked.join(first.select("dim", "block").distinct(), ["dim", "block"], "left_anti").withColumn("home", F.lit(-1))
    again = first.select("dim", "block", "queries", F.col("shard").alias("home")).unionByName(misplaced)
    again = again.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != home").drop("home")
    rest = again.join(trees, ["dim", "shard"]).mapInPandas(look, shape)
    hits = first.select(F.inline("found")).unionByName(rest.select(F.inline("found")))
    ordered = Window.partitionBy("row_id").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != int(NO_ID), F.col("id")).alias("vec_id"), "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
