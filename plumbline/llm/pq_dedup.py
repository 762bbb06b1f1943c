"""Near copies among embeddings by product quantisation: inverted lists, residual codes, exact rerank.

Per label, a bounded sample gives the centroids of coarse lists and a codebook per subspace
of what is left of a vector once its centroid is taken away. All vectors are then put into
lists and coded. Each vector probes every list that can hold a vector within reach: one
whose border with its own list is no farther off than the distance that the least cosine
allows. In a list, distances to codes are sums of looked-up parts; as each code's error is
stored, a vector is passed over only if its distance plus that error is out of reach. What
remains is compared by exact cosine. Both bounds are safe, so no link is lost.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import ranked, row_ids, settled
from plumbline.llm.components import connected_components
from plumbline.session import ship_package

COSINE = 0.98
SAMPLE = 16_384  # vectors of a label that centroids and codebooks are fitted on
LIST_ROWS, MAX_LISTS = 1024, 512
SUBSPACES, CODES, ROUNDS = 8, 64, 6
PART_ROWS = 16_384  # vectors coded by one task at a time
BLOCK, QUERIES = 1024, 1024  # vectors of a list, and vectors that probe it, in one task
SLICE, PAIRS = 64, 65_536
# Slack of the bounds for rounding; links themselves are decided by cosines.
EPS = 1e-7
SPACE = ["label", "dim"]
UNIT = [*SPACE, "list", "block"]


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as held:
        return {name: held[name] for name in held.files}


def _units(lists: pd.Series) -> np.ndarray:
    found = np.stack(lists.to_numpy()).astype(np.float64)
    # Largest component first, so that squares neither overflow nor vanish.
    found /= np.abs(found).max(axis=1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _held(blobs: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(b, dtype=np.float64) for b in blobs])


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T, 0)


def _means(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` centres at most by Lloyd's rounds from evenly spaced starts."""
    centres = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(ROUNDS):
        nearest = _squared(x, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _subspaces(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), min(SUBSPACES, dim))


def fit(sample: np.ndarray, lists: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Centroids of the lists and, for each subspace, the codebook of residuals."""
    centroids = _means(sample, lists)
    residuals = sample - centroids[_squared(sample, centroids).argmin(axis=1)]
    return centroids, [_means(residuals[:, part], CODES) for part in _subspaces(sample.shape[1])]


def encode(x: np.ndarray, centroids: np.ndarray, books: list[np.ndarray], reach: float) -> tuple[np.ndarray, ...]:
    """List, distance to its centroid, codes and their error of each vector, all distances, and the lists it must probe."""
    squared = _squared(x, centroids)
    own = squared.argmin(axis=1)
    near = squared[np.arange(len(x)), own]
    residuals, codes, error = x - centroids[own], [], np.zeros(len(x))
    for part, book in zip(_subspaces(x.shape[1]), books):
        apart = _squared(residuals[:, part], book)
        codes.append(apart.argmin(axis=1))
        error += apart.min(axis=1)
    between = np.sqrt(_squared(centroids, centroids))[own]
    # A vector within reach lies at most that far beyond the plane halfway between the centroids.
    probed = squared - near[:, None] <= 2 * (reach + EPS) * between + EPS
    probed[np.arange(len(x)), own] = True
    return own, np.sqrt(near), np.stack(codes, axis=1).astype(np.uint8), np.sqrt(error), np.sqrt(squared), probed


def compare(asked: np.ndarray, centroid: np.ndarray, books: list[np.ndarray], held: np.ndarray, codes: np.ndarray, error: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, member) whose cosine is at least ``cosine``, in slices of queries."""
    reach = np.sqrt(2 - 2 * cosine) + EPS
    parts = _subspaces(asked.shape[1])
    for begin in range(0, len(asked), SLICE):
        some = asked[begin : begin + SLICE]
        residuals = some - centroid
        distance = np.zeros((len(some), len(held)))
        for i, (part, book) in enumerate(zip(parts, books)):
            distance += _squared(residuals[:, part], book)[:, codes[:, i]]
        q, x = np.nonzero(np.sqrt(distance) <= reach + error)
        for at in range(0, len(q), PAIRS):
            i, j = q[at : at + PAIRS], x[at : at + PAIRS]
            linked = np.einsum("ij,ij->i", some[i], held[j]) >= cosine
            yield begin + i[linked], j[linked]


def _hubs(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For both sides the smallest name among the nodes that the pairs (i, j) connect."""
    left, right = left.copy(), right.copy()
    while len(i):
        before = left.sum(), right.sum()
        np.minimum.at(right, j, left[i])
        np.minimum.at(left, i, right[j])
        if before == (left.sum(), right.sum()):
            break
    return left, right


def _models(distinct: DataFrame, sizes: DataFrame) -> DataFrame:
    """(label, dim, list, model): per list its centroid and the codebooks, and all centroids as list -1."""
    order = Window.partitionBy(*SPACE).orderBy(F.xxhash64("rep"), "rep")
    sample = distinct.withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE).join(sizes, SPACE)

    def fitted(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        lists = int(min(MAX_LISTS, max(1, group["n"].iloc[0] // LIST_ROWS)))
        centroids, books = fit(_units(group["v"]), lists)
        named = {f"book{i}": book for i, book in enumerate(books)}
        blobs = [_pack(centroids=centroids, **named)] + [_pack(centroids=c[None], **named) for c in centroids]
        return pd.DataFrame({"label": key[0], "dim": key[1], "list": range(-1, len(centroids)), "model": blobs})

    return sample.select(*SPACE, "n", "v").groupBy(*SPACE).applyInPandas(fitted, "label string, dim int, list int, model binary")


def _model(blob: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    held = _unpack(blob)
    return held["centroids"], [held[f"book{i}"] for i in range(len(held) - 1)]


def _coded(distinct: DataFrame, sizes: DataFrame, models: DataFrame, reach: float) -> DataFrame:
    """(label, dim, rep, copies, unit, list, d, code, error, probes); a label's rows are dealt over parts, each with a copy of the model."""
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))
    rows = distinct.join(sizes, SPACE).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).select(*SPACE, "part", "rep", "copies", "v")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    whole = models.where("list = -1").join(sizes, SPACE).select(*SPACE, "model", parts)

    def code(key: tuple, group: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        out = []
        for begin in range(0, len(group), 2048):
            some = group.iloc[begin : begin + 2048]
            x = _units(some["v"])
            own, d, codes, error, away, probed = encode(x, *_model(model["model"].iloc[0]), reach)
            probes = [[{"list": int(j), "away": float(away[i, j])} for j in np.flatnonzero(probed[i])] for i in range(len(x))]
            out.append(
                pd.DataFrame(
                    {
                        "label": key[0], "dim": key[1], "rep": some["rep"].to_numpy(), "copies": some["copies"].to_numpy(), "unit": [u.tobytes() for u in x],
                        "list": own, "d": d, "code": [c.tobytes() for c in codes], "error": error, "probes": probes,
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame()

    shape = (
        "label string, dim int, rep bigint, copies bigint, unit binary, list int, d double, code binary, error double, "
        "probes array<struct<list: int, away: double>>"
    )
    return rows.groupBy(*SPACE, "part").cogroup(whole.groupBy(*SPACE, "part")).applyInPandas(code, shape)


def _searched(coded: DataFrame, blocks: DataFrame, open_units: DataFrame, models: DataFrame, cosine: float) -> DataFrame:
    """(rep, n, hub): links found per query, and for each vector with a link the smallest one it is connected with here."""
    chunks = open_units.groupBy(*UNIT).agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("chunks"))
    chunks = settled(chunks, "chunks")
    asked = open_units.join(chunks, UNIT).withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("chunks")).cast("int"))
    asked = asked.select(*UNIT, "chunk", "rep").join(coded.select("rep", "unit"), "rep")
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    books = chunks.select(*UNIT, each).join(models, [*SPACE, "list"])
    asked = asked.unionByName(books.select(*UNIT, "chunk", F.lit(-1).cast("bigint").alias("rep"), F.col("model").alias("unit")))
    held = blocks.select(*UNIT, "rep").join(chunks, UNIT).select(*UNIT, each, "rep").join(coded.select("rep", "copies", "unit", "code", "error"), "rep")
    held = held.toDF(*[f"held_{c}" for c in held.columns])

    def search(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        held.columns = [c.removeprefix("held_") for c in held.columns]
        is_model = (asked["rep"] == -1).to_numpy()
        queries = asked[~is_model]
        if not len(queries) or not len(held):
            return pd.DataFrame({"rep": [], "n": [], "hub": []}).astype("int64")
        centroids, books = _model(asked["unit"][is_model].iloc[0])
        left, right = queries["rep"].to_numpy(np.int64), held["rep"].to_numpy(np.int64)
        codes = np.stack([np.frombuffer(c, dtype=np.uint8) for c in held["code"]])
        copies = held["copies"].to_numpy(np.float64)
        found = np.zeros(len(left))
        pairs = []
        for i, j in compare(_held(queries["unit"]), centroids[0], books, _held(held["unit"]), codes, held["error"].to_numpy(), cosine):
            found += np.bincount(i, weights=copies[j], minlength=len(left))
            pairs.append((i.astype(np.int32), j.astype(np.int32)))
        # A block and its queries bound the pairs that are held until then.
        names = _hubs(left, right, *[np.concatenate(side) for side in zip(*pairs)]) if pairs else (left, right)
        return pd.DataFrame({"rep": np.concatenate([left, right]), "n": np.concatenate([found, np.zeros(len(right))]).astype(np.int64), "hub": np.concatenate(names)})

    sides = asked.groupBy(*UNIT, "chunk"), held.groupBy(*[f"held_{c}" for c in (*UNIT, "chunk")])
    return sides[0].cogroup(sides[1]).applyInPandas(search, "rep bigint, n bigint, hub bigint")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``; one row per row of ``vectors``.

    Vectors link if their labels are equal and their cosine is at least ``cosine``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    ``vec_id`` reachable by links and ``kept`` marks rows whose id that is.

    Rows without label, and vectors that are null, empty, all zero or hold null or non-finite
    values, link with nothing; so do vectors of different lengths. Rows with equal vectors
    are searched once and counted as often as they occur; rows that repeat a ``vec_id`` are
    rows of their own. A null ``vec_id`` names no component unless it has no other id, and is
    not kept. Further columns are left out. Vectors are told apart by 128-bit hashes.

    Centroids and codebooks come from at most :data:`SAMPLE` vectors of each label, those
    with the smallest hashes of their row; every vector is indexed. All links are found: the
    bounds on probes and codes are exact, and lists of any size are searched in blocks.
    """
    ship_package(vectors.sparkSession)
    reach = float(np.sqrt(2 - 2 * cosine))
    v = F.col("embedding").cast("array<double>")
    rows = row_ids(vectors, F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    v = F.col("v")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & sound, F.lit(False))
    keys = [F.xxhash64(F.lit(i), "label", "v").alias(f"k{i}") for i in range(2)]
    keyed = rows.where(usable).select("row_id", "id", *keys)
    groups = settled(keyed.groupBy("k0", "k1").agg(F.min("row_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("low")), "vectors")
    distinct = settled(rows.join(groups, F.col("row_id") == F.col("rep")).select("label", F.size("v").alias("dim"), "rep", "copies", "v"), "distinct")
    # A vector alone in its label has no one to compare with.
    sizes = settled(distinct.groupBy(*SPACE).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    models = settled(_models(distinct, sizes), "models")
    coded = settled(_coded(distinct, sizes, models, reach), "coded")

    # Members of a list in blocks by distance from its centroid: a ring that is wholly in or out of reach needs no look inside.
    listed = ranked(coded.select(*SPACE, "list", "d", "rep", "copies"), [*SPACE, "list"], ["d", "rep"])
    blocks = settled(listed.select(*UNIT[:3], F.floor(F.col("rank") / BLOCK).alias("block"), "d", "rep", "copies"), "members")
    rings = blocks.groupBy(*UNIT).agg(F.min("d").alias("inner"), F.max("d").alias("outer"), F.sum("copies").alias("held"), F.min("rep").alias("hub"))
    probes = coded.select(*SPACE, "rep", F.inline("probes")).join(settled(rings, "rings"), [*SPACE, "list"])
    out_of_reach = (F.col("away") - F.col("outer") > reach + EPS) | (F.col("inner") - F.col("away") > reach + EPS)
    probes = probes.where(~out_of_reach).withColumn("sure", F.col("away") + F.col("outer") <= reach - EPS)
    probes = settled(probes.select(*UNIT, "rep", "sure", "held", "hub"), "probes")
    sure = probes.where("sure")
    found = settled(_searched(coded, blocks, probes.where("NOT sure").select(*UNIT, "rep"), models, cosine), "found")

    counts = sure.select("rep", F.col("held").alias("n")).unionByName(found.select("rep", "n")).groupBy("rep").agg(F.sum("n").alias("n"))
    links = found.select(F.col("rep").alias("a"), F.col("hub").alias("b")).unionByName(sure.select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    ringed = blocks.join(sure.select(*UNIT, F.col("hub").alias("b")).distinct(), UNIT)
    links = links.unionByName(ringed.select(F.col("rep").alias("a"), "b"))
    names = connected_components(links)
    named = groups.join(names, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").join(counts, "rep", "left")
    # Every vector finds itself, except those alone in their label.
    named = named.select("k0", "k1", (F.coalesce("n", "copies") - 1).alias("n_links"), "component_id")
    linked = keyed.join(settled(named, "named"), ["k0", "k1"]).select("id", "n_links", "component_id")
    apart = rows.where(~usable).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(apart).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE
rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
v AS (
  SELECT * FROM rows WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT r AS x, r AS y FROM rows UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
component AS (SELECT x AS r, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.y GROUP BY x),
links AS (SELECT x AS r, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN component USING (r) LEFT JOIN links USING (r)
"""
