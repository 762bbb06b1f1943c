"""Documents whose sets of word n-grams are nearly equal, by a prefix-tree join.

1. Texts become sets of hashed n-grams, in batches of some megabytes. A batch sends the
   n-grams it holds, cut into ranges of hash values, to find out which of them occur in a
   second document; it gets those back. A link needs 85 % of a set in common, so a document
   with more n-grams of its own than the rest has no links and is done here. An n-gram that
   many documents of a batch share is sent once, so frequent ones stay small.
2. Documents with equal sets become one class. The n-grams of classes are put into one
   global order, rare ones first, and sets that share none of the first few n-grams of that
   order cannot link: what these prefixes connect are the clusters within which to look.
3. Each cluster is cut into blocks of similar set size and bounded volume. For a pair of
   blocks, one block's sets form a prefix tree, frequent n-grams at its root. Walking the
   tree carries the overlap with every set of the other block along, so that sets sharing a
   path share its cost; a subtree ends as soon as no overlap can be completed by the lengths
   that remain. Pairs of blocks that already lie in one component are skipped.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, settled
from plumbline.llm.components import connected_components
from plumbline.session import ship_package

WORDS = 4
PERCENT = 85
BATCH_BYTES = 2 << 20
RANGE_BYTES = 8 << 20  # of text, for each range of hash values
BLOCK_SETS, BLOCK_TOKENS = 512, 100_000
TASK_TOKENS = 2_000_000

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """64-bit hashes of words, for all words of a buffer at once."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def words(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each run of bytes that are no white space."""
        starts, hashes, begin = [], [], 0
        data = np.frombuffer(buffer, dtype=np.uint8)
        while begin < len(data):
            end = min(len(data), begin + BATCH_BYTES)
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            s, h = self._piece(data[begin:end])
            starts.append(s + begin)
            hashes.append(h)
            begin = end
        return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= len(data):
            self.up, self.down = _powers(_BASE, len(data) + 1), _powers(_BACK, len(data) + 1)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=sums[1:])
        return starts, _mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(texts: list[str | None], hasher: Hasher, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every n-gram, by document; a shorter text is one n-gram, one without words none."""
    parts = [(t or "").encode() for t in texts]
    lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    starts, hashes = hasher.words(b" ".join(parts))
    doc = np.searchsorted(np.cumsum(lengths), starts, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    grams = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
    for i in range(words):
        grams = _mixed(grams * _BASE + hashes[i : i + len(grams)] + np.uint64(i))
    owner = doc[: len(grams)]
    whole = owner == doc[words - 1 : words - 1 + len(grams)]
    grams, owner = grams[whole], owner[whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        begins = np.concatenate([[0], np.cumsum(counts)])
        alone = np.zeros(len(short), dtype=np.uint64)
        for i in range(words - 1):
            has = counts[short] > i
            at = begins[short[has]] + i
            alone[has] = _mixed(alone[has] * _BASE + hashes[at] + np.uint64(i + 101))
        grams, owner = np.concatenate([grams, _mixed(alone + counts[short].astype(np.uint64))]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    return grams, owner


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for array in arrays.values():
        np.save(out, array)
    return out.getvalue()


def _unpack(blob: bytes, count: int) -> list[np.ndarray]:
    held = io.BytesIO(blob)
    return [np.load(held) for _ in range(count)]


HEADER, ONCE, OFTEN, BACK = 0, 1, 2, 3


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list[str | None], list[str | None]]]:
    rows: list[int] = []
    ids: list[str | None] = []
    texts: list[str | None] = []
    size = 0
    for frame in frames:
        for row, name, text in zip(frame["row_id"], frame["id"], frame["text"]):
            rows.append(row)
            ids.append(name)
            texts.append(text)
            size += len(text) if text else 1
            if size >= BATCH_BYTES or len(rows) >= 60_000:
                yield np.array(rows, dtype=np.int64), ids, texts
                rows, ids, texts, size = [], [], [], 0
    if rows:
        yield np.array(rows, dtype=np.int64), ids, texts


def _send(ranges: int, words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, part = Hasher(), TaskContext.get().partitionId()
        cuts = np.array([(2**64 * i) // ranges for i in range(1, ranges)], dtype=np.uint64)
        for number, (rows, ids, texts) in enumerate(_batches(frames)):
            batch = (part << 32) | number
            grams, owner = gram_hashes(texts, hasher, words)
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order].astype(np.uint16)
            fresh = np.ones(len(grams), dtype=bool)
            fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            grams, owner = grams[fresh], owner[fresh]
            sizes = np.bincount(owner, minlength=len(rows)).astype(np.int64)
            new = np.ones(len(grams), dtype=bool)
            new[1:] = grams[1:] != grams[:-1]
            alone = new & np.append(new[1:], True)
            out = [(HEADER, batch % ranges, batch, _pack(rows=rows, sizes=sizes, ids=np.frombuffer(json.dumps(ids).encode(), np.uint8)))]
            if not alone.all():
                out.append((OFTEN, batch % ranges, batch, _pack(grams=grams[~alone], owner=owner[~alone])))
            first = grams[new]
            for i, (a, b) in enumerate(zip(np.append(0, np.searchsorted(first, cuts)), np.append(np.searchsorted(first, cuts), len(first)))):
                if a < b:
                    places = np.flatnonzero(new)[a:b]
                    single = alone[places]
                    out.append((ONCE, i, batch, _pack(grams=first[a:b][single], owner=owner[places][single], often=first[a:b][~single])))
            yield pd.DataFrame(out, columns=["kind", "part", "batch", "payload"])

    return run


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Sends each batch of a range those n-grams it has once and another batch has as well."""
    passed = group[group["kind"] != ONCE]
    own = group[group["kind"] == ONCE]
    held = [_unpack(p, 3) for p in own["payload"]]
    every = np.sort(np.concatenate([x for grams, _, often in held for x in (grams, often)] or [np.zeros(0, np.uint64)]))
    shared = every[1:][every[1:] == every[:-1]]
    shared = shared[np.append(True, shared[1:] != shared[:-1])] if len(shared) else shared
    # N-grams that a batch has often are shared, too, wherever they meet a single one: they are in `every` twice then.
    out = []
    for batch, (grams, owner, _) in zip(own["batch"], held):
        at = np.searchsorted(shared, grams)
        known = np.zeros(len(grams), dtype=bool)
        inside = at < len(shared)
        known[inside] = shared[at[inside]] == grams[inside]
        if known.any():
            out.append((BACK, int(batch), _pack(grams=grams[known], owner=owner[known])))
    back = pd.DataFrame(out, columns=["kind", "batch", "payload"])
    return pd.concat([passed[["kind", "batch", "payload"]], back]).astype({"kind": "int32", "batch": "int64"})


def _collect(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows, sizes, ids = _unpack(group.loc[group["kind"] == HEADER, "payload"].iloc[0], 3)
        found = [_unpack(p, 2) for p in group.loc[group["kind"] != HEADER, "payload"]]
        grams = np.concatenate([g for g, _ in found] or [np.zeros(0, np.uint64)])
        owner = np.concatenate([o for _, o in found] or [np.zeros(0, np.uint16)]).astype(np.int64)
        shared = np.bincount(owner, minlength=len(rows))
        enough = (sizes > 0) & (100 * shared >= percent * sizes)
        wanted = enough[owner]
        grams, owner = grams[wanted], owner[wanted]
        order = np.lexsort((grams, owner))
        grams, owner = grams[order].view(np.int64), owner[order]
        ends = np.cumsum(np.bincount(owner, minlength=len(rows)))
        sets = [grams[e - s : e] if ok else None for e, s, ok in zip(ends, np.diff(ends, prepend=0), enough)]
        return pd.DataFrame({"row_id": rows, "id": json.loads(ids.tobytes()), "size": sizes, "grams": sets})

    return run


def gram_sets(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(row_id, id, size, grams) of ``rows`` (row_id, id, text): set size, and the n-grams that others share.

    ``grams`` is null where too few are shared for any link. The ids travel with the sets,
    as text, so that each row_id is read from ``rows`` in one scan only.
    """
    ship_package(rows.sparkSession)
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-volume // RANGE_BYTES))
    sent = rows.select("row_id", F.col("id").cast("string").alias("id"), "text").mapInPandas(_send(ranges, words), "kind int, part int, batch bigint, payload binary")
    met = sent.groupBy("part").applyInPandas(_meet, "kind int, batch bigint, payload binary")
    sets = met.groupBy("batch").applyInPandas(_collect(percent), "row_id bigint, id string, size bigint, grams array<bigint>")
    return sets.withColumn("id", F.col("id").cast(rows.schema["id"].dataType))


def tree_links(left: list[np.ndarray], left_sizes: np.ndarray, right: list[np.ndarray], right_sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of linked sets, walking a prefix tree of ``left`` with all of ``right`` at once.

    Sets are ascending arrays of numbers that stand for n-grams in one order for both sides.
    """
    tokens = np.unique(np.concatenate(right)) if right else np.zeros(0, np.int64)
    present = np.zeros((len(tokens), len(right)), dtype=np.uint8)
    for j, numbers in enumerate(right):
        present[np.searchsorted(tokens, numbers), j] = 1
    # Sorted paths visit the tree depth first; n-grams that no set on the right has cannot count.
    paths = []
    for i, numbers in enumerate(left):
        at = np.searchsorted(tokens, numbers)
        inside = at < len(tokens)
        inside[inside] = tokens[at[inside]] == numbers[inside]
        paths.append((at[inside].tolist(), i))
    paths.sort()
    common = [0] * len(paths)
    for k in range(1, len(paths)):
        for x, y in zip(paths[k - 1][0], paths[k][0]):
            if x != y:
                break
            common[k] += 1
    depth = max((len(p) for p, _ in paths), default=0)
    stack = np.zeros((depth + 1, len(right)), dtype=np.int32)  # overlaps along the current path

    def descend(path: list[int], built: int) -> int:
        stop = min(len(path), built + 32)
        np.cumsum(present[path[built:stop]], axis=0, dtype=np.int32, out=stack[built + 1 : stop + 1])
        stack[built + 1 : stop + 1] += stack[built]
        return stop

    dead = depth + 1  # depth of the node below which nothing can link
    for k, (path, i) in enumerate(paths):
        built = common[k]
        if dead <= built:
            continue
        dead = depth + 1
        need = np.ceil(percent * (left_sizes[i] + right_sizes) / (100 + percent) - 1e-9).astype(np.int64)
        while built < len(path):
            built = descend(path, built)
            if built < len(path) and not (stack[built] + (len(path) - built) >= need).any():
                # The bound holds for the subtree if none of its later sets is longer or smaller.
                later = k + 1
                while later < len(paths) and common[later] >= built and len(paths[later][0]) <= len(path) and left_sizes[paths[later][1]] >= left_sizes[i]:
                    later += 1
                if later == len(paths) or common[later] < built:
                    dead = built
                    break
        if dead <= depth:
            continue
        overlap = stack[len(path)].astype(np.int64)
        for j in np.flatnonzero(100 * overlap >= percent * (left_sizes[i] + right_sizes - overlap)):
            yield i, int(j)


def _numbered(sides: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """The sets with n-grams numbered by how many of these sets hold them, frequent ones first."""
    every = [x for side in sides for x in side]
    grams, at, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    number = np.empty(len(grams), dtype=np.int64)
    number[np.lexsort((grams, -counts))] = np.arange(len(grams))
    cuts = np.cumsum([len(x) for x in every])[:-1]
    numbered = [np.sort(x) for x in np.split(number[at], cuts)]
    return [numbered[: len(sides[0])], numbered[len(sides[0]) :]]


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _link_blocks(percent: int):
    """Links of pairs of blocks, as many as it takes to connect what is linked."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, pair in group.groupby("pair", sort=True):
            left, right = pair[pair["side"] == 0], pair[pair["side"] == 1]
            same = not len(right)
            right = left if same else right
            sets = _numbered([[np.asarray(x, dtype=np.int64) for x in part["grams"]] for part in ([left] if same else [left, right])] + ([[]] if same else []))
            sets[1] = sets[0] if same else sets[1]
            sizes = [part["size"].to_numpy(np.int64) for part in (left, right)]
            ids = [part["rep"].to_numpy(np.int64) for part in (left, right)]
            union = _Union(len(left) + (0 if same else len(right)))
            offset = 0 if same else len(left)
            for i, j in tree_links(sets[0], sizes[0], sets[1], sizes[1], percent):
                if (not same or i != j) and union.join(i, offset + j):
                    out.append((int(ids[0][i]), int(ids[1][j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _block_links(members: DataFrame, pairs: DataFrame, tasks: int, percent: int) -> DataFrame:
    """``pairs`` has (pair, cluster, c1, s1, c2, s2); ``members`` has (cluster, class, sub, rep, size, grams)."""
    side = lambda n, c, s: pairs.select("pair", "cluster", F.col(c).alias("class"), F.col(s).alias("sub"), F.lit(n).alias("side"))
    sides = side(0, "c1", "s1").unionByName(side(1, "c2", "s2").join(pairs.where("c1 = c2 AND s1 = s2").select("pair"), "pair", "left_anti"))
    filled = members.join(sides, ["cluster", "class", "sub"]).withColumn("task", F.pmod(F.xxhash64("pair"), F.lit(tasks)))
    return filled.select("task", "pair", "side", "rep", "size", "grams").groupBy("task").applyInPandas(_link_blocks(percent), "a bigint, b bigint")


def link_classes(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of all classes with a link; ``classes`` has (rep, size, grams)."""
    entries = classes.select("rep", "size", F.explode("grams").alias("gram"))
    spread = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ordered = entries.join(spread, "gram").groupBy("rep", "size").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("order"))
    own = F.col("size") - F.size("order")
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - own
    ordered = settled(ordered.where(F.size("order") * 100 >= F.col("size") * percent).withColumn("prefix", F.greatest(prefix, F.lit(1)).cast("int")), "ordered")

    # What the prefixes connect: each n-gram ties its sets to the smallest of them.
    near = ordered.select("rep", F.explode(F.slice("order", 1, F.col("prefix"))).alias("o")).select("rep", "o.gram")
    hubs = near.groupBy("gram").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    clusters = connected_components(near.join(hubs, "gram").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct())

    # Sets link only within a class of sizes or with the next one.
    size_class = F.floor(F.log(F.col("size").cast("double")) / -float(np.log(percent / 100)) + 1e-9).cast("int")
    members = ordered.join(clusters, F.col("rep") == F.col("node")).select(
        F.col("component").alias("cluster"), size_class.alias("class"), "rep", "size", "order",
    )
    volume = members.groupBy("cluster", "class").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum(F.size("order")) / BLOCK_TOKENS)).cast("int").alias("subs"), F.sum(F.size("order")).alias("tokens")
    )
    volume = settled(volume, "volume")
    members = settled(
        members.join(volume.drop("tokens"), ["cluster", "class"]).select("cluster", "class", F.pmod(F.xxhash64("rep"), F.col("subs")).cast("int").alias("sub"), "rep", "size", F.col("order.gram").alias("grams")),
        "members",
    )
    tasks = max(1, int((volume.agg(F.sum("tokens")).first()[0] or 0) // TASK_TOKENS) + 1)
    tasks = max(tasks, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    one = volume.select("cluster", F.col("class").alias("c1"), F.col("subs").alias("n1"))
    two = volume.select("cluster", F.col("class").alias("c2"), F.col("subs").alias("n2"))
    pairs = one.join(two, "cluster").where("c2 - c1 BETWEEN 0 AND 1")
    pairs = pairs.select("*", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)).alias("s1")).select("*", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)).alias("s2"))
    pairs = pairs.where("c1 < c2 OR s1 <= s2").select(F.xxhash64("cluster", "c1", "s1", "c2", "s2").alias("pair"), "cluster", "c1", "s1", "c2", "s2")
    pairs = settled(pairs, "pairs")
    # First each block by itself and with the first block of its class, which connects most of a cluster.
    first = F.expr("(c1 = c2 AND s1 = s2) OR s1 = 0 OR s2 = 0")
    links = settled(_block_links(members, pairs.where(first), tasks, percent), "links-1")
    rest = settled(pairs.where(~first), "rest")
    if rest.isEmpty():
        return connected_components(links)
    names = connected_components(links)
    named = members.join(names, F.col("rep") == F.col("node"), "left").withColumn("c", F.coalesce("component", "rep"))
    blocks = settled(named.groupBy("cluster", "class", "sub").agg(F.min("c").alias("low"), F.max("c").alias("high")), "blocks")
    side = lambda i: blocks.select("cluster", F.col("class").alias(f"c{i}"), F.col("sub").alias(f"s{i}"), F.col("low").alias(f"low{i}"), F.col("high").alias(f"high{i}"))
    open_pairs = rest.join(side(1), ["cluster", "c1", "s1"]).join(side(2), ["cluster", "c2", "s2"])
    open_pairs = settled(open_pairs.where("NOT (low1 = high1 AND low2 = high2 AND low1 = low2)").select(*pairs.columns), "open-pairs")
    if open_pairs.isEmpty():
        return names
    return connected_components(links.unionByName(_block_links(members, open_pairs, tasks, percent)))


def near_duplicates(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(row_id, id, size, component_id, first) of ``rows`` (row_id, id, text).

    ``component_id`` is the smallest ``id`` of the rows linked to a row, directly or through
    others; ``first`` marks one row of each component, the one with that id and the smallest
    row_id. Rows without a word have size 0 and stand alone.
    """
    sets = settled(gram_sets(rows, words, percent), "sets")
    candidates = sets.where("grams is not null")
    # Equal sets, all of whose n-grams are shared, are one class.
    whole = F.size("grams") == F.col("size")
    marks = [F.when(whole, F.xxhash64(F.lit(i), F.col("grams"))).otherwise(F.xxhash64(F.lit(i + 2), F.col("row_id"))).alias(f"k{i}") for i in range(2)]
    keyed = settled(candidates.select("row_id", "id", "size", *marks, "grams"), "candidates")
    key = ["k0", "k1"]
    reps = keyed.groupBy(*key).agg(F.min("row_id").alias("rep"))
    classes = settled(keyed.join(reps.select("rep"), F.col("row_id") == F.col("rep")).select("rep", "size", "grams"), "classes")
    names = link_classes(classes, percent)
    named = reps.join(names, F.col("rep") == F.col("node"), "left").select(*key, F.coalesce("component", "rep").alias("component"))
    members = keyed.select("row_id", "id", "size", *key).join(named, key).select("row_id", "id", "size", "component")
    smallest = members.groupBy("component").agg(F.min("id").alias("component_id"), F.min_by("row_id", F.struct(F.col("id").isNull(), "id", "row_id")).alias("kept"))
    linked = members.join(smallest, "component").select("row_id", "id", "size", "component_id", (F.col("row_id") == F.col("kept")).alias("first"))
    alone = sets.where("grams is null").select("row_id", "id", "size", F.col("id").alias("component_id"), F.lit(True).alias("first"))
    return linked.unionByName(alone)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, one row per row of ``docs``.

    Texts are lower-cased from A to Z and cut at white space; a set holds a text's distinct
    runs of ``words`` words, or its whole sequence if it is shorter. Two rows link when
    100 times the intersection is at least ``percent`` times the union. Null and empty texts
    have no set and link with nothing. A null ``doc_id`` never names a component that has
    another id; rows that repeat a ``doc_id`` are rows of their own. N-grams are compared by
    64-bit hashes.
    """
    rows = numbered(docs, F.col("doc_id").alias("id"), F.col("text"))
    found = near_duplicates(rows, words, percent)
    return found.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id")
