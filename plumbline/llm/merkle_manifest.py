"""A Merkle manifest of a dataset: a tree per language, a tree over the languages, and a proof per document.

The rank of a leaf is written in digits of base :data:`ARITY`. Leaves are dealt once into
blocks of consecutive ranks; within a block, each grouping takes the lowest digit away and
nests the structs of a run into their parent's. The blocks' hashes are the leaves of the
next, far smaller pass. On the way back each block gets the path above it, and one
transform and explode of its nested struct hands every leaf its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import crc32_sql, ranked, settled

ARITY = 8
BITS = 3  # of a digit
# Digits that are grouped away in one pass: a block holds 8 ** 3 leaves.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<position: int, run: array<string>>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**replaced: Column) -> Column:
    """Hash of a document's five fields with their lengths; ``replaced`` names fields to take from elsewhere."""
    return F.sha2(F.concat(*[_field(replaced.get(name, F.col(name))) for name in FIELDS]), 256)


def _joined(hashes: Column) -> Column:
    return F.sha2(F.array_join(hashes, ""), 256)


def _width(level: int) -> Column:
    """How many nodes a tree of ``size`` leaves has at a level, at least 1."""
    return F.shiftright(F.col("size") + ((1 << BITS * level) - 1), BITS * level)


def _passes(nodes: DataFrame) -> list[DataFrame]:
    """Blocks (tree, block, size, hash, kids) of each pass, from the leaves up; the last has one block a tree.

    ``nodes`` are (tree, rank, size, hash, held); ``held`` stays with the leaves.
    """
    passes = []
    while True:
        digit = [F.shiftright("rank", BITS * i).bitwiseAND(ARITY - 1).cast("int") for i in range(LEVELS)]
        rows = nodes.select(
            "tree", "size", F.shiftright("rank", BITS * LEVELS).alias("block"), *[d.alias(f"digit{i}") for i, d in enumerate(digit)],
            F.struct(digit[0].alias("position"), "hash", "held").alias("node"),
        )
        rows = rows.repartition("tree", "size", "block")
        for level in range(LEVELS):
            left = [f"digit{i}" for i in range(level + 1, LEVELS)]
            rows = rows.groupBy("tree", "size", "block", *left).agg(F.sort_array(F.collect_list("node")).alias("kids"))
            # A tree that is down to one node at this level has its root already.
            above = F.when(_width(level) > 1, _joined(F.col("kids.hash"))).otherwise(F.col("kids")[0]["hash"])
            rows = rows.withColumn("hash", above)
            if left:
                rows = rows.select("tree", "size", "block", *left, F.struct(F.col(left[0]).alias("position"), "hash", "kids").alias("node"))
        passes.append(settled(rows, "merkle-blocks"))
        if (passes[-1].agg(F.max("block")).first()[0] or 0) == 0:
            return passes
        nodes = passes[-1].select("tree", F.col("block").alias("rank"), _width(LEVELS).alias("size"), "hash", F.lit(None).cast("string").alias("held"))


def _unfolded(kids: Column, level: int, path: Column) -> Column:
    """The leaves below ``kids`` as (position in the block, node, path), paths from the leaf up."""
    run = F.transform(kids, lambda x: x["hash"])

    def longer(i: Column) -> Column:
        step = F.array(F.struct(i.cast("int").alias("position"), run.alias("run")))
        return F.when(_width(level) > 1, F.concat(step, path)).otherwise(path)

    if level == 0:
        return F.transform(kids, lambda x, i: F.struct(x["hash"].alias("hash"), x["held"].alias("held"), longer(i).alias("path")))
    return F.flatten(F.transform(kids, lambda x, i: _unfolded(x["kids"], level - 1, longer(i))))


def _paths(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, rank, hash, held, path, subroot, root) of all leaves; ``above`` has what lies over each tree's root.

    A block meets the one row above it by grouping, not by a join.
    """
    for blocks in reversed(passes):
        kids = blocks.schema["kids"].dataType
        both = blocks.select("tree", "block", "size", "kids", F.lit(None).cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
        both = both.unionByName(above.select("tree", "block", F.lit(None).cast("bigint").alias("size"), F.lit(None).cast(kids).alias("kids"), "path", "subroot", "root"))
        met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("size", "kids", "path", "subroot", "root")])
        leaves = met.select("tree", "block", "subroot", "root", F.posexplode(_unfolded(F.col("kids"), LEVELS - 1, F.col("path"))).alias("place", "leaf"))
        # All runs but a tree's last are full, so the place in the block gives the rank.
        rank = F.shiftleft("block", BITS * LEVELS) + F.col("place")
        leaves = leaves.select("tree", rank.alias("rank"), "leaf.*", "subroot", "root")
        above = leaves.select("tree", F.col("rank").alias("block"), "path", "subroot", "root")
    return leaves


def fold(hash: Column, path: Column) -> Column:
    """The root that ``hash`` and the siblings on ``path`` give."""
    def up(below: Column, step: Column) -> Column:
        left = F.slice(step["run"], F.lit(1), step["position"])
        right = F.slice(step["run"], step["position"] + 2, F.greatest(F.size(step["run"]) - step["position"] - 1, F.lit(0)))
        return _joined(F.concat(left, F.array(below), right))

    return F.aggregate(path, hash, up)


def siblings(path: Column) -> Column:
    """All sibling hashes along ``path``, level by level, each from left to right."""
    return F.flatten(F.transform(path, lambda step: F.filter(step["run"], lambda h, i: i != step["position"])))


def manifest(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """Per document ``doc_id``, ``lang``, ``leaf``, ``subroot``, ``root``, ``path`` and ``claimed``.

    ``path`` holds, from the leaf up, its position in each run of up to :data:`ARITY` nodes
    and the run's hashes; :func:`fold` and :func:`siblings` read it. ``claimed`` is an
    expression over ``docs``, such as the hash of a copy to be verified, that is carried
    along; it is null by default.

    Leaves of a language ascend by ``doc_id``, null first, then by their hash, so that equal
    ids have a defined order; rows that are wholly equal have equal hashes and any order of
    them gives the same trees. Documents without language are a tree of their own, before all
    others; an empty language is another. Null fields differ from empty ones. An empty
    table gives an empty result. Further columns take no part. A text is hashed whole in
    the task that reads it and never shuffled.
    """
    # Null sorts before every language, among them the empty one.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    leaves = settled(docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_hash().alias("hash"), claimed.alias("claimed")), "leaves")
    leaves = ranked(leaves, ["tree"], ["doc_id", "hash"])
    passes = _passes(leaves.select("tree", "rank", "size", "hash", F.struct("doc_id", "claimed").alias("held")))
    subroots = passes[-1].select(F.lit(0).alias("all"), F.col("tree").alias("held"), "hash")
    top = _passes(ranked(subroots, ["all"], ["held"]).select(F.lit("").alias("tree"), "rank", "size", "hash", "held"))
    summit = top[-1].select("tree", "block", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    over = _paths(top, summit).select(F.col("held").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path", F.col("hash").alias("subroot"), "root")
    found = _paths(passes, over)
    lang = F.when(F.col("tree") != "", F.substring("tree", 2, 2147483647))
    return found.select("held.doc_id", lang.alias("lang"), F.col("hash").alias("leaf"), "subroot", "root", "path", "held.claimed")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest's digests, folded again where every third document had its text lower-cased after signing.

    ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all siblings on the
    path), ``folded_root``, ``verified``. A null ``doc_id`` or text is not changed.
    """
    changed = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 3 == 0
    found = manifest(docs, F.when(changed, leaf_hash(text=lower_ascii(F.col("text")))))
    folded = found.select("*", fold(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", _joined(siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE = """
WITH RECURSIVE
d AS (
  SELECT doc_id, lang, {crc32} % 3 = 0 AS changed,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
h AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN changed THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS claimed FROM d),
leaves AS (
  SELECT *, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM h),
node AS (
  SELECT tree, 0 AS lvl, pos, leaf AS hash, n FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY tree, lvl, pos // 8, n),
subroots AS (SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, hash, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n),
root AS (SELECT hash AS root FROM top WHERE n = 1),
-- Every leaf's way up: the nodes of each run it passes, and which of them is its own.
lang_way AS (
  SELECT l.tree, l.pos AS leaf_pos, k.lvl, k.pos, k.hash, k.pos = l.pos >> (3 * k.lvl)::INT AS own
  FROM leaves l JOIN node k ON k.tree = l.tree AND k.n > 1 AND k.pos // 8 = l.pos >> (3 * k.lvl + 3)::INT),
top_way AS (
  SELECT s.tree, k.lvl + 100 AS lvl, k.pos, k.hash, k.pos = s.pos >> (3 * k.lvl)::INT AS own
  FROM subroots s JOIN top k ON k.n > 1 AND k.pos // 8 = s.pos >> (3 * k.lvl + 3)::INT),
way AS (
  SELECT * FROM lang_way UNION ALL
  SELECT l.tree, l.pos, w.lvl, w.pos, w.hash, w.own FROM leaves l JOIN top_way w ON w.tree = l.tree),
steps AS (
  SELECT tree, leaf_pos, lvl, dense_rank() OVER (PARTITION BY tree, leaf_pos ORDER BY lvl) AS step, pos, hash, own FROM way),
proofs AS (SELECT tree, leaf_pos, string_agg(hash, '' ORDER BY step, pos) AS siblings FROM steps WHERE NOT own GROUP BY tree, leaf_pos),
folded AS (
  SELECT tree, pos AS leaf_pos, 0::BIGINT AS step, coalesce(claimed, leaf) AS hash FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_pos, f.step + 1, sha256(string_agg(CASE WHEN s.own THEN f.hash ELSE s.hash END, '' ORDER BY s.pos))
  FROM folded f JOIN steps s ON s.tree = f.tree AND s.leaf_pos = f.leaf_pos AND s.step = f.step + 1 GROUP BY f.tree, f.leaf_pos, f.step),
ends AS (SELECT tree, leaf_pos, arg_max(hash, step) AS folded_root FROM folded GROUP BY tree, leaf_pos)
SELECT l.doc_id, l.leaf, s.hash AS subroot, root, sha256(coalesce(p.siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree CROSS JOIN root
JOIN ends e ON e.tree = l.tree AND e.leaf_pos = l.pos LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_pos = l.pos
"""


def oracle() -> str:
    return ORACLE.format(crc32=crc32_sql("doc_id"))
