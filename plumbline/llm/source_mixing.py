"""Mixing a corpus to target weights over a tree of domain, language and source.

The token budget flows down the tree by weight. A node that cannot use its share (its
documents, read ``max_epochs`` times, have fewer tokens) is filled up, and what it leaves
goes to its siblings by weight; since a node's capacity is that of its subtree, only what
a whole family cannot use reaches the siblings of the parent. Each leaf then takes whole
epochs of its documents and a prefix of one more epoch, in a seeded order.

All arithmetic is on integers, so results depend neither on task order nor on engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import settled, small

LEVELS = ("m_domain", "m_lang", "m_source")
# Hex digits of a document's hash that choose its slice of an epoch: 4,096 slices.
DIGITS = 3

# Production weights; names not listed weigh 1.
WEIGHTS = {
    "m_domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "m_lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "m_source": {},
}


def token_count(text: Column) -> Column:
    """Tokens of a text by size: one for every four bytes of UTF-8, rounded up; 0 for null."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("bigint")


def domain_of(source: Column) -> Column:
    """The domain of a source: its trailing number modulo 4, or ``other``."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})\z", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.try_cast("int") % 4).cast("string"))).otherwise(F.lit("other"))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    chosen = F.lit(1)
    for name, weight in weights.get(level, {}).items():
        if int(weight) != weight or weight < 1:
            raise ValueError(f"weights are whole numbers from 1, not {weight} for {name}")
        chosen = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(chosen)
    return chosen.cast("bigint")


def _fill(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to rows of (parents, name, weight, capacity, parent_budget)."""
    own, cap, given = F.col("weight"), F.col("capacity"), F.col("parent_budget")
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy(cap / own, name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    filled = children.select(
        "*",
        F.coalesce(F.sum("capacity").over(before), zero).alias("c_before"),
        (F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), zero)).alias("w_from"),
    )
    filled = filled.withColumn("full", F.col("c_before") * own + cap * F.col("w_from") <= given * own)
    taken = F.coalesce(F.sum(F.when(F.col("full"), cap)).over(family), zero)
    sharing = F.sum(F.when(~F.col("full"), own)).over(family)
    filled = filled.select("*", taken.alias("taken"), sharing.alias("sharing"))
    return filled.select(*children.columns, F.expr("CASE WHEN `full` THEN capacity ELSE (parent_budget - taken) * weight div sharing END").alias("budget"))


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], tenths: int, max_epochs: int) -> DataFrame:
    """(levels, leaf_tokens, budget) from (levels, leaf_tokens), top down. One row per leaf throughout."""
    nodes = leaves.withColumn("capacity", F.col("leaf_tokens") * max_epochs)
    everything = Window.partitionBy(F.lit(0))
    level = nodes.groupBy("m_domain").agg(F.sum("capacity").alias("capacity"), F.sum("leaf_tokens").alias("own_tokens"))
    level = level.withColumn("all_tokens", F.sum("own_tokens").over(everything))
    level = level.select("m_domain", "capacity", F.least(F.expr(f"all_tokens * {int(tenths)} div 10"), F.col("all_tokens") * max_epochs).alias("parent_budget"))
    parents: list[str] = []
    for depth, name in enumerate(LEVELS):
        if depth:
            keys = list(LEVELS[: depth + 1])
            below = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
            level = below.join(level.select(*parents, F.col("budget").alias("parent_budget")), parents)
        level = _fill(level.withColumn("weight", _weight(name, weights)), parents, name)
        parents = [*parents, name]
    return nodes.join(level.select(*LEVELS, "budget"), list(LEVELS)).select(*LEVELS, "leaf_tokens", "budget")


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    tenths: int = 8,
    max_epochs: int = 2,
    seed: int = 17,
    keep: tuple[str, ...] = ("doc_id", "lang", "source"),
) -> DataFrame:
    """Selected documents: columns ``keep``, ``domain``, ``tokens`` and ``epoch`` (from 0).

    The budget is ``tenths`` tenths of all tokens. A document chosen in two epochs gives
    two rows. Null languages and sources form leaves of their own (shown as null), null
    texts and empty ones have no tokens and are never chosen. Order within an epoch is by
    ``md5(seed:epoch:doc_id)``, then ``doc_id``, then the text's md5; equal rows are
    interchangeable. The last document of a prefix ends within the budget. Columns of
    ``docs`` that are not in ``keep`` are left out, whatever their names.
    """
    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = docs.select(
        *hidden,
        F.col("doc_id").alias("m_id"),
        domain_of(F.col("source")).alias("m_domain"),
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("m_lang"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("m_source"),
        token_count(F.col("text")).alias("m_tokens"),
        F.col("text").alias("m_text"),
    ).where("m_tokens > 0")
    marked = {level: {name if level == "m_domain" else f"={name}": w for name, w in names.items()} for level, names in weights.items()}
    levels = list(LEVELS)
    leaves = settled(rows.groupBy(*levels).agg(F.sum("m_tokens").alias("leaf_tokens")), "mix-leaves")
    plan = leaf_budgets(leaves, marked, tenths, max_epochs)
    plan = settled(
        plan.select(*levels, F.expr("budget div leaf_tokens").alias("whole"), F.expr("budget % leaf_tokens").alias("rest")),
        "mix-plan",
    )
    ordered = rows.join(small(plan), levels).withColumn("m_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("m_id").cast("string"), F.lit("null")))))
    ordered = ordered.withColumn("slice", F.conv(F.substring("m_hash", 1, DIGITS), 16, 10).cast("int"))

    # Tokens per slice show where each leaf's prefix ends; only that slice is sorted.
    sizes = ordered.where("rest > 0").groupBy(*levels, "rest", "slice").agg(F.sum("m_tokens").alias("size"))
    upto = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.select("*", F.sum("size").over(upto).alias("upto")).where("upto > rest")
    cuts = settled(sizes.groupBy(*levels).agg(F.min("slice").alias("cut"), F.min_by(F.col("upto") - F.col("size"), "slice").alias("ahead")), "mix-cuts")
    ordered = ordered.join(small(cuts), levels, "left")
    ordered = ordered.withColumn("inside", (F.col("rest") > 0) & (F.col("slice") < F.coalesce("cut", F.lit(16**DIGITS))))

    shown = [*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], F.col("m_domain").alias("domain"), F.col("m_tokens").alias("tokens")]
    epochs = F.col("whole") + F.col("inside").cast("bigint")
    times = F.when(epochs > 0, F.sequence(F.lit(0).cast("bigint"), epochs - 1)).otherwise(F.array().cast("array<bigint>"))
    chosen = ordered.select(*shown, F.explode(times.cast("array<int>")).alias("epoch"))
    edge = ordered.where((F.col("rest") > 0) & (F.col("slice") == F.col("cut")))
    by_hash = Window.partitionBy(*levels).orderBy("m_hash", "m_id", F.md5("m_text")).rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("upto", F.col("ahead") + F.sum("m_tokens").over(by_hash)).where("upto <= rest")
    return chosen.unionByName(edge.select(*shown, F.col("whole").cast("int").alias("epoch")))


def oracle(weights: Mapping[str, Mapping[str, int]] = WEIGHTS, tenths: int = 8, max_epochs: int = 2, seed: int = 17, shown: str = "doc_id, domain, lang, source, tokens, epoch", table: str = "documents") -> str:
    """The same rows by SQL: every leaf's whole order is sorted, and each level is one CTE."""

    def weight(level: str, column: str) -> str:
        cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in weights.get(level, {}).items())
        return f"(CASE {column} {cases} ELSE 1 END)::BIGINT" if cases else "1::BIGINT"

    def level(name: str, depth: int, source: str) -> str:
        keys = ["domain", "lang", "source"][: depth + 1]
        family = ", ".join(keys[:-1]) or "1"
        own = keys[-1]
        return f"""
{name}_a AS ({source}),
{name}_b AS (SELECT *, {weight(LEVELS[depth], own)} AS weight FROM {name}_a),
{name}_c AS (SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {family} ORDER BY capacity / weight, '=' || {own} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS c_before,
  (sum(weight) OVER (PARTITION BY {family}) - coalesce(sum(weight) OVER (PARTITION BY {family} ORDER BY capacity / weight, '=' || {own} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS w_from FROM {name}_b),
{name}_d AS (SELECT *, c_before * weight + capacity * w_from <= parent_budget * weight AS filled FROM {name}_c),
{name} AS (SELECT {", ".join(keys)}, CASE WHEN filled THEN capacity ELSE (parent_budget - coalesce(sum(CASE WHEN filled THEN capacity END) OVER (PARTITION BY {family}), 0)::HUGEINT) * weight // (sum(CASE WHEN NOT filled THEN weight END) OVER (PARTITION BY {family}))::HUGEINT END AS budget FROM {name}_d)"""

    same = lambda a, b, keys: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)
    first = f"SELECT domain, sum(tokens)::HUGEINT * {max_epochs} AS capacity, (SELECT least(sum(tokens) * {tenths} // 10, sum(tokens) * {max_epochs}) FROM d)::HUGEINT AS parent_budget FROM d GROUP BY domain"
    second = f"SELECT d.domain, d.lang, sum(d.tokens)::HUGEINT * {max_epochs} AS capacity, any_value(p.budget) AS parent_budget FROM d JOIN l1 p ON {same('d', 'p', ['domain'])} GROUP BY d.domain, d.lang"
    third = f"SELECT d.domain, d.lang, d.source, sum(d.tokens)::HUGEINT * {max_epochs} AS capacity, any_value(p.budget) AS parent_budget FROM d JOIN l2 p ON {same('d', 'p', ['domain', 'lang'])} GROUP BY d.domain, d.lang, d.source"
    return rf"""
WITH d AS (
  SELECT *, CASE WHEN regexp_matches(coalesce(source, ''), '[0-9]{{1,9}}\z') THEN 'domain' || (regexp_extract(source, '([0-9]{{1,9}})\z', 1)::INT % 4) ELSE 'other' END AS domain,
    ((strlen(text) + 3) // 4)::BIGINT AS tokens
  FROM {table} WHERE strlen(text) > 0),
{level("l1", 0, first)},{level("l2", 1, second)},{level("l3", 2, third)},
sums AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS leaf_tokens FROM d GROUP BY ALL),
p AS (SELECT s.*, l3.budget // s.leaf_tokens AS whole, l3.budget % s.leaf_tokens AS rest FROM sums s JOIN l3 ON {same("s", "l3", ["domain", "lang", "source"])}),
o AS (SELECT d.*, p.whole, p.rest, md5('{seed}:' || p.whole || ':' || coalesce(d.doc_id::VARCHAR, 'null')) AS h FROM d JOIN p ON {same("d", "p", ["domain", "lang", "source"])}),
q AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id NULLS FIRST, md5(text) ROWS UNBOUNDED PRECEDING) <= rest AS inside FROM o),
e AS (SELECT *, unnest(range(0, (whole + inside::INT)::BIGINT))::INT AS epoch FROM q)
SELECT {shown} FROM e
"""
