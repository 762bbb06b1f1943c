"""Toxicity by a linear classifier that is held to the same score when identity terms are swapped.

Every labelled text that names a group gets a twin in which the group is another one. The
loss adds to the log loss a penalty on the squared difference between the scores of a text
and its twin, so weight cannot settle on the mere mention of a group.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settled, small
from plumbline.llm.language_id import held_out, words_of
from plumbline.session import ship_package

# Bounds of training: labelled documents of each class, and features held by the model.
DOCS_PER_CLASS, FEATURES = 6000, 4096
LEAST_DOCS = 5
PREFIXES = (4, 5, 6, 7)
LEVELS = (1, 2, 3, 5)
# Swaps within these groups; each word becomes the next one of its group. Fixed values.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists"), ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("gay", "straight", "lesbian"), ("black", "white", "asian"), ("immigrants", "natives"), ("turks", "poles", "greeks"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
SWAPS = {word: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, word in enumerate(group)}
STEPS, RIDGE, FAIRNESS = 30, 0.3, 4.0
PARTS = 8


def _parts(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) > n]]


def _present(words: Mapping[str, int]) -> set[str]:
    """Features of a text from its words' counts: each word and word beginning, by how often it occurs at least."""
    totals: Counter = Counter()
    for word, n in words.items():
        for part in _parts(word):
            totals[part] += n
    return {f"{part}#{level}" for part, n in totals.items() for level in LEVELS if n >= level}


def labelled_sample(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """(text, toxic) of about ``docs_per_class`` labelled documents of each class that are not held out."""
    known = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(0)
    for toxic, size in sizes.items():
        share = F.when(F.col("toxic") == toxic, F.lit(math.ceil(1e6 * min(1.0, docs_per_class / size)))).otherwise(share)
    chosen = settled(known.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) < share), "labelled")
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return settled(texts.join(small(chosen), "doc_id").select("text", "toxic"), "labelled-texts")


class Model:
    """Weights of the features, and a bias."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias
        # For each part of a word that the model uses, its (level, place) pairs.
        self.parts: dict[str, list[tuple[int, int]]] = {}
        for feature, place in features.items():
            part, level = feature.rsplit("#", 1)
            self.parts.setdefault(part, []).append((int(level), place))
        self.seen: dict[str, tuple[str, ...]] = {}

    def indices(self, words: Mapping[str, int]) -> list[int]:
        if len(self.seen) + len(words) > 300_000:
            self.seen = {}
        seen, totals = self.seen, {}
        for word, n in words.items():
            if word not in seen:
                seen[word] = tuple(part for part in _parts(word) if part in self.parts)
            for part in seen[word]:
                totals[part] = totals.get(part, 0) + n
        return sorted(place for part, n in totals.items() for level, place in self.parts[part] if n >= level)

    def score(self, text: str | None) -> float:
        found = self.indices(Counter(words_of(text or "")))
        margin = self.bias + float(self.weights[found].sum()) if found else self.bias
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, margin))))


def _choose(sample: DataFrame, limit: int) -> dict[str, int]:
    """The features whose presence tells the classes apart best, by a chi-squared statistic."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for toxic, texts in batch.groupby("toxic")["text"]:
                counts: Counter = Counter()
                for text in texts:
                    counts.update(_present(Counter(words_of(text))))
                if counts:
                    yield pd.DataFrame({"feature": list(counts), "toxic": int(toxic), "n": list(counts.values())})

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not bad or not good:
        return {}
    counted = sample.mapInPandas(count, "feature string, toxic int, n bigint").groupBy("feature")
    counted = counted.agg(*[F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).cast("double").alias(name) for t, name in ((1, "b"), (0, "g"))])
    b, g = F.col("b"), F.col("g")
    off = b * (F.lit(good) - g) - g * (F.lit(bad) - b)
    spread = F.lit(bad * good) * (b + g) * (F.lit(bad + good) - b - g)
    ranked = counted.where(b + g >= LEAST_DOCS).withColumn("chi", F.when(spread > 0, off * off * (bad + good) / spread).otherwise(F.lit(0.0)))
    ranked = ranked.where("chi > 6.63").orderBy(F.desc("chi"), "feature").limit(limit)
    return {r["feature"]: i for i, r in enumerate(ranked.select("feature").collect())}


def learn(docs: DataFrame, labels: DataFrame, swaps: Mapping[str, str] = SWAPS, docs_per_class: int = DOCS_PER_CLASS, features: int = FEATURES, fairness: float = FAIRNESS) -> Model:
    """Classifier from a bounded labelled sample; gradients are formed by Spark, part by part.

    ``labels`` needs ``doc_id`` and ``toxic``; values other than 0 and 1 are no labels, and
    a document labelled both ways counts as toxic. Without labels of both classes the model
    scores every text by the share of its only class, or 0 without any.
    """
    ship_package(docs.sparkSession)
    sample = labelled_sample(docs, labels, docs_per_class)
    at = _choose(sample, features)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    rows = sum(sizes.values())
    share = sizes.get(1, 0) / rows if rows else 0.0
    bias = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    empty = Model(at, np.zeros(len(at)), bias)
    if not at:
        return empty

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = Counter(words_of(text))
                twin: Counter = Counter()
                for word, n in words.items():
                    twin[swaps.get(word, word)] += n
                out.append((int(toxic), empty.indices(words), empty.indices(twin) if twin != words else None))
            yield pd.DataFrame(out, columns=["toxic", "own", "twin"])

    shape = "toxic int, own array<int>, twin array<int>"
    encoded = settled(sample.mapInPandas(encode, shape).repartition(PARTS), "encoded")
    size = len(at) + 1

    def gradient(weights: np.ndarray):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            slope, bend = np.zeros(size), np.zeros(size)
            for batch in batches:
                for toxic, own, twin in zip(batch["toxic"], batch["own"], batch["twin"]):
                    own = np.append(np.asarray(own, dtype=int), size - 1)
                    p = 1 / (1 + math.exp(-max(-60.0, min(60.0, weights[own].sum()))))
                    slope[own] += p - toxic
                    bend[own] += p * (1 - p)
                    if twin is not None:
                        change = np.zeros(size)
                        change[own[:-1]] += 1
                        change[np.asarray(twin, dtype=int)] -= 1
                        slope += 2 * fairness * (change @ weights) * change
                        # A bound of the row's curvature: off-diagonal parts count as well.
                        bend += 2 * fairness * np.abs(change) * np.abs(change).sum()
            yield pd.DataFrame({"slope": [slope.tobytes()], "bend": [bend.tobytes()]})

        return run

    weights = np.append(np.zeros(len(at)), bias)
    ridge = np.append(np.full(len(at), RIDGE), 0.0)
    step = np.zeros(size)
    for _ in range(STEPS):
        parts = encoded.mapInPandas(gradient(weights), "slope binary, bend binary").collect()
        slope = sum((np.frombuffer(p["slope"]) for p in parts), ridge * weights)
        bend = sum((np.frombuffer(p["bend"]) for p in parts), ridge + 1e-9)
        # Momentum on a diagonal Newton step, shortened because features come in groups.
        step = 0.7 * step - 0.25 * slope / bend
        weights = weights + np.clip(step, -1.0, 1.0)
    return Model(at, weights[:-1], float(weights[-1]))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``score`` (0 to 1) and ``predicted`` of every whole text; null counts as empty."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(text) for text in texts], dtype=float)

    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*hidden, scored(F.col("text")).alias("s"))
    return rows.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], F.col("s").alias("score"), (F.col("s") >= 0.5).cast("int").alias("predicted"))
