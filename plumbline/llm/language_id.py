"""Language of a text by word frequencies, backing off to shorter and shorter character n-grams.

A word of the model scores its log frequency in each language. Any other word is covered
from left to right by the longest n-grams the model knows, down to single characters.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import settled
from plumbline.session import ship_package

UNKNOWN = "und"
# Bounds of the model, each per language: labelled documents read, words and n-grams held.
DOCS_PER_LANGUAGE, WORDS, GRAMS = 3000, 20_000, 15_000
# More languages than this raise: the model has one number per name and language.
LANGUAGES = 500
LONGEST = 5
# A text counts as at most so many words when its score is formed, so that scores stay comparable.
EVIDENCE = 20


def _signs(*categories: str) -> frozenset[str]:
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in categories)


def _inside(signs: frozenset[str]) -> str:
    """``signs`` as the inside of a character class."""
    codes = sorted(map(ord, signs))
    ends = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[b - 1]:08x}" for a, b in zip([0, *ends], [*ends, len(codes)]))


# A word is letters and the marks on them; numerals such as fractions and Roman numbers are no letters.
_numerals, _marks = _signs("Nl", "No"), _signs("Mn", "Mc")
_letter = rf"[^\W\d_{_inside(_numerals)}]"
_word = re.compile(rf"{_letter}+(?:[{_inside(_marks)}]+{_letter}*)*")
# Texts without marks and such numerals, most of all, are cut by a far cheaper pattern into the same words.
_rare, _plain_word = _numerals | _marks, re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (_plain_word if text.isascii() or _rare.isdisjoint(set(text)) else _word).findall(text)


def held_out(doc_id: Column) -> Column:
    """The fifth of documents that no model may learn from; rows without an id belong to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            counts: Counter = Counter()
            for text in texts:
                counts.update(words_of(text))
            if counts:
                yield pd.DataFrame({"lang": lang, "name": list(counts), "n": list(counts.values())})


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, words in batch.groupby("lang"):
            counts: Counter = Counter()
            for word, n in zip(words["name"], words["n"]):
                for size in range(1, LONGEST + 1):
                    for i in range(len(word) - size + 1):
                        counts[word[i : i + size]] += n
            if counts:
                yield pd.DataFrame({"lang": lang, "name": list(counts), "n": list(counts.values())})


class Model:
    """Log frequencies per language of words and of n-grams of each length.

    ``words`` and ``grams`` give the row that a name has in ``word_rows`` or ``gram_rows``.
    Every worker holds the model, so it has two arrays and not one for each name, and keeps
    nothing of the texts it has judged.
    """

    def __init__(self, languages: list[str], words: dict[str, int], word_rows: np.ndarray, grams: dict[str, int], gram_rows: np.ndarray):
        self.languages, self.words, self.grams = languages, words, grams
        self.word_rows, self.gram_rows = word_rows, gram_rows
        # What a character costs of which the model knows nothing.
        self.nothing = np.full(len(languages), -12.0)

    def _score(self, word: str) -> np.ndarray:
        """The score of a word that the model does not know."""
        total, i, pieces = np.zeros(len(self.languages)), 0, 0
        while i < len(word):
            for size in range(min(LONGEST, len(word) - i), 0, -1):
                at = self.grams.get(word[i : i + size])
                if at is not None:
                    score = self.gram_rows[at]
                    break
            else:
                score = self.nothing
            total = total + score
            i += size
            pieces += 1
        return total / pieces

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text)) if text else None
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        words = self.words
        at = np.array([words.get(word, -1) for word in counts])
        rows = np.empty((len(at), len(self.languages)))
        known = at >= 0
        rows[known] = self.word_rows[at[known]]
        if len(new := np.flatnonzero(~known)):
            names = list(counts)
            for i in new.tolist():
                rows[i] = self._score(names[i])
        n = np.fromiter(counts.values(), float, len(counts))
        # Rounding makes equal evidence equal whatever the order of words in memory.
        scores = np.round(n @ rows / n.sum(), 9) * min(n.sum(), EVIDENCE)
        best = int(scores.argmax())
        return self.languages[best], float(1 / np.exp(scores - scores[best]).sum())


def _table(counted: DataFrame, by_length: bool, languages: list[str], limit: int) -> tuple[dict[str, int], np.ndarray]:
    """The ``limit`` most frequent names of each language, and the row of each in their smoothed log frequencies; totals are by length if asked."""
    counted = settled(counted.groupBy("lang", "name").agg(F.sum("n").alias("n")), "counts")
    size = F.length("name") if by_length else F.lit(0)
    sizes = {(r["lang"], r["size"]): float(r["n"]) for r in counted.groupBy("lang", size.alias("size")).agg(F.sum("n").alias("n")).collect()}
    # Spark drops what is beyond the limit before the shuffle.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "name"))
    chosen = counted.withColumn("place", place).where(F.col("place") <= limit).select("name").distinct()
    at = {lang: i for i, lang in enumerate(languages)}
    found = counted.join(chosen, "name").orderBy("name", "lang").collect()
    names: dict[str, int] = {}
    for row in found:
        names.setdefault(row["name"], len(names))
    counts = np.zeros((len(names), len(languages)), np.float32)
    for row in found:
        counts[names[row["name"]], at[row["lang"]]] += row["n"]
    kinds = np.fromiter((len(name) if by_length else 0 for name in names), np.int64, len(names))
    totals = np.array([[sizes.get((lang, k), 0.0) for lang in languages] for k in range(LONGEST + 1)])
    return names, np.log((counts + 0.5) / (totals[kinds] + 1000.0)).astype(np.float32)


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, languages: int = LANGUAGES, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Model from rows with ``doc_id``, ``text`` and ``lang``, all bounds being parameters.

    Of each language about ``docs_per_language`` labelled documents are read, chosen by a
    hash of ``doc_id``, and its ``words`` and ``grams`` most frequent ones kept. Held-out
    documents are never read. Rows that repeat count each time; more labels than
    ``languages`` raise ``ValueError`` rather than leaving some out.
    """
    ship_package(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = usable.groupBy("lang").count().limit(languages + 1).collect()
    if len(counts) > languages:
        raise ValueError(f"more than {languages} languages are labelled: raise the bound or merge labels")
    names = sorted(row["lang"] for row in counts)
    share = {row["lang"]: math.ceil(1e6 * min(1.0, docs_per_language / row["count"])) for row in counts}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair]) if share else F.lit(None).cast("map<string,int>")
    sample = usable.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) < F.element_at(shares, F.col("lang"))).select("lang", "text")

    shape = "lang string, name string, n bigint"
    counted = settled(sample.mapInPandas(_count_words, shape).groupBy("lang", "name").agg(F.sum("n").alias("n")), "words")
    return Model(names, *_table(counted, False, names, words), *_table(counted.mapInPandas(_count_grams, shape), True, names, grams))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` of every whole text.

    Null texts and texts without a letter give ``und`` and score 0, as does a model that saw
    no labelled text. ``score`` is the share of the best language, from 0 to 1. Ties go to
    the first language by name. Every row is judged by itself, whole, so ids may be null
    and rows may repeat; memory for a very long text is that of its distinct words.
    Columns of ``docs`` not in ``keep`` are left out.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(text) for text in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*hidden, predicted(F.col("text")).alias("p"))
    return rows.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], "p.lang_pred", "p.score")
