"""Benchmark passages in training text: BM25 over test items with block-max WAND, then verification.

The inverted index holds the test items, cut into segments of bounded length; the queries
are all passages of all texts. An item's scores are divided by its score for itself, so one
threshold serves short and long items. Posting lists come in blocks of neighbouring items
with the block's largest impact. Before any list is walked, sums of those maxima bound the
score of each passage in each block, for a whole batch of texts at once: the most frequent
words, whose impacts are small, enter by what they can add to an entry of the block at
most, the others by the blocks they occur in. Passages that no block lets through are done.
For the rest WAND walks the lists, skipping blocks whose maxima cannot reach the threshold.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settled
from plumbline.session import ship_package

K1, B = 1.2, 0.75
SEGMENT = 64  # words of an item that form one entry of the index
STRIDE = 64  # passages begin every so many words and are two strides long, so any segment lies within one
BLOCK = 4  # entries of a posting block
FREQUENT = 0.1  # words in at least this share of entries enter bounds by their total
THRESHOLD = 0.6  # of an entry's own score
SHINGLE, OVERLAP = 5, 0.8
# Parts with fewer shingles are held against the text by words in order: one changed word costs five shingles.
FEW_SHINGLES = 25
QUESTION_WORDS = 16  # a question found without its answer counts from this length on
ANSWER_WORDS = 8  # an item without a sentence end keeps its last words as answer
# Larger benchmarks are searched with one index after the other.
ITEMS_PER_INDEX, BYTES_PER_INDEX = 20_000, 16 << 20

_word = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _word.findall(text.lower()) if text else []


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words before and from the last sentence; the last words of a single sentence are its answer."""
    pieces = [w for w in (words_of(p) for p in re.split(r"(?<=[.!?])\s+|\n", text or "")) if w]
    if len(pieces) > 1:
        return [w for p in pieces[:-1] for w in p], pieces[-1]
    words = pieces[0] if pieces else []
    cut = max(len(words) - ANSWER_WORDS, len(words) // 2)
    return words[:cut], words[cut:]


def entries_of(text: str | None) -> list[list[str]]:
    """The segments that stand for an item in the index.

    They are cut from its question where that is long enough to count alone, and from the
    whole item where it is not or where the answer is a large part.
    """
    question, answer = question_and_answer(text)
    alone = len(question) >= QUESTION_WORDS
    parts = [question] if alone else []
    if not alone or 2 * len(answer) > len(question):
        parts.append(question + answer)
    return [part[at : at + SEGMENT] for part in parts for at in range(0, len(part), SEGMENT)]


def _shingles(words: list[str]) -> set[tuple[str, ...]]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _in_order(part: list[str], words: list[str]) -> int:
    """Words of the longest common subsequence of ``part`` and ``words``, rows of bits in one number."""
    masks: dict[str, int] = {}
    for i, w in enumerate(part):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(part)) - 1
    row = full
    for w in words:
        both = row & masks.get(w, 0)
        if both:
            row = ((row + both) | (row - both)) & full
    return len(part) - row.bit_count()


def contained(part: list[str], words: list[str]) -> float:
    """Share of ``part`` that occurs in ``words``; 1 for an empty part.

    It is the share of ``part``'s shingles; where these are fewer than :data:`FEW_SHINGLES`
    it is, if larger, the share of its words that a stretch of ``words`` not longer than
    ``part`` by more than a quarter holds in the same order.
    """
    need = _shingles(part)
    if not need:
        return 1.0
    size = len(next(iter(need)))
    shared = len(need & {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}) / len(need)
    if len(need) >= FEW_SHINGLES or shared == 1.0:
        return shared
    # Stretches start where a word of the part does, so that a copy of it from any of its words on lies in one.
    known, span = set(part), len(part) + max(1, len(part) // 4)
    hits = [w in known for w in words]
    inside = [0]
    for hit in hits:
        inside.append(inside[-1] + hit)
    best = shared
    for i in np.flatnonzero(hits):
        if inside[min(i + span, len(words))] - inside[i] > best * len(part):
            best = max(best, _in_order(part, words[i : i + span]) / len(part))
    return best


def overlaps(question: list[str], answer: list[str], words: list[str], overlap: float) -> tuple[bool, float, float]:
    """Whether ``words`` hold the item, and the shares of its question and answer they hold.

    They do if they hold ``overlap`` of the whole item, of question and answer each, or of a
    question of at least :data:`QUESTION_WORDS` words.
    """
    q, a = contained(question, words), contained(answer, words)
    found = (q >= overlap and a >= overlap) or (len(question) >= QUESTION_WORDS and q >= overlap)
    return found or contained(question + answer, words) >= overlap, q, a


class Index:
    """Inverted index of item segments with block maxima."""

    def __init__(self, items: list[tuple[int, str]], frequencies: dict[str, int], entries: int, mean_length: float):
        items = sorted(items)
        self.items = [(item, *question_and_answer(text)) for item, text in items]
        self.entry_item: list[int] = []  # places in self.items
        vectors: list[dict[str, float]] = []
        for place, (_, text) in enumerate(items):
            for part in entries_of(text):
                counts: dict[str, int] = {}
                for w in part:
                    counts[w] = counts.get(w, 0) + 1
                norm = K1 * (1 - B + B * len(part) / max(mean_length, 1e-9))
                impact = {w: np.log1p((entries - frequencies.get(w, 1) + 0.5) / (frequencies.get(w, 1) + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in counts.items()}
                own = sum(impact.values())
                self.entry_item.append(place)
                vectors.append({w: v / own for w, v in impact.items()})
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for v in vectors for w in v}))}
        self.docs: list[list[int]] = [[] for _ in self.vocabulary]
        self.impacts: list[list[float]] = [[] for _ in self.vocabulary]
        for entry, vector in enumerate(vectors):
            for w in sorted(vector):
                self.docs[self.vocabulary[w]].append(entry)
                self.impacts[self.vocabulary[w]].append(vector[w])
        self.top = np.array([max(x) for x in self.impacts] or [0.0])
        # Posting blocks: for each term, block number -> largest impact.
        self.blocks: list[dict[int, float]] = []
        for docs, impacts in zip(self.docs, self.impacts):
            held: dict[int, float] = {}
            for entry, impact in zip(docs, impacts):
                held[entry // BLOCK] = max(held.get(entry // BLOCK, 0.0), impact)
            self.blocks.append(held)
        # Flat block postings of rarer words, and what the frequent ones add to an entry at most.
        self.block_count = max(1, -(-len(vectors) // BLOCK))
        many = max(4, int(FREQUENT * len(vectors)))
        self.rare = np.array([len(d) < many for d in self.docs] + [False])
        common = np.zeros(self.block_count * BLOCK)
        for term in np.flatnonzero(~self.rare[:-1]):
            common[self.docs[term]] += self.impacts[term]
        self.common = common.reshape(-1, BLOCK).max(axis=1)
        kept = [held if rare else {} for held, rare in zip(self.blocks, self.rare)]
        self.first = np.concatenate([[0], np.cumsum([len(held) for held in kept])])
        self.flat_blocks = np.array([block for held in kept for block in held], dtype=np.int64)
        self.flat_tops = np.array([top for held in kept for top in held.values()])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Entries with a score of at least ``threshold`` for a passage with these distinct terms."""
        lists = [[self.docs[t][0], t, 0] for t in terms]  # next entry, term, place in the list
        found = []
        while lists:
            lists.sort()
            total, pivot = 0.0, -1
            for i, (_, term, _) in enumerate(lists):
                total += self.top[term]
                if total >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            entry = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == entry:
                pivot += 1
            block = entry // BLOCK
            if sum(self.blocks[term].get(block, 0.0) for _, term, _ in lists[: pivot + 1]) < threshold:
                # No entry of this block can do before a further list comes in.
                target = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0])
                lists = self._forward(lists, pivot + 1, max(target, entry + 1))
            elif lists[0][0] == entry:
                score = sum(self.impacts[term][at] for _, term, at in lists[: pivot + 1])
                if score >= threshold:
                    found.append((entry, score))
                lists = self._forward(lists, pivot + 1, entry + 1)
            else:
                lists = self._forward(lists, pivot, entry)
        return found

    def _forward(self, lists: list[list[int]], count: int, target: int) -> list[list[int]]:
        kept = []
        for i, held in enumerate(lists):
            if i < count and held[0] < target:
                docs = self.docs[held[1]]
                at = bisect_left(docs, target, held[2])
                if at == len(docs):
                    continue
                held = [docs[at], held[1], at]
            kept.append(held)
        return kept

    def leaks(self, texts: list[str | None], threshold: float, overlap: float) -> list[list[tuple[int, float, float, float]]]:
        """Per text the verified (item, score, question overlap, answer overlap), by item."""
        outside, get = len(self.vocabulary), self.vocabulary.get
        words = [words_of(text) for text in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        chunks = -(-sizes // STRIDE)
        out: list[list[tuple[int, float, float, float]]] = [[] for _ in texts]
        if not chunks.sum() or not self.entry_item:
            return out
        terms = np.fromiter((get(w, outside) for ws in words for w in ws), np.int32, int(sizes.sum()))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.concatenate([begins[i] + STRIDE * np.arange(n) for i, n in enumerate(chunks) if n])
        owner = np.repeat(np.arange(len(texts)), chunks)
        # A passage is a chunk and the next one of the same text.
        follows = np.append(owner[1:] == owner[:-1], False)
        for chunk in self._possible(terms, starts, follows, threshold):
            text = int(owner[chunk])
            at = int(starts[chunk] - begins[text])
            passage = terms[starts[chunk] : min(starts[chunk] + 2 * STRIDE, begins[text + 1])]
            distinct = np.unique(passage)
            distinct = distinct[distinct < outside]
            if self.top[distinct].sum() < threshold:
                continue
            for entry, score in self.search(distinct.tolist(), threshold):
                item, question, answer = self.items[self.entry_item[entry]]
                reach = len(question) + len(answer)
                near = words[text][max(0, at - reach) : at + 2 * STRIDE + reach]
                found, q, a = overlaps(question, answer, near, overlap)
                if found:
                    out[text].append((item, score, q, a))
        return [_best(found) for found in out]

    def _possible(self, terms: np.ndarray, starts: np.ndarray, follows: np.ndarray, threshold: float) -> np.ndarray:
        """Chunks whose passage has a block with a bound of at least ``threshold``."""
        at = np.flatnonzero(self.rare[terms])
        chunk = np.searchsorted(starts, at, side="right") - 1
        # Each word of a passage counts once, here once per chunk.
        pairs = np.unique(chunk * len(self.rare) + terms[at])
        chunk, term = pairs // len(self.rare), pairs % len(self.rare)
        counts = self.first[term + 1] - self.first[term]
        ends = np.cumsum(counts)
        posting = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - self.first[term], counts)
        cell = np.repeat(chunk, counts) * self.block_count + self.flat_blocks[posting]
        cells, inverse = np.unique(cell, return_inverse=True)
        sums = np.bincount(inverse, self.flat_tops[posting], len(cells))
        # The passage of chunk c holds the words of c and of the next chunk.
        place = cells // self.block_count
        before = np.flatnonzero((place > 0) & follows[place - 1])
        cells, inverse = np.unique(np.concatenate([cells, cells[before] - self.block_count]), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate([sums, sums[before]]), len(cells))
        possible = sums + self.common[cells % self.block_count] >= threshold - 1e-9
        found = cells[possible] // self.block_count
        if (self.common >= threshold - 1e-9).any():
            # Frequent words alone could do: every passage has to be searched.
            return np.arange(len(starts))
        return np.unique(found)


def _best(found: list[tuple[int, float, float, float]]) -> list[tuple[int, float, float, float]]:
    best: dict[int, tuple[int, float, float, float]] = {}
    for hit in found:
        if hit[0] not in best or hit[1:] > best[hit[0]][1:]:
            best[hit[0]] = hit
    return [best[item] for item in sorted(best)]


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(shard, word, n, length) of each segment; the empty word counts segments and their words."""
    for batch in batches:
        out = []
        for shard, text in zip(batch["shard"], batch["text"]):
            for part in entries_of(text):
                out += [(shard, "", 1, len(part)), *((shard, w, 1, 0) for w in set(part))]
        yield pd.DataFrame(out, columns=["shard", "word", "n", "length"])


def build_indexes(items: DataFrame, items_per_index: int = ITEMS_PER_INDEX, bytes_per_index: int = BYTES_PER_INDEX) -> Iterator[Index]:
    """Indexes over all items, one after the other, with statistics over all of them.

    An index has about ``items_per_index`` items and ``bytes_per_index`` of text at most, so
    that the driver holds one of bounded size at a time. ``items`` has ``item_id`` and
    ``text``; items with a null id or without a word are left out.
    """
    ship_package(items.sparkSession)
    held = settled(items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct(), "items")
    size = held.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size["items"] // items_per_index), -(-size["bytes"] // bytes_per_index))
    held = held.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    counted = held.mapInPandas(_word_counts, "shard int, word string, n bigint, length bigint")
    by_shard = settled(counted.groupBy("shard", "word").agg(F.sum("n").alias("n"), F.sum("length").alias("length")), "item-words")
    total = by_shard.where("word = ''").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).first()
    if not total["n"]:
        return
    whole = by_shard.where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))
    # Each shard's words with their frequencies over the whole benchmark.
    frequencies = settled(by_shard.where("word != ''").select("shard", "word").join(whole, "word"), "item-frequencies") if shards > 1 else whole.withColumn("shard", F.lit(0))
    for shard in range(shards):
        rows = [(r["item_id"], r["text"]) for r in held.where(F.col("shard") == shard).select("item_id", "text").collect()]
        if rows:
            own = {r["word"]: r["n"] for r in frequencies.where(F.col("shard") == shard).collect()}
            yield Index(rows, own, total["n"], total["length"] / total["n"])


LEAKS = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double>>"


def _search_udf(shared, threshold: float, overlap: float):
    @F.pandas_udf(LEAKS)
    def found(texts: pd.Series) -> pd.Series:
        out: list = []
        values = texts.tolist()
        for i in range(0, len(values), 500):
            out += shared.value.leaks(values[i : i + 500], threshold, overlap)
        return pd.Series([[{"item_id": i, "score": float(s), "question_overlap": q, "answer_overlap": a} for i, s, q, a in hits] for hits in out], dtype=object)

    return found


def find_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, keep: tuple[str, ...] = ("doc_id",), items_per_index: int = ITEMS_PER_INDEX
) -> DataFrame:
    """Columns ``keep`` and ``leaks``, an array of (item_id, score, question_overlap, answer_overlap).

    Every passage of every whole text is a query. An item is a candidate for a text if a
    passage scores at least ``threshold`` of the item's own score, and counts if the words
    around hold at least ``overlap`` of the whole item, of its question and its answer (the
    last sentence), or of its question alone where that is long (see :func:`overlaps`): the
    two shares tell which. Words are runs of letters and digits in lower case. Null and
    empty texts have no leaks; items that repeat an id count apart as texts and are reported
    by id. One row per input row, so repeated ids stay rows of their own; columns of
    ``docs`` not in ``keep`` are left out.
    """
    spark = docs.sparkSession
    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*hidden, F.col("text").alias("t"), F.array().cast(LEAKS).alias("leaks"))
    for index in build_indexes(items, items_per_index):
        shared = spark.sparkContext.broadcast(index)
        del index  # The copy for the driver's own use; what is sent lies in a file.
        searched = _search_udf(shared, threshold, overlap)
        rows = rows.withColumn("leaks", F.concat("leaks", searched("t")))
    return rows.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], F.array_sort("leaks").alias("leaks"))
