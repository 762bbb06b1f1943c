"""Decontamination against a search without an index, and WAND against full scoring."""

import random

import numpy as np
from fixtures_llm import documents
from pyspark.sql import functions as F

from plumbline.llm import catalog, decontaminate
from plumbline.llm.decontaminate import contained, question_and_answer, words_of

FOLDER = "/root/testdata/sf0.01"


def share(part, words):
    """Most words of ``part`` in order within any stretch a quarter longer, by the plain table."""
    span, best, known = len(part) + max(1, len(part) // 4), 0, set(words)
    if sum(w in known for w in part) < 0.8 * len(part):
        return 0.0
    for i in range(len(words)):
        row = [0] * (len(part) + 1)
        for w in words[i : i + span]:
            new = [0]
            for j, x in enumerate(part):
                new.append(row[j] + 1 if x == w else max(new[-1], row[j + 1]))
            row = new
        best = max(best, row[-1])
    return best / len(part)


def direct(question, answer, words):
    """The documented rule for a whole text, with sets of shingles and plain tables."""

    def held(part):
        if not part:
            return True
        size = min(5, len(part))
        cut = lambda ws: {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}
        need = cut(part)
        if len(need & cut(words)) >= 0.8 * len(need):
            return True
        return len(need) < 25 and share(part, words) >= 0.8

    return held(question) and (held(answer) or len(question) >= 16) or held(question + answer)


def test_same_leaks_as_a_direct_search(spark):
    items = [(r["item_id"], *question_and_answer(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = set()
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        words = words_of(row["text"])
        want |= {(row["doc_id"], i) for i, q, a in items if direct(q, a, words)}
    got = {(r["doc_id"], r["item_id"]) for r in catalog.queries()["op5_decontaminate"](spark, FOLDER).collect()}
    assert got == want and got


def test_one_changed_word_is_found(spark):
    dice = random.Random(5)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows, want = [], set()
    for i, row in enumerate(items.collect()):
        for k in range(5):
            words = row["text"].split()
            words[dice.randrange(len(words))] = "zyxwv."[: 5 + k % 2]
            rows.append((i * 5 + k, "some words before " + " ".join(words) + " and some after"))
            want.add((i * 5 + k, row["item_id"]))
    found = decontaminate.find_leaks(documents(spark, rows), items).collect()
    got = {(r["doc_id"], h["item_id"]) for r in found for h in r["leaks"]}
    assert len(want & got) >= 0.95 * len(want)


def test_same_hits_from_one_index_and_from_many(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "benchmark"))
    accents = spark.createDataFrame([(10**6, "नमस्ते दुनिया " * 12 + "e\u0301tude cafe\u0301. Answer of e\u0301tude one two three four five")], items.select("item_id", "text").schema)
    items = items.select("item_id", "text").unionByName(accents)
    docs = docs.select("doc_id", "text").unionByName(accents.select(F.col("item_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text"))
    hits = lambda n: sorted((r["doc_id"], [(h["item_id"], round(h["score"], 9)) for h in r["leaks"]]) for r in decontaminate.find_leaks(docs, items, items_per_index=n).where("size(leaks) > 0").collect())
    one = hits(20_000)
    assert one == hits(10) and one[-1] == (10**6, [(10**6, 1.0)])


def test_words_in_order_against_a_table():
    dice = random.Random(8)
    for _ in range(300):
        a, b = dice.choices("abcdef", k=dice.randint(1, 14)), dice.choices("abcdefg", k=dice.randint(0, 17))
        row = [0] * (len(a) + 1)
        for w in b:
            new = [0]
            for j, x in enumerate(a):
                new.append(row[j] + 1 if x == w else max(new[-1], row[j + 1]))
            row = new
        assert decontaminate._in_order(a, b) == row[-1]


def test_wand_finds_what_full_scoring_finds():
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(dice.choices(vocabulary, k=dice.randint(5, 150)))) for i in range(120)]
    frequencies: dict[str, int] = {}
    for _, text in items:
        for part in decontaminate.entries_of(text):
            for w in set(part):
                frequencies[w] = frequencies.get(w, 0) + 1
    index = decontaminate.Index(items, frequencies, 200, 40.0)
    for _ in range(60):
        terms = sorted({index.vocabulary[w] for w in dice.choices(sorted(index.vocabulary), k=90)})
        scores = np.zeros(len(index.entry_item))
        for t in terms:
            for entry, impact in zip(index.docs[t], index.impacts[t]):
                scores[entry] += impact
        for threshold in (0.2, 0.5):
            found = dict(index.search(terms, threshold))
            assert set(found) == set(np.flatnonzero(scores >= threshold)) and all(abs(scores[e] - s) < 1e-9 for e, s in found.items())


def test_places_and_changes(spark):
    question = " ".join(f"alpha{i}" for i in range(30)) + "."
    answer = " ".join(f"beta{i}" for i in range(9))
    item = f"{question} {answer}"
    filler = " ".join(f"noise{i % 50}" for i in range(333))
    changed = item.replace("alpha7", "other")
    rows = [
        (1, filler), (2, f"{filler} {item} {filler}"), (3, item.upper()), (4, question), (5, f"{question} and nothing else"),
        (6, f"{filler} {changed}"), (7, f"{answer} {question}"), (8, None), (9, ""), (10, "alpha1 " * 500),
    ]
    items = spark.createDataFrame([(70, item), (70, "another text of the same id"), (None, item), (71, None), (72, "!")], "item_id bigint, text string")
    found = {r["doc_id"]: [h["item_id"] for h in r["leaks"]] for r in decontaminate.find_leaks(documents(spark, rows), items).collect()}
    # A long question without its answer counts.
    assert {d for d, hits in found.items() if hits} == {2, 3, 4, 5, 6, 7} and found[2] == [70] and len(found) == 10
    several = list(decontaminate.build_indexes(items, items_per_index=1))
    assert sum(len(i.items) for i in several) == 3 and not list(decontaminate.build_indexes(items.limit(0)))
