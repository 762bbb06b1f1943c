"""Components against all pairs of sets, the prefix tree against plain intersections."""

import random

import numpy as np
from fixtures_llm import documents, odd_rows

from plumbline.llm import jaccard_join
from plumbline.llm.components import connected_components
from plumbline.llm.jaccard_join import jaccard_components, tree_links

FOLDER = "/root/testdata/sf0.01"


def sets_of(rows, size=4):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        out.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    return out


def brute(rows):
    sets = sets_of(rows)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for gram in s:
            holders.setdefault(gram, []).append(i)
    near = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * len(sets[a] | sets[b]):
            up[find(a)] = find(b)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[find(i)] = min(doc, names.get(find(i), doc))
    return sorted((str(doc), len(sets[i]), str(names.get(find(i)))) for i, (doc, _) in enumerate(rows))


def check(spark, frame):
    got = jaccard_components(frame).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute([(r["doc_id"], r["text"]) for r in frame.collect()])


def test_whole_table(spark):
    check(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))


def family(dice, base, copies, edits):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(dice.randint(0, edits)):
            words[dice.randrange(len(words))] = f"new{dice.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_families_of_near_copies(spark, monkeypatch):
    dice = random.Random(11)
    texts = []
    for size, length, edits in ((60, 120, 4), (40, 40, 2), (30, 300, 16), (5, 9, 1)):
        texts += family(dice, [f"w{dice.randrange(500)}" for _ in range(length)], size, edits)
    texts += [" ".join(f"u{dice.randrange(10**6)}" for _ in range(50)) for _ in range(40)]
    dice.shuffle(texts)
    frame = documents(spark, [*enumerate(texts), *odd_rows()])
    path_rows = frame.coalesce(3)
    check(spark, path_rows)
    # Small blocks and batches take every path through pairs of blocks.
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(jaccard_join, "RANGE_BYTES", 4000)
    check(spark, path_rows)


def test_case_and_white_space(spark):
    rows = [(1, "A b C d"), (2, "a B c\x0bd"), (3, "ÄB c d e"), (4, "äB c d e"), (5, "a b"), (6, "A  B"), (7, "a"), (8, "a b c"), (9, "one two three four five six"), (10, "a b a b a b a b")]
    check(spark, documents(spark, rows))


def test_tree_links():
    dice = np.random.default_rng(2)
    for _ in range(30):
        base = dice.choice(400, 90, replace=False)
        make = lambda n: [np.unique(np.append(dice.choice(base, dice.integers(60, 90), replace=False), dice.integers(400, 500, dice.integers(0, 12)))) for _ in range(n)]  # noqa: E731, B023
        left, right = make(12), make(9)
        own = lambda sets: np.array([len(s) for s in sets]) + dice.integers(0, 6, len(sets))
        a, b = own(left), own(right)
        want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if 100 * len(np.intersect1d(x, y)) >= 70 * (a[i] + b[j] - len(np.intersect1d(x, y)))}
        assert set(tree_links(left, a, right, b, 70)) == want


def test_connected_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}
