"""Exact search against all products."""

import numpy as np
import pytest

from plumbline.llm import topk_search
from plumbline.llm.topk_search import build_tree, nearest, search


def brute(rows, every, k):
    usable = []
    for i, (name, v) in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v):
            usable.append((i, name, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)))
    out = []
    for i, name, q in usable:
        if name is None or name % every:
            continue
        hits = sorted((-int(q @ c), other is None, other or 0) for j, other, c in usable if j != i and len(c) == len(q))[:k]
        out += [(name, n + 1, None if null else v, -s) for n, (s, null, v) in enumerate(hits)]
    return sorted(out, key=str)


def check(spark, rows, every=10, k=5, **options):
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, shard string")
    got = sorted((tuple(r) for r in nearest(frame, every, k, **options).collect()), key=str)
    rounded = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    assert got == brute(rounded, every, k)


@pytest.mark.parametrize("shard_rows", [10**6, 60])
def test_random_vectors(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(topk_search, "LEAF", 8)
    dice = np.random.default_rng(1)
    check(spark, [(i, [float(x) for x in dice.normal(size=6)]) for i in range(400)], shard_rows=shard_rows)


def test_ties_repeats_and_broken_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(40)] + [(10, [1.0, 0.5]), (10, [0.0, 0.0]), (None, [1.0, 0.5]), (None, [9.0, 9.0])]
    rows += [(50, None), (60, []), (70, [None, 1.0]), (80, [float("nan"), 1.0]), (90, [float("inf"), 1.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 0.0, 0.0])]
    check(spark, rows)
    check(spark, rows, shard_rows=9)


def test_fewer_than_k_and_empty(spark):
    check(spark, [(0, [1.0]), (1, [-1.0]), (2, [0.3])])
    check(spark, [(0, [1.0])])
    check(spark, [])


def test_products_beyond_doubles_are_longs():
    vectors = np.array([[2**31, 1], [2**31, 2], [2**31, 3]], dtype=np.int64)
    tree = build_tree(vectors, np.array([1, 2, 3]), np.array([1, 2, 3]), leaf=1)
    found = search(tree, vectors[:1], np.array([1]), np.array([topk_search.NO_SCORE]), np.array([topk_search.NO_ID]), 2)
    assert found == [[(2**62 + 3, 3), (2**62 + 2, 2)]]
