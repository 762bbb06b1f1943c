"""Near copies among vectors against all pairs."""

import numpy as np
import pytest

from plumbline.llm import pq_dedup

SCHEMA = "vec_id bigint, embedding array<double>, label int, rep string, list string, unit string, n_links string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", "x", "x", "x") for i, v, label in rows], SCHEMA)


def usable(v, label):
    return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def by_hand(rows, cosine):
    links = {i: set() for i in range(len(rows))}
    for label, dim in {(r[2], len(r[1])) for r in rows if usable(*r[1:])}:
        who = [i for i, r in enumerate(rows) if usable(*r[1:]) and (r[2], len(r[1])) == (label, dim)]
        x = np.array([rows[i][1] for i in who], dtype=float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a != b:
                links[who[a]].add(who[b])
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids, default=None)))
    return out


def check(spark, rows, cosine=0.98):
    got = [tuple(r) for r in pq_dedup.near_duplicates(table(spark, rows), cosine).collect()]
    want = by_hand(rows, cosine)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((r[:3] for r in got), key=key) == sorted(want, key=key)
    assert all(r[3] == (r[0] is not None and r[0] == r[2]) for r in got)
    return want


def clustered(rng, n, dim, labels, noise):
    rows = []
    for i in range(n):
        centre = rng.normal(size=dim)
        rows.append((len(rows), list(centre / np.linalg.norm(centre)), int(rng.integers(labels))))
        if i % 3 == 0:
            for _ in range(int(rng.integers(1, 6))):
                near = np.array(rows[-1][1]) + noise * rng.normal(size=dim) / np.sqrt(dim)
                rows.append((len(rows), list(near * rng.uniform(0.1, 9)), rows[-1][2]))
    return rows


@pytest.mark.parametrize("dim", [2, 5, 64])
def test_all_links_are_found(spark, monkeypatch, dim):
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", 20)
    monkeypatch.setattr(pq_dedup, "BLOCK", 16)
    monkeypatch.setattr(pq_dedup, "QUERIES", 16)
    monkeypatch.setattr(pq_dedup, "SAMPLE", 100)
    monkeypatch.setattr(pq_dedup, "PART_ROWS", 50)
    found = check(spark, clustered(np.random.default_rng(dim), 150, dim, 3, 0.15))
    assert sum(r[1] for r in found) > 100


def test_a_third_are_near_copies_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", 50)
    monkeypatch.setattr(pq_dedup, "BLOCK", 32)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    tight = [(i, list(centre + 0.05 * rng.normal(size=16)), 1) for i in range(150)]
    spread = [(i, list(centre + 0.2 * rng.normal(size=16)), 1) for i in range(150, 300)]
    copies = [(i, [1.0] * 16, 1) for i in range(300, 500)]
    found = check(spark, tight + spread + copies + [(i, list(rng.normal(size=16)), 1) for i in range(500, 900)])
    assert max(r[1] for r in found) >= 199


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1), (9, [2.0, 2.0], 1), (None, [1.0, 1.0], 1),
        (10, [1.0, 1.0], 2), (None, [3.0, 1.0], 3), (None, [3.0, 1.0], 3), (11, [1.0, 1.0, 0.0], 1), (12, [5.0], 1), (13, [-1.0], 1), (14, [7.0], 1),
        (15, [1e300, 1e300], 1), (16, [1e-300, 1e-300], 1), (17, [-1.0, -1.0], 1),
    ]
    check(spark, rows)


def test_empty(spark):
    assert pq_dedup.near_duplicates(table(spark, [])).collect() == []
