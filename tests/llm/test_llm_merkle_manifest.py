"""The manifest against trees built row by row."""

import hashlib
import zlib

import pytest
from fixtures_llm import documents, odd_rows
from pyspark.sql import functions as F

from plumbline.llm import merkle_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [None if v is None else str(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return digest(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def levels(hashes):
    found = [hashes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def path(tree, place):
    steps = []
    for level in tree[:-1]:
        begin = place // 8 * 8
        steps.append((place - begin, level[begin : begin + 8]))
        place //= 8
    return steps


def by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {lang: levels([leaf(r, r.text) for r in groups[lang]]) for lang in order}
    top = levels([trees[lang][-1][0] for lang in order])
    for place, lang in enumerate(order):
        for i, row in enumerate(groups[lang]):
            steps = path(trees[lang], i) + path(top, place)
            folded = trees[lang][0][i]
            if row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                folded = leaf(row, row.text.translate(LOWER))
            for at, run in steps:
                folded = digest(*run[:at], folded, *run[at + 1 :])
            proof = digest(*[h for at, run in steps for j, h in enumerate(run) if j != at])
            root = top[-1][0]
            yield (row.doc_id, trees[lang][0][i], trees[lang][-1][0], root, proof, folded, folded == root)


def key(row):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in row)


def check(docs):
    got = [tuple(r) for r in merkle_manifest.verified_manifest(docs).collect()]
    assert sorted(got, key=key) == sorted(by_hand(docs.collect()), key=key)
    return got


@pytest.mark.parametrize("count", [1, 2, 8, 9, 65, 513])
def test_sizes_around_full_runs_and_blocks(spark, count):
    got = check(documents(spark, [(i * 7 - 20, f"Text {i}", "en", "s") for i in range(count)]))
    assert len(got) == count and {r[-1] for r in got} <= {True, False}


def test_many_languages_nulls_ties_and_repeated_rows(spark):
    rows = odd_rows() + [(i % 11, f"T{i % 5}", f"l{i % 30}", None) for i in range(150)] + [(3, "x", "", "s"), (None, "Y", "", "s")]
    assert len(check(documents(spark, rows))) == len(rows)


def test_a_changed_text_is_found_and_an_unchanged_one_verifies(spark):
    got = {r[0]: r for r in check(documents(spark, [(i, "Upper" if i % 2 else "lower", "en", "s") for i in range(40)]))}
    hit = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 0]
    assert hit and all(got[i][-1] == (i % 2 == 0 or i not in hit) for i in got)


def test_empty(spark):
    assert merkle_manifest.verified_manifest(documents(spark, [])).collect() == []


def test_blocks_are_bounded_and_paths_come_without_joins(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    found = merkle_manifest.verified_manifest(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" in plan
    assert found.where("verified").count() == 2000
    assert merkle_manifest.ARITY**merkle_manifest.LEVELS == 512
