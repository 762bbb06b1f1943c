"""Line dedup against a direct search for repeated runs."""

import random

from fixtures_llm import documents

from plumbline.llm.line_dedup import dedup_lines


def brute(rows, min_words):
    lines = {i: t.split("\n") for i, t in rows}
    place = [(i, k) for i in sorted(lines) for k in range(len(lines[i]))]
    dead = set()
    for i, k in place:
        for j, m in place:
            if (j, m) >= (i, k):
                break
            n = words = 0
            while k + n < len(lines[i]) and m + n < len(lines[j]) and lines[i][k + n] == lines[j][m + n]:
                words += len(lines[i][k + n].split())
                n += 1
            if words >= min_words:
                dead.update((i, k + x) for x in range(n))
    return {i: ("\n".join(x for k, x in enumerate(ls) if (i, k) not in dead), sum((i, k) in dead for k in range(len(ls)))) for i, ls in lines.items()}


def check(spark, rows, min_words):
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(documents(spark, rows), min_words).collect()}
    assert got == brute(rows, min_words)


def test_random_texts(spark):
    dice = random.Random(5)
    pool = ["", "a", "b c", "d e f", "g h i j k"]
    for min_words in (1, 4, 9):
        rows = [(i, "\n".join(dice.choice(pool) for _ in range(dice.randint(1, 12)))) for i in range(14)]
        check(spark, rows, min_words)


def test_long_runs_and_overlaps(spark):
    run = "\n".join(f"line number {i}" for i in range(37))
    rows = [(1, run), (2, "head\n" + run + "\ntail"), (3, run[: len(run) // 2]), (4, "x y\n" * 40 + "z"), (5, run)]
    check(spark, rows, 30)


def test_only_enough_words_go(spark):
    licence = "short licence line"
    got = {r["doc_id"]: r for r in dedup_lines(documents(spark, [(1, f"one\n{licence}"), (2, f"two\n{licence}"), (3, None), (4, "")])).collect()}
    assert got[2]["text"] == f"two\n{licence}" and got[3]["text"] is None and got[3]["n_lines"] == 0 and got[4]["n_lines"] == 1
