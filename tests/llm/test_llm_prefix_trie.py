"""The trie against one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from plumbline.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, at string, length string, t1 string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def conversations(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            mark = hashlib.md5((text or "").encode()).hexdigest()
            found.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", mark, text or ""))
    return {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in found.items()}


def rebuilt(own):
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - int(conv - 100 * int(conv / 100)), [])[:h] + turns[h:]
    return out


def by_hand(whole):
    members = {}
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        below = kids.get(seq, [])
        leaves[seq] = sum(leaves[k] for k in below) or 1
        saved[seq] = sum(saved[k] for k in below) + (len(members[seq]) - 1) * (len(seq[-1][1]) if seq else 0)
    for seq, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(whole[c]) == len(seq))
        yield (
            min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), len(kids.get(seq, [])),
            leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest(),
        )


def check(spark, rows, rebuild=True):
    turns = prefix_trie.positions(table(spark, rows))
    whole = conversations(rows)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns) if rebuild else turns).collect()
    want = sorted(by_hand(rebuilt(whole) if rebuild else whole), key=lambda r: r[:2])
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == want
    return want


def mixed(seed, conversations=60):
    rng = random.Random(seed)
    rows = []
    for conv in [rng.randrange(-250, 250) for _ in range(conversations)]:
        rows += [(conv, t, rng.choice(["user", None]), rng.choice(["a", "bb", "", None])) for t in range(rng.choice([1, 2, 4, 9, 20]))]
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_random_conversations(spark, rebuild):
    check(spark, mixed(1), rebuild)


def test_narrow_blocks_chunks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "WIDTH", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    copies = [(c, t, "user", "same") for c in range(300, 330) for t in range(14)]
    check(spark, mixed(2, 40) + copies, rebuild=False)


def test_one_huge_conversation_copies_and_odd_rows(spark):
    rows = [(7, t, "user", f"turn {t % 5}") for t in range(5000)]
    rows += [(c, t, "user", "hello") for c in range(100, 140) for t in range(3)]
    rows += [(None, 1, "user", "nobody"), (8, None, None, None), (8, None, "", ""), (8, 1, "user", "é\U0001f600"), (8, 1, "user", "é\U0001f600")]
    found = check(spark, rows)
    assert max(r[1] for r in found) == 5000


def test_a_conversation_left_without_turns_is_a_member_of_the_root(spark):
    bare = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 4)
    assert check(spark, [(bare, 0, "user", "only")])[0][:4] == (bare, 0, None, 1)


def test_very_long_text(spark):
    check(spark, [(c, 0, "user", "long " * 200_000 + "x" * (c % 2)) for c in range(4)], rebuild=False)


def test_empty(spark):
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.positions(table(spark, [])))).collect() == []


def test_one_rollup_and_no_all_pairs(spark):
    found = prefix_trie.prefix_trie(prefix_trie.positions(table(spark, [(1, 0, "user", "a")])))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
