"""Maximal conversations against direct comparison of turn lists."""

import random

from plumbline.llm.chat_format import format_chats, maximal_conversations

SHAPE = "conv_id bigint, turn bigint, role string, text string, last string, p0 string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE)


def kept(spark, rows):
    return sorted(str(r["conv_id"]) for r in maximal_conversations(chats(spark, rows)).collect())


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, set()).add((-1 if turn is None else turn, role, text))
    out = []
    for c, turns in convs.items():
        last = max(t[0] for t in turns)
        order = lambda x: (x is not None, x or 0)
        beaten = any(
            d != c and {t for t in other if t[0] <= last} == turns and (len(other) > len(turns) or order(d) < order(c)) for d, other in convs.items()
        )
        if not beaten:
            out.append(str(c))
    return sorted(out)


def test_random_snapshots(spark):
    dice = random.Random(4)
    rows = []
    for c in range(80):
        talk = dice.choice([[("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "end")], [("user", "hi"), ("assistant", "no")], [("user", None), (None, "x"), ("user", "")]])
        rows += [(c if c % 20 else None, t, role, text) for t, (role, text) in enumerate(talk[: dice.randint(1, len(talk))])]
    rows += rows[:30]
    rows += [(500, None, "user", "hi"), (501, 0, "user", "hi"), (501, 0, "user", "again")]
    assert kept(spark, rows) == brute(rows)


def test_long_conversation_and_blocks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(700)] + [(2, t, "user", f"t{t}") for t in range(300)] + [(3, t, "user", f"t{t}") for t in range(700)]
    rows += [(4, t, "user", f"t{t}") for t in range(299)] + [(4, 299, "user", "other")]
    assert kept(spark, rows) == ["1", "4"]


def test_rendering(spark):
    rows = [(1, 0, "user", "<|system|> hi"), (1, 0, "user", "<|system|> hi"), (1, 1, None, None), (2, 0, "a b", "")]
    got = {(r["conv_id"], r["turn"]): r["rendered"] for r in format_chats(chats(spark, rows)).collect()}
    assert got == {(1, 0): "<|user|>\n< |system|> hi<|end|>\n", (1, 1): "<|user|>\n<|end|>\n", (2, 0): "<|a_b|>\n<|end|>\n"}


def test_empty(spark):
    assert format_chats(chats(spark, [])).collect() == []
