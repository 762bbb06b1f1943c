"""Secrets in text: three fixed patterns, and runs of characters whose sliding-window entropy is high.

Positions come from the lengths of the pieces between matches, so each pattern reads a
text once to split it and once to list its matches. All work is per row: no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_longs, running_total

# Fixed patterns of the three base kinds, in the order in which kinds are listed.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
KINDS = [*PATTERNS, "entropy"]
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# A candidate is worth sliding over if it has a digit or letters of both cases.
WORTH = r"[0-9]|[A-Z].*[a-z]|[a-z].*[A-Z]"
# Signs of candidates by kind, in the order of their codes. Fixed values.
SIGNS = {"digit": "0123456789", "hex_lower": "abcdef", "lower": "ghijklmnopqrstuvwxyz", "hex_upper": "ABCDEF", "upper": "GHIJKLMNOPQRSTUVWXYZ", "other": "+/_=-"}
ALPHABET = "".join(SIGNS.values())
# Bits by which a window may stay below the entropy expected of random signs of its class.
SLACK = 0.15
# Parts that are no secrets, looked for up to a window's width around them: only digits,
# runs of one separator, UUIDs, spelled-out placeholders.
ALLOWED = (
    r"^[0-9]+$",
    r"^[-_=+/]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|dummy|sample",
)
# Counts of signs share longs, ten of six bits each; counts of kinds share one, of eight bits.
_PER_LONG, _BITS, _KIND_BITS = 10, 6, 8


def _matches(text: Column, kind: str) -> tuple[Column, Column]:
    """Matched strings (with group 2 of ``assign``) and the pieces between them."""
    # Shorter hex runs fail the length test anyway; leaving them out of the match changes no span.
    pattern = r"[0-9a-f]{16,}" if kind == "hex" else CANDIDATE if kind == "entropy" else PATTERNS[kind]
    return F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)


def _spans(found: Column, pieces: Column) -> Column:
    """Array of (start, end, match) in code points."""
    lengths = F.transform(found, lambda m: F.length(m))
    before = F.zip_with(F.slice(pieces, 1, F.size(found)), F.concat(F.array(F.lit(0)), F.slice(lengths, 1, F.greatest(F.size(found) - 1, F.lit(0)))), lambda p, n: F.length(p) + n)
    starts = running_total(as_longs(before))
    return F.zip_with(starts, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("match")))


def expected_entropy(symbols: int, width: int) -> float:
    """Bits a character of ``width`` random signs out of ``symbols`` have on average."""
    share = 1 / symbols
    mean = sum(math.comb(width, k) * share**k * (1 - share) ** (width - k) * k * math.log2(k) for k in range(1, width + 1))
    return math.log2(width) - symbols * mean / width


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _coded(signs: Column) -> Column:
    """Per sign the long and the bits its count is held in, and the bits of its kind's count."""
    kind_ends = [sum(len(v) for v in list(SIGNS.values())[: i + 1]) for i in range(len(SIGNS))]

    def kind(code: Column) -> Column:
        chosen = F.lit(1 << _KIND_BITS * (len(SIGNS) - 1))
        for i in reversed(range(len(SIGNS) - 1)):
            chosen = F.when(code < kind_ends[i], F.lit(1 << _KIND_BITS * i)).otherwise(chosen)
        return chosen.cast("bigint")

    codes = F.transform(signs, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.transform(
        codes,
        lambda c: F.struct(
            F.floor(c / _PER_LONG).cast("int").alias("long"), (c % _PER_LONG * _BITS).cast("int").alias("shift"),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (c % _PER_LONG * _BITS).cast("int")).alias("bit"), kind(c).alias("kind"),
        ),
    )


def _is_secret(total: Column, kinds: Column, width: int) -> Column:
    """Whether a window with this sum of ``c * log2(c)`` is as mixed as random signs of its class.

    Digits and letters of one case: as 16 signs if all are hexadecimal, else as 32. With
    letters of both cases, or with further signs, as 64.
    """
    number = dict(zip(SIGNS, [_shift(kinds, F.lit(_KIND_BITS * i)).bitwiseAND((1 << _KIND_BITS) - 1) for i in range(len(SIGNS))]))
    limit = {m: (math.log2(width) - expected_entropy(m, width) + SLACK) * width + 1e-9 for m in (16, 32, 64)}
    lower, upper = number["hex_lower"] + number["lower"], number["hex_upper"] + number["upper"]
    both = (F.least(lower, upper) >= 3) & ((number["digit"] >= 1) | (F.least(lower, upper) >= 5))
    one = (number["digit"] >= 2) & (lower + upper >= 2)
    plain = (F.least(lower, upper) == 0) & (number["other"] == 0)
    hexadecimal = number["lower"] + number["upper"] == 0
    return (total <= max(limit.values())) & (both | one) & (total <= F.when(plain & hexadecimal, limit[16]).when(plain, limit[32]).otherwise(limit[64]))


def high_entropy_parts(text: Column, width: int) -> Column:
    """Array of (from, to): the parts of ``text`` that windows of ``width`` signs with high entropy cover.

    The window slides by one sign. The counts of its signs and kinds, and the sum of
    ``c * log2(c)`` over signs, change only by the sign that leaves and the one that enters;
    time is linear in the text.
    """
    # What one more of a sign adds to the sum, by the count before.
    weight = [c * math.log2(c) if c else 0.0 for c in range(width + 1)]
    gain = F.array(*[F.lit(b - a) for a, b in zip(weight, weight[1:])])
    none = F.struct(F.lit(0).alias("long"), F.lit(0).alias("shift"), F.lit(0).cast("bigint").alias("bit"), F.lit(0).cast("bigint").alias("kind"))
    coded = _coded(F.filter(F.split(text, ""), lambda c: c != ""))
    # One more step than signs, in which the last window is judged.
    moves = F.zip_with(F.concat(F.array_repeat(none, width), coded), F.concat(coded, F.array(none)), lambda o, i: F.struct(o.alias("leaves"), i.alias("enters")))
    moves = F.filter(moves, lambda m: m["enters"].isNotNull())
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), -(-len(ALPHABET) // _PER_LONG)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).cast("bigint").alias("kinds"),
        F.lit(0).alias("at"), F.lit(0).alias("from"), F.lit(-1).alias("to"), F.array().cast("array<struct<from:int,to:int>>").alias("done"),
    )

    def step(acc: Column, move: Column) -> Column:
        leaves, enters, at = move["leaves"], move["enters"], acc["at"]
        hit = (at >= width) & _is_secret(acc["sum"], acc["kinds"], width)
        opens = (at - width > acc["to"]) & hit
        count = lambda sign: _shift(F.element_at(acc["counts"], sign["long"] + 1), sign["shift"]).bitwiseAND((1 << _BITS) - 1).cast("int")
        same = (leaves["long"] == enters["long"]) & (leaves["shift"] == enters["shift"]) & (leaves["bit"] > 0)
        less = F.when(leaves["bit"] > 0, F.element_at(gain, count(leaves))).otherwise(0.0)
        more = F.when(enters["bit"] > 0, F.element_at(gain, count(enters) + 1)).otherwise(0.0)
        counts = F.transform(acc["counts"], lambda c, i: c - F.when(i == leaves["long"], leaves["bit"]).otherwise(0) + F.when(i == enters["long"], enters["bit"]).otherwise(0))
        return F.struct(
            F.when(same, acc["counts"]).otherwise(counts).alias("counts"), F.when(same, acc["sum"]).otherwise(acc["sum"] - less + more).alias("sum"),
            (acc["kinds"] - leaves["kind"] + enters["kind"]).alias("kinds"), (at + 1).alias("at"),
            F.when(opens, at - width).otherwise(acc["from"]).alias("from"), F.when(hit, at).otherwise(acc["to"]).alias("to"),
            F.when(opens & (acc["to"] >= 0), F.concat(acc["done"], F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to"))))).otherwise(acc["done"]).alias("done"),
        )

    last = lambda acc: F.when(acc["to"] >= 0, F.concat(acc["done"], F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to"))))).otherwise(acc["done"])
    return F.aggregate(moves, start, step, last)


def _without(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of ``spans``, which are sorted by start."""
    start = F.struct(F.array().cast("array<struct<sign:boolean,n:int>>").alias("runs"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        runs = F.array(F.struct(F.lit(False).alias("sign"), F.greatest(s["start"].cast("int") - acc["at"], F.lit(0)).alias("n")), F.struct(F.lit(True).alias("sign"), F.greatest(s["end"].cast("int") - F.greatest(acc["at"], s["start"].cast("int")), F.lit(0)).alias("n")))
        return F.struct(F.concat(acc["runs"], runs).alias("runs"), F.greatest(acc["at"], s["end"].cast("int")).alias("at"))

    runs = F.aggregate(spans, start, step, lambda acc: acc["runs"])
    hidden = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["sign"], r["n"])))
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.zip_with(chars, hidden, lambda c, h: F.when(h, F.lit(" ")).otherwise(c)), "")


def find_secrets(docs: DataFrame, width: int = 20, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``doc_id`` and ``spans``: an array of (kind, start, end, match), by start, then kind as listed.

    Base spans follow :data:`PATTERNS`, leftmost and non-overlapping per kind; ``assign``
    needs 12 characters in its value, ``access`` 18 and ``hex`` 16. ``entropy`` spans are
    the parts of candidate runs that windows of ``width`` characters cover whose entropy is
    near that of random signs of their class (see :func:`high_entropy_parts`). Base spans
    are cut out of runs before; what is left of a run is searched if still as long as a
    window. A part that ``allowed`` matches, with up to ``width`` characters of the run on
    each side, adds none. Letters of one case without digits are words to this scan.

    One row per input row. A null text counts as empty and has no spans; ``doc_id`` may
    be null or repeat; time is linear in one long run. Further columns of ``docs`` are left out.
    """
    if not 2 <= width < 1 << _BITS:
        raise ValueError(f"width must be between 2 and {(1 << _BITS) - 1}")
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    hints = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{16}"}
    value = lambda m: F.regexp_extract(m, PATTERNS["assign"], 2)
    keep = {
        "assign": lambda s: F.length(value(s["match"])) >= 12,
        "access": lambda s: F.length(s["match"]) >= 18,
        "hex": lambda s: F.length(s["match"]) >= 16,
    }
    typed = lambda kind, rank: lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["match"].alias("match"))

    def search(rows: DataFrame, kind: str, text: str, there: Column) -> DataFrame:
        found, pieces = _matches(F.col(text), kind)
        empty = F.array().cast("array<string>")
        rows = rows.withColumn("has", there)
        rows = rows.withColumn("found", F.when(F.col("has"), found).otherwise(empty)).withColumn("pieces", F.when(F.col("has"), pieces).otherwise(empty))
        return rows.withColumn(kind, _spans(F.col("found"), F.col("pieces"))).drop("has", "found", "pieces")

    for rank, (kind, test) in enumerate(keep.items()):
        rows = search(rows, kind, "t", F.col("t").contains("AKIA") if kind == "access" else F.col("t").rlike(hints[kind]))
        rows = rows.withColumn(kind, F.transform(F.filter(F.col(kind), test), typed(kind, rank)))
    rows = rows.withColumn("base", F.array_sort(F.concat(*[F.col(k) for k in PATTERNS])))
    rows = rows.withColumn("left", F.when((F.size("base") > 0) & F.col("t").rlike(CANDIDATE), _without(F.col("t"), F.col("base"))).otherwise(F.col("t")))
    rows = search(rows, "entropy", "left", F.col("left").rlike(CANDIDATE)).select("doc_id", "base", "entropy")
    runs = F.filter("entropy", lambda s: s["match"].rlike(WORTH))
    parts = F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["match"].alias("match"), high_entropy_parts(s["match"], width).alias("parts")))

    def shown(s: Column) -> Column:
        cut = lambda at, to: F.substring(s["match"], at + 1, to - at)
        held = F.transform(
            s["parts"],
            lambda p: F.struct(
                (s["start"] + p["from"]).alias("start"), F.lit(3).alias("rank"), F.lit("entropy").alias("kind"), (s["start"] + p["to"]).alias("end"),
                cut(p["from"], p["to"]).alias("match"), cut(F.greatest(p["from"] - width, F.lit(0)), p["to"] + width).alias("near"),
            ),
        )
        harmless = lambda p: F.exists(F.array(*[p["near"].rlike(a) for a in allowed]), lambda x: x) if allowed else F.lit(False)
        return F.transform(F.filter(held, lambda p: ~harmless(p)), lambda p: F.struct(*[p[c].alias(c) for c in ("start", "rank", "kind", "end", "match")]))

    rows = rows.withColumn("parts", parts).withColumn("added", F.flatten(F.transform("parts", shown)))
    rows = rows.select("doc_id", F.array_sort(F.concat("base", "added")).alias("spans"))
    spans = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "match")]))
    # One array per row, as a generator: a filter on ``spans`` is not pushed into what finds them, which would repeat it many times.
    return rows.select("doc_id", F.explode(F.array(spans)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans, and all spans as text."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.col("spans")
    of_kind = lambda kind: F.filter(spans, lambda s: s["kind"] == kind)
    return found.select(
        "doc_id",
        *[F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(text(F.filter(spans, lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )
