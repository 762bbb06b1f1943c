"""Personal data in text, replaced by surrogates of the same kind.

Entities are found by pattern, reduced to a normal form, and given a surrogate derived from
a secret key, so that every mention of an entity, in any text and any notation, gets the
same one. Digits become digits, letters become letters of the same script, case and kind
(vowel or consonant); given names become other names of the same gender; card numbers keep
a right or wrong check digit; addresses keep their shape. Surrogates that two entities
share, or that occur as an entity themselves, are drawn again until none is left; forms
with too few surrogates of their own shape get longer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import row_ids, settled

KEY = "plumbline"
# Given names by gender; a name's surrogate is another name of its list. Fixed values.
NAMES = {
    "f": ("Alice", "Anna", "Beatriz", "Carmen", "Claire", "Elena", "Emma", "Greta", "Helena", "Ingrid", "Julia", "Laura", "Lucía", "Maria", "Nora", "Sofia", "Анна", "Елена", "Мария", "Ольга"),
    "m": ("Albert", "Carlos", "Daniel", "David", "Emil", "Felix", "Hans", "Hugo", "James", "Javier", "Karl", "Louis", "Martin", "Michael", "Oscar", "Paul", "Андрей", "Дмитрий", "Иван", "Сергей"),
}
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин")

_octet = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_name = r"\p{Lu}[\p{L}'’-]+"
# Patterns by kind; where several fit at one place, the first kind wins. Fixed values.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_octet}(?:\.{_octet}){{3}}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|(?<=\+[0-9]{1,3}[ .-]?)[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){2,4})(?![0-9])",
    "person": rf"(?<![\p{{L}}])(?:{'|'.join(FEMALE_TITLES + MALE_TITLES)})\.? {_name}(?: {_name})?",
}
# Where an address may begin: at the start of its run of characters or right after another match. From
# any other place it would read the same run again, in time quadratic in a run without @.
_starts = {"email": r"(?:(?<![A-Za-z0-9._%+-])|\G)"}
PATTERN = "|".join(f"(?:{_starts.get(k, '')}{p})" for k, p in KINDS.items())
# Letters in rows of (vowels, consonants) per script; a letter only becomes one of its row. Fixed values.
ALPHABETS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûü", "çñß", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜ", "ÇÑ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "āăąēĕėęěĩīĭįōŏőũūŭůűųýÿ", "ćĉċčďđĝğġģĥħĵķĺļľłńņňŕŗřśŝşšţťŵźżž", "ĀĂĄĒĔĖĘĚĨĪĬĮŌŎŐŨŪŬŮŰŲÝŸ", "ĆĈĊČĎĐĜĞĠĢĤĦĴĶĹĻĽŁŃŅŇŔŖŘŚŜŞŠŢŤŴŹŻŽ",
    "ёєії", "ёєії".upper(), "άέήίόύώ", "ΆΈΉΊΌΎΏ",
)
# Other letters become one of these, by case.
FALLBACK = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# From this attempt on a surrogate gets one more keyed sign per attempt, of 16 by script. Fixed values.
WIDEN = 3
EXTRA = {"digit": "0123456789012345", "latin": "aeioubcdlmnprstv", "cyrillic": "аеиоубвдклмнпрст", "greek": "αεηιοβγδκλμνπρστ"}


def _kind(mention: Column) -> Column:
    chosen = F.lit("person")
    for kind in reversed([k for k in KINDS if k != "person"]):
        chosen = F.when(mention.rlike(rf"\A(?:{KINDS[kind]})\z"), F.lit(kind)).otherwise(chosen)
    return chosen


def _title(mention: Column) -> Column:
    return F.regexp_extract(mention, r"\A([^ ]+ )", 1)


def normal_form(kind: Column, mention: Column) -> Column:
    """What all notations of an entity have in common: its digits, its lower-case address, its name."""
    alnum = F.upper(F.regexp_replace(mention, r"[^0-9A-Za-z]", ""))
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "ip", mention)
        .when(kind == "person", F.regexp_replace(mention, r"\A[^ ]+ ", ""))
        .otherwise(alnum)
    )


def _digest(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")), 256)


def _draw(digest: Column, i: Column, n: int | Column) -> Column:
    """The i-th number below n that a digest holds; from the 49th on digests of the digest."""
    more = F.when(i < 49, digest).otherwise(F.sha2(F.concat(digest, F.floor(i / 49).cast("string")), 256))
    return (F.conv(F.substring(more, (F.pmod(i, F.lit(49)) + 1).cast("int"), F.lit(6)), 16, 10).cast("bigint") % n).cast("int")


def _letters(text: Column, digest: Column, first: int | Column = 0) -> Column:
    """Every letter and digit by another draw from its own row; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        i = i.cast("bigint") + first
        out = F.when(c.rlike(r"\A[0-9]\z"), _draw(digest, i, 10).cast("string"))
        for row in ALPHABETS:
            out = out.when(F.lit(row).contains(c), F.substring(F.lit(row), _draw(digest, i, len(row)) + 1, F.lit(1)))
        for kind, row in zip((r"\A\p{Lu}\z", r"\A\p{L}\z"), FALLBACK):
            out = out.when(c.rlike(kind), F.substring(F.lit(row), _draw(digest, i, len(row)) + 1, F.lit(1)))
        return out.otherwise(c)

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, one), "")


def _extra(kind: Column, norm: Column, digest: Column, attempt: Column) -> Column:
    """What makes a surrogate longer, so that there are more of them: nothing before attempt ``WIDEN``."""
    hexed = F.substring(F.sha2(F.concat(digest, F.lit("+")), 256), F.lit(1), F.greatest(attempt - (WIDEN - 1), F.lit(0)))
    signs = {script: F.translate(hexed, "0123456789abcdef", row) for script, row in EXTRA.items()}
    named = F.when(norm.rlike(r"\p{IsCyrillic}"), signs["cyrillic"]).when(norm.rlike(r"\p{IsGreek}"), signs["greek"]).otherwise(signs["latin"])
    return F.when(kind == "person", named).when(kind == "email", signs["latin"]).otherwise(signs["digit"])


def _luhn_sum(digits: Column) -> Column:
    """Check sum of digits that lack the check digit in last place."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b)


def _other_name(name: Column, key: str) -> Column:
    """The name at a keyed distance in the list of its gender and script, null for unknown names."""
    chosen = F.lit(None).cast("string")
    for gender, names in NAMES.items():
        for cyrillic in (False, True):
            pool = [n for n in names if ("А" <= n[0] <= "я") == cyrillic]
            at = F.array_position(F.array(*map(F.lit, pool)), name).cast("int")
            turn = _draw(F.sha2(F.lit(f"{key}:{gender}:{cyrillic}"), 256), F.lit(0), len(pool) - 1) + 1
            chosen = F.when(at > 0, F.element_at(F.array(*map(F.lit, pool)), (at - 1 + turn) % len(pool) + 1)).otherwise(chosen)
    return chosen


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The normal form that stands for ``norm``."""
    digest = _digest(kind, norm, attempt, key)
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    top = F.substring_index(domain, ".", -1)
    hosts = F.regexp_replace(domain, r"\.[^.]+\z", "")
    extra = _extra(kind, norm, digest, attempt)
    email = F.concat(_letters(local, digest), extra, F.lit("@"), _letters(hosts, digest, 100), F.lit("."), top)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_draw(digest, i.cast("bigint") * 7, 254) + 1).cast("string"))
    body = F.substring(norm, 1, 15)
    drawn = F.concat(F.substring(norm, 1, 1), F.substring(_letters(body, digest), 2, 14))
    # The distance of the check digit from the right one stays, so valid numbers stay valid.
    gap = F.substring(norm, 16, 1).cast("int") + _luhn_sum(body)
    check = F.pmod(gap - _luhn_sum(drawn), F.lit(10))
    given, rest = F.substring_index(norm, " ", 1), F.when(norm.contains(" "), F.regexp_replace(norm, r"\A[^ ]+", "")).otherwise(F.lit(""))
    # The last letter of an unlisted name often shows gender and stays.
    spelled = lambda n, at: F.concat(_letters(F.regexp_replace(n, r"(?s).\z", ""), digest, at), F.regexp_extract(n, r"(?s)(.)\z", 1))
    known = _other_name(given, key)
    person = F.when(known.isNotNull() & (rest == ""), F.when(attempt == 0, known).otherwise(spelled(given, 0))).otherwise(F.concat(F.coalesce(known, spelled(given, 0)), spelled(rest, 50)))
    other = _letters(norm, digest)
    country = F.concat(F.substring(norm, 1, 2), F.regexp_replace(other, r"\A..", ""))
    return (
        F.when(kind == "email", email).when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", F.concat(drawn, check.cast("string"))).when(kind == "iban", country)
        .when(kind == "person", F.concat(person, extra)).otherwise(F.concat(other, extra))
    )


def in_notation(kind: Column, mention: Column, stand_in: Column) -> Column:
    """``stand_in`` written as ``mention`` is: separators, titles and capitals in their places, longer ones whole."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    new = F.filter(F.split(stand_in, ""), lambda c: c != "")
    signs = F.transform(chars, lambda c: F.when(c.rlike(r"\A[0-9A-Za-z]\z"), F.lit(1)).otherwise(F.lit(0)))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["s"]
        drawn = F.element_at(new, F.greatest(at, F.lit(1)))
        shown = F.when(x["c"].rlike(r"\A[a-z]\z"), F.lower(drawn)).otherwise(drawn)
        return F.struct(F.concat(acc["out"], F.when(x["s"] == 1, shown).otherwise(x["c"])).alias("out"), at.alias("at"))

    spread = F.aggregate(F.zip_with(chars, signs, lambda c, s: F.struct(c.alias("c"), s.alias("s"))), start, step, lambda acc: acc["out"])
    spread = F.concat(spread, F.substring(stand_in, F.aggregate(signs, F.lit(1), lambda n, s: n + s), F.length(stand_in)))
    # A longer address has its additional letters before the @, as many as it is longer.
    local, host = F.substring_index(mention, "@", 1), F.substring_index(mention, "@", -1)
    chars = F.when(kind == "email", F.filter(F.split(F.concat(local, F.repeat(F.lit("."), F.greatest(F.length(stand_in) - F.length(mention), F.lit(0))), F.lit("@"), host), ""), lambda c: c != "")).otherwise(chars)
    cased = F.array_join(F.zip_with(chars, new, lambda c, n: F.when(c.rlike(r"\A\p{Lu}\z"), F.upper(n)).otherwise(n)), "")
    return F.when(kind == "person", F.concat(_title(mention), stand_in)).when(kind == "email", cased).when(kind == "ip", stand_in).otherwise(spread)


def _distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, stand_in) with stand-ins that are distinct per kind and no entity themselves."""
    drawn = lambda frame: settled(frame.withColumn("stand_in", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "surrogates")
    held = drawn(entities.withColumn("attempt", F.lit(0)))
    taken = entities.select(F.col("kind").alias("k"), F.col("norm").alias("t"))
    while True:
        # The entity that got a stand-in first keeps it, the smallest of several.
        owners = held.groupBy("kind", "stand_in").agg(F.min(F.struct("attempt", "norm")).alias("owner"))
        checked = held.join(owners, ["kind", "stand_in"]).join(taken, (F.col("kind") == F.col("k")) & (F.col("stand_in") == F.col("t")), "left")
        free = (F.col("owner.norm") == F.col("norm")) & F.col("t").isNull()
        checked = settled(checked.select("kind", "norm", "attempt", "stand_in", free.alias("free")), "checked")
        if checked.where("NOT free").isEmpty():
            return checked.select("kind", "norm", "stand_in")
        again = checked.where("NOT free").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        held = settled(checked.where("free").select("kind", "norm", "attempt", "stand_in").unionByName(drawn(again)), "surrogates")


def replace_pii(docs: DataFrame, key: str = KEY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``text`` with surrogates for entities, and ``n_entities``, the mentions replaced.

    Kinds and patterns are those of :data:`KINDS`. The same ``key`` gives the same
    surrogates for the same set of entities. Null texts stay null with 0 mentions; texts
    without entities are unchanged; time is linear in one long run of
    characters without @. Null and repeated ``doc_id`` stay rows of their own. Columns of ``docs`` not in ``keep`` are left out.
    """
    hidden = [F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    rows = row_ids(docs, F.col("text"), *hidden)
    hint = F.col("text").rlike(r"[0-9@]|" + "|".join(FEMALE_TITLES + MALE_TITLES))
    listed = rows.where(hint).select("row_id", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), 0)).alias("at", "mention"))
    listed = listed.withColumn("kind", _kind(F.col("mention")))
    mentions = settled(listed.withColumn("norm", normal_form(F.col("kind"), F.col("mention"))), "mentions")
    stand_ins = _distinct_surrogates(mentions.select("kind", "norm").distinct(), key)
    written = mentions.join(stand_ins, ["kind", "norm"]).select("row_id", F.struct("at", in_notation(F.col("kind"), F.col("mention"), F.col("stand_in")).alias("new")).alias("m"))
    by_row = written.groupBy(F.col("row_id").alias("r")).agg(F.sort_array(F.collect_list("m")).alias("found"))
    rows = rows.join(by_row, F.col("row_id") == F.col("r"), "left")
    pieces = F.split("text", PATTERN, -1)
    filled = F.array_join(F.zip_with(pieces, F.col("found.new"), lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    return rows.select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.when(F.col("found").isNull(), F.col("text")).otherwise(filled).alias("text"),
        F.when(F.col("found").isNull(), F.lit(0)).otherwise(F.size("found")).cast("bigint").alias("n_entities"),
    )
