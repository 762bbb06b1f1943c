"""Surrogates: kinds, notation, coreference and distinctness."""

import re

from fixtures_llm import documents
from pyspark.sql import functions as F

from plumbline.llm import pii

FOLDER = "/root/testdata/sf0.01"


def replaced(spark, texts):
    return [r["text"] for r in pii.replace_pii(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10


def shape(text):
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text)))


def test_table_keeps_everything_but_entities(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = pii.replace_pii(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    pattern = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+\d \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d])")
    stand_ins, seen = {}, 0
    for row in rows:
        old, new = texts[row["doc_id"]], row["text"]
        if not row["n_entities"]:
            assert old == new
            continue
        before, after = pattern.findall(old), pattern.findall(new)
        assert len(before) == len(after) == row["n_entities"] and pattern.split(old) == pattern.split(new)
        for a, b in zip(before, after):
            assert a != b and stand_ins.setdefault(a, b) == b
            assert re.fullmatch(r"[\d.]+", a) and "." in a or shape(a) == shape(b)
            if re.fullmatch(r"\d{16}", a):
                assert luhn(a) == luhn(b)
            seen += 1
    assert seen > 20 and len(set(stand_ins.values())) == len(stand_ins) and not set(stand_ins) & set(stand_ins.values())


def test_notations_of_one_entity(spark):
    a, b, c, d = replaced(spark, ["call +1 (017) 555-7713", "card 4417744280351547 x", "card 4417-7442-8035-1547", "Bob.X@Mail.example.com or bob.x@mail.EXAMPLE.com"])
    assert re.fullmatch(r"call \+\d \(\d{3}\) \d{3}-\d{4}", a) and "555-7713" not in a
    assert re.sub(r"\D", "", b) == re.sub(r"\D", "", c) and re.fullmatch(r"card \d{4}-\d{4}-\d{4}-\d{4}", c)
    first, second = d.split(" or ")
    assert first.lower() == second.lower() and first[0].isupper() and "." in first and first.lower() != "bob.x@mail.example.com"


def test_names_keep_gender_script_and_case(spark):
    texts = ["Mrs. Anna met Mr. Paul Miller", "Frau Anna", "Mr Paul Miller", "Госпожа Анна Петрова", "Herr Paul"]
    got = replaced(spark, texts)
    women, men = pii.NAMES["f"], pii.NAMES["m"]
    anna, paul = re.fullmatch(r"Mrs\. (\w+) met Mr\. (\w+ \w+)", got[0]).groups()
    assert anna in women and anna != "Anna" and got[1] == f"Frau {anna}"
    assert got[2] == f"Mr {paul}" and paul.split()[0] in men and "Miller" not in paul
    given, family = re.fullmatch(r"Госпожа (\w+) (\w+)", got[3]).groups()
    assert given in women and given != "Анна" and all("А" <= x <= "я" for x in given + family) and family[0].isupper()
    assert got[4].startswith("Herr ") and got[4] != "Herr Paul"


def test_collisions_are_drawn_again(spark, monkeypatch):
    # One digit leaves ten surrogates, so first draws collide and may hit entities.
    norms = [f"{i}" for i in range(9)]
    entities = spark.createDataFrame([("phone", f"{n}77") for n in norms], "kind string, norm string")
    got = {r["norm"]: r["stand_in"] for r in pii._distinct_surrogates(entities, "k").collect()}
    assert len(set(got.values())) == 9 and not set(got) & set(got.values())


def test_key_changes_surrogates_and_nothing_else_does(spark):
    docs = documents(spark, [(1, "x 97.51.17.173 y"), (2, None), (3, "")])
    texts = lambda key: [r["text"] for r in pii.replace_pii(docs, key=key).orderBy("doc_id").collect()]
    assert texts("a") == texts("a") != texts("b") and texts("a")[1:] == [None, ""]
    assert pii.replace_pii(docs).where(F.col("n_entities") > 0).count() == 1


def test_forms_with_few_surrogates_of_their_own(spark):
    names = ["Žo", "Ło", "Ёж", "Աննա", "Ｂｏ", "Al", "El", "Ol", "Il", "Ul"]
    norms = [("person", n) for n in names] + [("email", "--@--.com"), ("phone", "77")] + [("phone", f"7{i}") for i in range(7)]
    entities = spark.createDataFrame(sorted(set(norms)), "kind string, norm string")
    got = {(r["kind"], r["norm"]): r["stand_in"] for r in pii._distinct_surrogates(entities, "k").collect()}
    assert set(got) == set(norms) and len({(k, v) for (k, _), v in got.items()}) == len(got)
    assert not {(k, v) for (k, _), v in got.items()} & set(got)
    texts = [f"Mr {n} came" for n in names] + ["write to --@--.com or --@--.COM"]
    new = replaced(spark, texts)
    assert len(set(new[:-1])) == len(names) and not set(new) & set(texts)
    first, second = re.fullmatch(r"write to (\S+) or (\S+)", new[-1]).groups()
    assert first.lower() == second.lower() and re.fullmatch(pii.KINDS["email"], first)


def test_addresses_side_by_side(spark):
    texts = ["x@y.com-z@w.org", "1.2.3.4a@b.com", "--ab@cd.org,ef@cd.org"]
    for old, new in zip(texts, replaced(spark, texts)):
        assert shape(old) == shape(new) and not set(re.findall(r"[\w.-]+@\w+", old)) & set(re.findall(r"[\w.-]+@\w+", new))


def test_very_long_runs(spark):
    texts = ["a" * 1_000_000, "a.1-" * 250_000 + " ab@cd.org", "7" * 1_000_000]
    new = replaced(spark, texts)
    assert new[0] == texts[0] and new[2] == texts[2] and "ab@cd.org" not in new[1] and len(new[1]) == len(texts[1])
