"""The pipeline against brute-force versions of its stages."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from fixtures_llm import documents, odd_rows
from test_llm_jaccard_join import sets_of
from test_llm_line_dedup import brute as brute_lines

from plumbline import session
from plumbline.llm import decontaminate, language_id, line_dedup
from plumbline.llm.decontaminate import contained, question_and_answer, words_of

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name


def test_whole_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = language_id.learn(docs)
    rows = {d: t for d, t in rows.items() if (p := model.predict(t))[0] != "und" and p[1] >= corpus_pipeline.LEAST_SCORE}
    cleaned = brute_lines(sorted(rows.items()), line_dedup.MIN_WORDS)
    rows = {d: text for d, (text, removed) in cleaned.items() if not removed or text.strip()}
    order = sorted(rows)
    sets = sets_of([(d, rows[d]) for d in order], corpus_pipeline.SHINGLE_WORDS)
    group = {d: d for d in order}
    for i, a in enumerate(order):
        for j in range(i):
            b = order[j]
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= corpus_pipeline.SIMILAR_PERCENT * len(sets[i] | sets[j]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    rows = {d: rows[d] for d in order if group[d] == d}
    items = [question_and_answer(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = {d: t for d, t in rows.items() if not any(contained(q, w := words_of(t)) >= decontaminate.OVERLAP and contained(a, w) >= decontaminate.OVERLAP for q, a in items)}
    before_mixing = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before_mixing = spark.createDataFrame(stage(spark, before_mixing, FOLDER).collect(), docs.schema).coalesce(1)
    assert {r["doc_id"]: r["text"] for r in before_mixing.collect()} == rows
    mixed = corpus_pipeline.run(spark, FOLDER).collect()
    assert mixed and all(rows[r["doc_id"]] == r["text"] for r in mixed)
    total = sum((len(t.encode()) + 3) // 4 for t in rows.values())
    assert 0.6 * total < sum(r["tokens"] for r in mixed) <= 0.8 * total


def _stored(spark, folder, rows):
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "What is it? It is a thing."), (None, None), (2, "")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name", STAGES)
def test_empty_documents(spark, folder, name):
    docs = _stored(spark, folder, [])
    found = STAGES[name](spark, docs, folder)
    assert found.collect() == [] and (name == "mixing" or found.columns == docs.columns)


@pytest.mark.parametrize("name", STAGES)
def test_awkward_documents(spark, folder, name):
    """Nulls, repeated rows, ties, long texts and clashing names: rows that stay are as they were."""
    docs = _stored(spark, folder, odd_rows())
    got = STAGES[name](spark, docs, folder).collect()
    ids = sorted(str(r["doc_id"]) for r in got)
    if name == "mixing":
        assert set(ids) <= {"3", "4", "None", "5", "6", "7", "8"}
        return
    for row in docs.exceptAll(spark.createDataFrame(got, docs.schema)).collect():
        # Without text or letters there is no language; copies are 4 and 4, 6 and 7.
        assert name == "language" or (name == "lines" and row["doc_id"] == 4) or (name == "near_copies" and row["doc_id"] in (4, 7)), row
    want = sorted(str(r[0]) for r in odd_rows())
    if name == "near_copies":
        assert ids == sorted((Counter(want) - Counter(["4", "7"])).elements())
    elif name == "language":
        assert not {"1", "2", "3", "5"} & set(ids)
    elif name == "benchmark":
        assert ids == want


def test_shortened_documents_have_the_length_of_what_is_left(spark, folder):
    shared = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    docs = _stored(spark, folder, [(1, f"own one\n{shared}"), (2, f"own two\n{shared}\nend"), (3, "short"), (4, shared)])
    got = {r["doc_id"]: r for r in STAGES["lines"](spark, docs, folder).collect()}
    assert got[2]["text"] == "own two\nend" and 4 not in got
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_scratch_of_a_stage_goes_when_the_next_begins(spark, folder):
    docs = _stored(spark, folder, [(i, f"this is text number {i} and no other", "en", "s") for i in range(30)])
    before = set(session._scratch.get(spark.sparkContext.applicationId, ()))
    STAGES["lines"](spark, docs, folder).collect()
    made = set(session._scratch[spark.sparkContext.applicationId]) - before
    STAGES["mixing"](spark, docs, folder).collect()
    assert made and not made & set(session._scratch[spark.sparkContext.applicationId])
    assert not any(Path(p).exists() for p in made)


def test_near_copies_do_not_write_the_documents_again(spark, folder):
    docs = _stored(spark, folder, [(i, "one text that is long enough for shingles", "en", "s") for i in range(9)])
    found = STAGES["near_copies"](spark, docs, folder)
    assert any(f.endswith(".parquet") and "documents.parquet" in f for f in found.inputFiles())
    assert [r["doc_id"] for r in found.collect()] == [0]
