"""Row ids when later scans of the input are cut otherwise, as on a cluster that gains or loses executors."""

import corpus_pipeline
import pytest
from fixtures_llm import documents

from plumbline.llm import jaccard_join, line_dedup, pii, topk_search

CUT = "spark.sql.files.openCostInBytes"
RUN = "\n".join(f"line {i} " + "word " * 12 for i in range(8))


@pytest.fixture
def recut(spark, monkeypatch):
    """From the first scratch table on, each file is a partition of its own."""

    def start(*modules):
        for module in modules:
            def cut(frame, name, write=module.settled):
                spark.conf.set(CUT, "1")
                held = write(frame, name)
                spark.conf.set(CUT, "128m")
                return held

            monkeypatch.setattr(module, "settled", cut)

    spark.conf.set(CUT, "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield start
    for name in (CUT, "spark.sql.files.minPartitionNum"):
        spark.conf.unset(name)


def stored(frame, folder):
    frame.repartitionByRange(4, frame.columns[0]).write.parquet(f"{folder}/in")
    return frame.sparkSession.read.parquet(f"{folder}/in")


def by_id(frame, *columns):
    return {r[0]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_lines_and_near_copies(spark, folder, recut):
    texts = {i: f"own text {i} " + " ".join(f"w{i * 100 + j}" for j in range(20)) for i in range(40)}
    texts |= {7: RUN + "\nseven", 31: "x\n" + RUN, 33: texts[3], 20: ""}
    docs = stored(documents(spark, sorted(texts.items())), folder)
    recut(line_dedup, jaccard_join, corpus_pipeline)
    got = by_id(line_dedup.dedup_lines(docs), "text")
    assert {d: t for d, (t,) in got.items()} == texts | {31: "x"} | {33: texts[3]}
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, folder).collect()}
    assert kept == set(texts) - {31, 33}
    found = by_id(jaccard_join.jaccard_components(docs), "n_shingles", "component_id")
    assert {d: c for d, (_, c) in found.items()} == {d: {31: 7, 33: 3}.get(d, d) for d in texts} and [d for d, (n, _) in found.items() if not n] == [20]


def test_surrogates(spark, folder, recut):
    texts = {i: f"text {i} " + (f"mail to user{i}@example.com now" if i % 3 == 0 else "") for i in range(40)}
    docs = stored(documents(spark, sorted(texts.items())), folder)
    recut(pii)
    for doc, (text, n) in by_id(pii.replace_pii(docs), "text", "n_entities").items():
        assert n == (doc % 3 == 0) and text.startswith(f"text {doc} ") and ("@" in text) == (doc % 3 == 0) and f"user{doc}@" not in text


def test_nearest(spark, folder, recut):
    rows = [(i, [float(i % 7), float(i % 11), 1.0 + i]) for i in range(60)]
    vectors = stored(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), folder)
    recut(topk_search)
    for row in topk_search.nearest(vectors, every=10, k=3, shard_rows=8).collect():
        assert row["query_id"] != row["vec_id"]
