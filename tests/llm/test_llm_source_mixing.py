"""Budgets of the tree, and the whole mix against SQL."""

from compare import difference, duckdb_connection
from fixtures_llm import documents, odd_rows

from plumbline.llm import source_mixing
from plumbline.llm.source_mixing import leaf_budgets, mix


def budgets(spark, leaves, weights, tenths=10, epochs=1):
    frame = spark.createDataFrame(leaves, "m_domain string, m_lang string, m_source string, leaf_tokens bigint")
    return {(r["m_domain"], r["m_lang"], r["m_source"]): r["budget"] for r in leaf_budgets(frame, weights, tenths, epochs).collect()}


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "x", "1", 10), ("a", "x", "2", 1000), ("b", "x", "3", 1000)]
    got = budgets(spark, leaves, {}, tenths=4)
    # 804 tokens: 402 each domain; source 1 has only 10, its sibling takes the rest.
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 392, ("b", "x", "3"): 402}


def test_shortage_of_a_family_goes_to_the_parents_siblings(spark):
    leaves = [("a", "x", "1", 10), ("a", "x", "2", 20), ("b", "x", "3", 1000)]
    assert budgets(spark, leaves, {}, tenths=5) == {("a", "x", "1"): 10, ("a", "x", "2"): 20, ("b", "x", "3"): 485}


def test_weights_and_epochs(spark):
    leaves = [("a", "x", "1", 100), ("a", "y", "1", 100), ("b", "x", "1", 1000)]
    got = budgets(spark, leaves, {"m_domain": {"a": 3}, "m_lang": {"y": 3}}, tenths=3, epochs=2)
    assert got == {("a", "x", "1"): 70, ("a", "y", "1"): 200, ("b", "x", "1"): 90}


def test_every_document_is_read_whole_epochs_and_a_prefix(spark):
    rows = documents(spark, [(i, "x" * 40, "en", "src1") for i in range(100)])
    got = mix(rows, tenths=10, max_epochs=3).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(100)) and {r["epoch"] for r in got} == {0}
    few = mix(rows, tenths=3).collect()
    assert len(few) == 30 and len({r["doc_id"] for r in few}) == 30
    assert {r["doc_id"] for r in few} != {r["doc_id"] for r in mix(rows, tenths=3, seed=18).collect()}


def test_awkward_rows_equal_sql(spark, folder):
    rows = documents(spark, odd_rows() + [(100 + i, "word " * (i % 50), "en" if i % 3 else None, f"src{i % 9}") for i in range(400)])
    rows.drop("score", "epoch").write.parquet(f"{folder}/documents.parquet")
    connection = duckdb_connection("/root/testdata/sf0.001")
    connection.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    for tenths in (3, 8, 10):
        query = lambda s, f, t=tenths: mix(s.read.parquet(f"{f}/documents.parquet"), tenths=t)
        assert difference(spark, connection, query, source_mixing.oracle(tenths=tenths), folder) is None
