import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.operators.sampling import bottom_k


def smallest(keys, k, seed=42):
    return sorted(keys, key=lambda x: (hashlib.md5(f"{seed}:{x}".encode()).hexdigest(), x))[:k]


@pytest.mark.parametrize("k", [0, 1, 250, 4999, 5000, 9000])
def test_exact_size_whatever_the_partitioning(spark, k):
    frame = spark.range(5000)
    want = smallest(range(5000), k)
    for parts in (1, 7, 64):
        got = [r.id for r in bottom_k(frame.repartition(parts), k, "id").collect()]
        assert sorted(got) == sorted(want), parts
    assert [r.id for r in bottom_k(frame, 5, "id", seed=1).collect()] == smallest(range(5000), 5, 1)


def test_repeated_and_null_keys(spark):
    frame = spark.range(3000).select(F.lit("same").alias("key"), "id")
    assert sorted(r.id for r in bottom_k(frame, 40, "key", ties=["id"]).collect()) == list(range(40))
    nulls = spark.range(500).select(F.lit(None).cast("string").alias("key"), "id")
    assert bottom_k(nulls, 7, "key").count() == 7
    assert bottom_k(nulls.limit(0), 7, "key").count() == 0
    with pytest.raises(ValueError):
        bottom_k(nulls, -1, "key")


def test_only_rows_under_the_cut_are_sorted(spark):
    frame = spark.range(200_000)
    chosen = bottom_k(frame, 1000, "id")
    text = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in text and "Sort" in text and text.index("Sort") < text.index("Filter")
    assert chosen.count() == 1000
