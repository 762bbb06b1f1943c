"""The physical plans must stay the ones wanted at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from plumbline.operators import cleaning, pages, sales, trips
from plumbline.sources import bindings

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_cleaning_trips_shuffles_nothing_and_filters_in_the_scan(spark):
    text = plan(bindings.trips(spark, FOLDER))
    assert "Exchange" not in text and "Window" not in text
    assert "GreaterThanOrEqual(value,1.0)" in text and "LessThanOrEqual(value,500.0)" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(trips.hourly_revenue(bindings.trips(spark, FOLDER)))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<event_id:bigint,ts:timestamp_ntz,value:double>"]


def test_one_aggregation_shuffle_per_report(spark):
    text = plan(trips.avg_fare_by_hour(bindings.trips(spark, FOLDER)))
    assert text.count("partial_") >= 1 and len(re.findall(r"hashpartitioning\(hour_of_day", text)) == 1


@pytest.mark.parametrize("name", ["top_pickup_hours", "top_routes", "detect_anomalies", "top_n_customers", "top_products", "revenue_anomalies_top"])
def test_top_k_never_sorts_everything(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, FOLDER))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    lines = bindings.table(spark, FOLDER, "lineitem")
    text = plan(cleaning.dedupe(lines, ["l_orderkey"], ["l_linenumber"]))
    assert text.count("WindowGroupLimit") >= 2


def fact_shuffles(df):
    """Shuffles on the way from the scan of the order lines to the result, joins as sort-merge joins."""
    tree = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(tree) if "FileScan" in line and "l_orderkey" in line)
    level, count = depth(tree[at]), 0
    for line in reversed(tree[:at]):
        if depth(line) < level:
            level = depth(line)
            count += "Exchange hashpartitioning" in line
    return count


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        # Once by order; the second one of grouped reports moves one row per task and group.
        ("total_revenue", 1), ("total_net_revenue", 1), ("monthly_trend", 2), ("revenue_by_region", 2), ("revenue_by_channel", 2),
        ("monthly_growth_rate", 2), ("cohort_retention", 3), ("clean_sales", 2),
    ],
)
def test_order_lines_are_shuffled_once(spark, name, shuffles):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert fact_shuffles(__spark_entry__.queries()[name](spark, FOLDER)) == shuffles
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["detect_anomalies", "revenue_anomalies", "minmax_normalize", "zscore_normalize", "cohort_retention", "grid_edges", "clean_sales", "page_images"])
def test_no_cross_joins(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_statistics_are_computed_once_per_query(spark):
    df = trips.detect_anomalies(bindings.trips(spark, FOLDER))
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in text


def test_cohort_retention_does_not_join_the_sales_with_themselves(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("customer_id"), F.lit("2022-01").alias("year_month"))
    text = plan(sales.cohort_retention(df))
    assert "Join" not in text and "SortAggregate" not in text


def test_cohort_offsets_shrink_before_the_window(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("customer_id"), F.lit("2022-01").alias("year_month"))
    text = plan(sales.cohort_retention_by_offset(df))
    # Operators are numbered from the scan upwards.
    depth = {op: min(int(n) for n in re.findall(rf"\b{op} \((\d+)\)", text)) for op in ("HashAggregate", "Window")}
    assert depth["HashAggregate"] < depth["Window"]


def test_only_html_goes_to_python(spark):
    df = bindings.table(spark, FOLDER, "pages").select("page_id", "url", "html")
    text = plan(pages.extract_text(df))
    assert re.search(r"ArrowEvalPython.*\n(.*\n)*?Arguments: \[.*\(html", text)
    assert "MapInPandas" not in text


def test_registered_queries_have_no_limit_but_top_k(spark):
    df = bindings.cleaned_raw_sales(spark, FOLDER)
    assert "GlobalLimit" not in plan(df)
