import pytest
from pyspark.sql import functions as F

from plumbline.operators import sales
from plumbline.operators.cleaning import clean_sales
from plumbline.plans import reports
from plumbline.sources import bindings, synthetic

SCHEMA = (
    "order_id string, year_month string, region string, product string, channel string, quantity double, "
    "discount_pct double, customer_id string, revenue double"
)
FOLDER = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def order(n, month="2022-01", region="N", product="P", channel="web", customer="a", revenue=10.0, quantity=1.0, discount=0.1):
    return (str(n), month, region, product, channel, quantity, discount, customer, revenue)


@pytest.fixture(scope="module")
def few(spark):
    return table(
        spark,
        [
            order(1, revenue=10.0),
            order(2, "2022-02", "S", "Q", "shop", "b", 30.0, 2.0, 0.3),
            order(3, "2022-04", "N", "Q", "web", "a", 20.0, 3.0, 0.2),
            order(4, "2022-04", "N", "P", "web", "c", 40.0),
        ],
    ).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_total_revenue(spark, few):
    assert rows(sales.total_revenue(few)) == [(100.0, 4, 25.0)]
    assert rows(sales.total_revenue(table(spark, []))) == [(None, 0, None)]
    assert rows(sales.total_revenue(sales.sales_rollup(table(spark, [])))) == [(None, 0, None)]


def test_top_n_customers_ties_by_key(few):
    assert rows(sales.top_n_customers(few, 2)) == [("c", 40.0, 1, 40.0), ("a", 30.0, 2, 15.0)]


def test_monthly_growth_rate(spark, few):
    assert rows(sales.monthly_growth_rate(few)) == [
        ("2022-01", 10.0, None, None),
        ("2022-02", 30.0, 10.0, 200.0),
        ("2022-04", 60.0, 30.0, 100.0),
    ]
    zero = table(spark, [order(1, revenue=0.0), order(2, "2022-02", revenue=5.0)])
    assert rows(sales.monthly_growth_rate(zero)) == [("2022-01", 0.0, None, None), ("2022-02", 5.0, 0.0, None)]


def test_cohort_retention_is_always_complete(few):
    assert rows(sales.cohort_retention(few)) == [("2022-01", 1, 1, 100.0), ("2022-02", 1, 1, 100.0), ("2022-04", 1, 1, 100.0)]


def test_cohort_of_orders_without_customer(spark):
    df = table(spark, [order(1), order(2, customer=None), order(3, "2022-02", customer=None), order(4, None, customer="x")])
    # The unknown customer has one cohort, January; unknown months form none.
    assert rows(sales.cohort_retention(df)) == [("2022-01", 1, 2, 50.0)]


def test_cohort_retention_by_offset(spark):
    df = table(
        spark,
        [order(1, "2021-12"), order(2, "2022-01"), order(3, "2022-01"), order(4, "2021-12", customer="b"), order(5, "2022-01", customer="c")],
    )
    assert rows(sales.cohort_retention_by_offset(df)) == [
        ("2021-12", 0, 2, 2, 100.0),
        ("2021-12", 1, 1, 2, 50.0),
        ("2022-01", 0, 1, 1, 100.0),
    ]


def test_revenue_anomalies(spark):
    df = table(spark, [order(i) for i in range(50)] + [order(90, revenue=500.0), order(91, revenue=400.0)])
    got = sales.revenue_anomalies(df)
    assert got.columns == df.columns
    assert [r.revenue for r in got.collect()] == [500.0, 400.0]
    assert [r.revenue for r in sales.revenue_anomalies(df, limit=1).collect()] == [500.0]


def test_pivot_fills_gaps_and_sums_rows(few):
    expected = [("P", 50.0, 0.0, 50.0), ("Q", 20.0, 30.0, 50.0)]
    assert rows(sales.revenue_by_product_region(few)) == expected
    assert rows(sales.revenue_by_product_region(few, regions=["N", "S"], digits=6)) == expected


def test_rankings(few):
    assert rows(sales.revenue_by_region(few)) == [("N", 3, 70.0, pytest.approx(70 / 3), 5.0), ("S", 1, 30.0, 30.0, 2.0)]
    assert rows(sales.top_products(few, 1)) == [("P", 2, 50.0, 0.1)]
    assert rows(sales.revenue_by_channel(few)) == [("web", 70.0, 3), ("shop", 30.0, 1)]
    assert rows(sales.monthly_trend(few)) == [("2022-01", 10.0, 1), ("2022-02", 30.0, 1), ("2022-04", 60.0, 2)]


def test_summary_stats(few):
    assert rows(sales.summary_stats(few)) == [(4, 100.0, 25.0, 40.0, 10.0, 3, 2)]
    assert rows(sales.summary_stats(few, approximate=True)) == [(4, 100.0, 25.0, 40.0, 10.0, 3, 2)]


def test_net_revenue_summaries(few):
    bundle = reports.net_revenue_summaries(few, "discount_pct", digits=6)
    assert rows(bundle["total_revenue"]) == [(9 + 21 + 16 + 36,)]
    assert rows(bundle["region_summary"]) == [("N", 61.0, 3), ("S", 21.0, 1)]
    assert rows(bundle["product_summary"]) == [("P", 45.0), ("Q", 37.0)]
    bundle["rollup"].unpersist()


def test_properties_over_bound_sales(spark):
    df = bindings.sales_with_product(spark, FOLDER).cache()
    cohorts = rows(sales.cohort_retention(df))
    assert {c[3] for c in cohorts} == {100.0}
    assert sum(c[2] for c in cohorts) == df.select("customer_id").distinct().count()
    bundle = reports.sales_report(df, digits=6)
    for name, direct in {
        "revenue_by_region": sales.revenue_by_region(df, digits=6),
        "top_products": sales.top_products(df, digits=6),
        "monthly_trend": sales.monthly_trend(df, digits=6),
        "revenue_by_channel": sales.revenue_by_channel(df, digits=6),
        "summary_stats": sales.summary_stats(df, digits=6),
        "anomalies": sales.revenue_anomalies(df, 2.0, limit=20),
    }.items():
        assert rows(bundle[name]) == rows(direct), name
    bundle["rollup"].unpersist()


def test_synthetic_sales(spark):
    made = synthetic.synthetic_sales(spark, 4000).cache()
    assert 4000 < made.count() < 4060
    assert 30 < made.where("revenue IS NULL").count() < 140
    assert 10 < made.where("region IS NULL").count() < 90
    exact = made.where("revenue IS NOT NULL AND abs(revenue - quantity * unit_price * (1 - discount_pct)) > 0.00501")
    assert exact.isEmpty()
    assert made.where("order_id = 'ORD-000042'").count() >= 1
    cleaned = clean_sales(made)
    ids = made.groupBy("order_id").agg(F.max(F.col("revenue").isNotNull() & F.col("region").isNotNull()).alias("good"))
    assert cleaned.count() == ids.where("good").count()  # copies are identical


def test_synthetic_orders(spark):
    df = synthetic.synthetic_orders(spark, 1000)
    bundle = reports.net_revenue_summaries(df)
    parts = [r.net_revenue for r in bundle["product_summary"].collect()]
    assert len(parts) == 20 and sum(parts) == pytest.approx(bundle["total_revenue"].first()[0])
    bundle["rollup"].unpersist()
