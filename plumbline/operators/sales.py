"""Reports over cleaned sales.

Grouped reports take sales or a rollup from :func:`sales_rollup`. Where a limit
or an order could tie, the group key decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import numbers, times
from plumbline.operators.outliers import above_spread
from plumbline.operators.summaries import Rollup, growth, mean, row_count, summarise, total, value_count

ROLLUP_KEYS = ("region", "product", "channel", "year_month")
ROLLUP_MEASURES = ("revenue", "quantity", "discount_pct")


def sales_rollup(sales: DataFrame, digits: int | None = None) -> Rollup:
    """Partial results by region, product, channel and month: one scan serves the grouped reports."""
    return Rollup(summarise(sales, ROLLUP_KEYS, ROLLUP_MEASURES, digits))


def product_rollup(
    sales: DataFrame, products: DataFrame, measures: Sequence[str], keys: Sequence[str] = (), digits: int | None = None
) -> Rollup:
    """Partial results by product and ``keys`` of sales that carry only a ``part_key``.

    The sales are summed up by part first, so the join with ``products(part_key, product)``
    meets one row per part; sales of parts it does not list are left out.
    """
    by_part = summarise(sales, ["part_key", *keys], measures, digits)
    return Rollup(by_part.join(products.select("part_key", "product"), "part_key").drop("part_key"))


def total_revenue(sales: DataFrame, digits: int | None = None) -> DataFrame:
    """One row, also over an empty table."""
    return summarise(sales, [], ["revenue"], digits).select(
        total("revenue").alias("total_revenue"),
        row_count().alias("order_count"),
        mean("revenue").alias("avg_order_value"),
    )


def top_n_customers(sales: DataFrame, n: int = 10, digits: int | None = None) -> DataFrame:
    by_customer = summarise(sales, ["customer_id"], ["revenue"], digits).select(
        "customer_id",
        total("revenue").alias("total_revenue"),
        row_count().alias("order_count"),
        mean("revenue").alias("avg_order_value"),
    )
    return by_customer.orderBy(F.desc("total_revenue"), "customer_id").limit(int(n))


def monthly_growth_rate(sales: DataFrame, digits: int | None = None) -> DataFrame:
    """Revenue per month and its growth over the previous month present, from unrounded revenue."""
    by_month = summarise(sales, ["year_month"], ["revenue"], digits).select(
        "year_month", total("revenue").alias("revenue")
    )
    report = growth(by_month, "year_month", "revenue", "prev_revenue", "growth_pct")
    return report.select(
        "year_month",
        F.round("revenue", 2).alias("revenue"),
        F.round("prev_revenue", 2).alias("prev_revenue"),
        "growth_pct",
    ).orderBy("year_month")


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Customers per month of first purchase, and how many of them are active at any time.

    Every customer of a cohort has at least the purchase that formed it, so the
    active ones are counted from the cohort table itself, without a join back
    to the sales; a purchase without customer id counts in the size only, and
    months that are unknown form no cohort.
    """
    first = sales.groupBy("customer_id").agg(F.min(times.month_number("year_month")).alias("_month"))
    cohorts = (
        first.where(F.col("_month").isNotNull())
        .groupBy(times.month_text("_month").alias("cohort_month"))
        .agg(F.count("customer_id").alias("active_customers"), F.count(F.lit(1)).alias("cohort_size"))
    )
    return (
        cohorts.where("active_customers > 0")
        .withColumn("retention_pct", numbers.percent(F.col("active_customers"), F.col("cohort_size"), 1))
        .orderBy("cohort_month")
    )


def cohort_retention_by_offset(sales: DataFrame) -> DataFrame:
    """Share of each cohort that buys again N months after its first month.

    The sales shrink to one row per customer and month before anything is
    compared, so the window per customer holds months, not orders.
    """
    known = sales.where(F.col("customer_id").isNotNull() & F.col("year_month").isNotNull())
    active = known.select("customer_id", "year_month").distinct()
    first = F.min("year_month").over(Window.partitionBy("customer_id"))
    counts = (
        active.withColumn("cohort_month", first)
        .withColumn("month_offset", times.months_apart("cohort_month", "year_month"))
        .groupBy("cohort_month", "month_offset")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    at_start = F.when(F.col("month_offset") == 0, F.col("active_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return (
        counts.withColumn("cohort_size", size)
        .withColumn("retention_pct", numbers.percent(F.col("active_customers"), F.col("cohort_size"), 1))
        .orderBy("cohort_month", "month_offset")
    )


def revenue_anomalies(
    sales: DataFrame, std_multiplier: float = 2.0, limit: int | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Orders above mean + ``std_multiplier`` deviations, largest first; all columns, no limit by default."""
    found = above_spread(sales, "revenue", std_multiplier)
    ordered = found.orderBy(F.desc("revenue"), *(ties or [c for c in sales.columns if c != "revenue"]))
    return ordered if limit is None else ordered.limit(int(limit))


def revenue_by_product_region(
    sales: DataFrame | Rollup, regions: Sequence[str] | None = None, digits: int | None = None
) -> DataFrame:
    """Products by regions with revenue in the cells, zero where there is none, and a row total.

    Known ``regions`` save the job that looks them up. The pivot runs on one row
    per product and region, so a hot product is combined before it is shuffled.
    """
    cells = summarise(sales, ["product", "region"], ["revenue"], digits)
    cells = cells.select("product", "region", total("revenue").alias("revenue"))
    cells = cells.where(F.col("revenue").isNotNull())
    pivot = cells.groupBy("product").pivot("region", list(regions) if regions is not None else None)
    table = pivot.agg(F.sum("revenue")).fillna(0.0)
    names = [c for c in table.columns if c != "product"]
    row_total = F.lit(0.0)
    for name in names:
        row_total = row_total + F.col(f"`{name}`")
    return table.withColumn("grand_total", row_total).orderBy(F.desc("grand_total"), "product")


def _ranked(sales: DataFrame, key: str, columns: Sequence[Column], measures: Sequence[str], digits: int | None):
    """One row per key, largest revenue first."""
    report = summarise(sales, [key], measures, digits).select(key, *columns)
    return report.orderBy(F.desc("total_revenue"), key)


def revenue_by_region(sales: DataFrame, digits: int | None = None) -> DataFrame:
    columns = [
        row_count().alias("order_count"),
        total("revenue").alias("total_revenue"),
        mean("revenue").alias("avg_order_value"),
        total("quantity").alias("total_units"),
    ]
    return _ranked(sales, "region", columns, ["revenue", "quantity"], digits)


def top_products(sales: DataFrame | Rollup, top_n: int = 10, digits: int | None = None) -> DataFrame:
    columns = [
        row_count().alias("order_count"),
        total("revenue").alias("total_revenue"),
        mean("discount_pct").alias("avg_discount"),
    ]
    return _ranked(sales, "product", columns, ["revenue", "discount_pct"], digits).limit(int(top_n))


def revenue_by_channel(sales: DataFrame, digits: int | None = None) -> DataFrame:
    columns = [total("revenue").alias("total_revenue"), row_count().alias("order_count")]
    return _ranked(sales, "channel", columns, ["revenue"], digits)


def monthly_trend(sales: DataFrame, digits: int | None = None) -> DataFrame:
    by_month = summarise(sales, ["year_month"], ["revenue"], digits)
    return by_month.select(
        "year_month", total("revenue").alias("monthly_revenue"), row_count().alias("order_count")
    ).orderBy("year_month")


def summary_stats(sales: DataFrame, digits: int | None = None, approximate: bool = False) -> DataFrame:
    """Seven key figures in one row.

    The distinct counts are exact by default; ``approximate`` replaces them by
    HyperLogLog sketches, which need no second aggregation step.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    revenue = numbers.summable("revenue", digits)
    figures = sales.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(revenue).cast("double").alias("total_revenue"),
        F.count("revenue").alias("_n"),
        F.max("revenue").alias("max_order_value"),
        F.min("revenue").alias("min_order_value"),
        distinct("customer_id").alias("unique_customers"),
        distinct("product").alias("unique_products"),
    )
    average = F.try_divide(F.col("total_revenue"), F.col("_n")).alias("avg_order_value")
    return figures.select(
        "total_orders",
        "total_revenue",
        average,
        "max_order_value",
        "min_order_value",
        "unique_customers",
        "unique_products",
    )


def with_net_revenue(orders: DataFrame, discount: str = "discount") -> DataFrame:
    """Revenue after discount, unrounded."""
    return orders.withColumn("net_revenue", numbers.net_of_discount("revenue", discount))


def region_summary(net: DataFrame, digits: int | None = None) -> DataFrame:
    by_region = summarise(net, ["region"], ["net_revenue"], digits).select(
        "region", total("net_revenue").alias("net_revenue"), value_count("net_revenue").alias("order_count")
    )
    return by_region.orderBy(F.desc("net_revenue"), "region")


def product_summary(net: DataFrame | Rollup, digits: int | None = None) -> DataFrame:
    by_product = summarise(net, ["product"], ["net_revenue"], digits)
    report = by_product.select("product", total("net_revenue").alias("net_revenue"))
    return report.orderBy(F.desc("net_revenue"), "product")


def total_net_revenue(net: DataFrame, digits: int | None = None) -> DataFrame:
    return summarise(net, [], ["net_revenue"], digits).select(total("net_revenue").alias("total_net_revenue"))
