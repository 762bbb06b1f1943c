"""Bundles of reports over one table. All results are lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.operators import cleaning, pages, sales, trips
from plumbline.operators.summaries import Rollup, summarise
from plumbline.sources.files import write_jsonl


def trip_report(cleaned: DataFrame, digits: int | None = None) -> dict[str, DataFrame | Rollup]:
    """The five trip reports.

    The four grouped ones share a rollup that is persisted on first use; it has
    one row per hour, weekday and payment type. The caller may unpersist
    ``rollup`` when done.
    """
    rollup = trips.trip_rollup(cleaned, digits).persist()
    return {
        "rollup": rollup,
        "avg_fare_by_hour": trips.avg_fare_by_hour(rollup),
        "top_10_pickup_hours": trips.top_pickup_hours(rollup),
        "avg_duration_by_dow": trips.avg_duration_by_dow(rollup),
        "revenue_by_payment_type": trips.payment_breakdown(rollup),
        "fare_anomalies": trips.fare_anomalies(cleaned),
    }


def sales_report(cleaned: DataFrame, top_n: int = 10, digits: int | None = None) -> dict[str, DataFrame | Rollup]:
    """The sales reports, key figures and largest orders; grouped ones share a persisted rollup."""
    rollup = sales.sales_rollup(cleaned, digits).persist()
    return {
        "rollup": rollup,
        "revenue_by_region": sales.revenue_by_region(rollup),
        "top_products": sales.top_products(rollup, top_n),
        "monthly_trend": sales.monthly_trend(rollup),
        "revenue_by_channel": sales.revenue_by_channel(rollup),
        "summary_stats": sales.summary_stats(cleaned, digits),
        "anomalies": sales.revenue_anomalies(cleaned, 2.0, limit=20),
    }


def filtered_trip_summaries(raw: DataFrame, digits: int | None = None) -> dict[str, DataFrame | Rollup]:
    """Filtered trips and their two summaries; both summaries come from one rollup of the filtered trips."""
    filtered = trips.filtered_trips(raw)
    rollup = Rollup(summarise(filtered, ["hour_of_day", "payment_type"], ["fare_amount"], digits)).persist()
    return {
        "rollup": rollup,
        "filtered": filtered,
        "hourly_summary": trips.filtered_hourly_summary(rollup),
        "payment_summary": trips.filtered_payment_summary(rollup),
    }


def net_revenue_summaries(orders: DataFrame, discount: str = "discount", digits: int | None = None) -> dict[str, DataFrame | Rollup]:
    """Net revenue in total, by region and by product, from one persisted rollup."""
    net = sales.with_net_revenue(orders, discount)
    rollup = Rollup(summarise(net, ["region", "product"], ["net_revenue"], digits)).persist()
    return {
        "rollup": rollup,
        "total_revenue": sales.total_net_revenue(rollup),
        "region_summary": sales.region_summary(rollup),
        "product_summary": sales.product_summary(rollup),
    }


def build_dataset(crawl: DataFrame, path: str, base_url: str = "", mode: str = "overwrite", **options) -> None:
    """Crawl log to JSON lines: failed fetches dropped, each page read once."""
    records = pages.parse_pages(cleaning.drop_failed_pages(crawl), base_url, **options)
    write_jsonl(records, path, mode)
