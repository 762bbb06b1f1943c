"""Reports over cleaned trips.

Grouped reports take trips or a rollup from :func:`trip_rollup`. Where a limit or
an order could tie, the group key decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numbers, times
from plumbline.operators import cleaning
from plumbline.operators.outliers import above_spread
from plumbline.operators.summaries import Rollup, growth, mean, row_count, share_of_rows, summarise, total, value_count

ROLLUP_KEYS = ("hour_of_day", "day_of_week", "payment_type")
ROLLUP_MEASURES = ("fare_amount", "trip_distance", "trip_duration_mins")


def trip_rollup(trips: DataFrame, digits: int | None = None) -> Rollup:
    """Partial results by hour, weekday and payment type: one scan serves all grouped reports."""
    return Rollup(summarise(trips, ROLLUP_KEYS, ROLLUP_MEASURES, digits))


def hourly_revenue(trips: DataFrame, digits: int | None = None) -> DataFrame:
    by_hour = summarise(trips, ["hour_of_day"], ["fare_amount"], digits)
    return by_hour.select(
        "hour_of_day",
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
        row_count().alias("trip_count"),
        F.round(total("fare_amount"), 2).alias("total_revenue"),
    ).orderBy("hour_of_day")


def avg_fare_by_hour(trips: DataFrame, digits: int | None = None) -> DataFrame:
    by_hour = summarise(trips, ["hour_of_day"], ["fare_amount", "trip_distance"], digits)
    return by_hour.select(
        "hour_of_day",
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
        row_count().alias("trip_count"),
        F.round(mean("trip_distance"), 2).alias("avg_distance"),
    ).orderBy("hour_of_day")


def top_pickup_hours(trips: DataFrame, n: int = 10, digits: int | None = None) -> DataFrame:
    by_hour = summarise(trips, ["hour_of_day"], ["fare_amount"], digits)
    report = by_hour.select(
        "hour_of_day",
        row_count().alias("trip_count"),
        F.round(total("fare_amount"), 2).alias("total_revenue"),
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
    )
    return report.orderBy(F.desc("trip_count"), "hour_of_day").limit(int(n))


def avg_duration_by_dow(trips: DataFrame, digits: int | None = None) -> DataFrame:
    by_day = summarise(trips, ["day_of_week"], ["trip_duration_mins", "fare_amount"], digits)
    report = by_day.select(
        "day_of_week",
        F.round(mean("trip_duration_mins"), 2).alias("avg_duration_mins"),
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
        row_count().alias("trip_count"),
    )
    return report.orderBy(F.desc("avg_duration_mins"), "day_of_week")


def payment_breakdown(trips: DataFrame, digits: int | None = None) -> DataFrame:
    by_type = share_of_rows(summarise(trips, ["payment_type"], ["fare_amount"], digits), "pct_trips", 1)
    report = by_type.select(
        "payment_type",
        row_count().alias("trip_count"),
        F.round(total("fare_amount"), 2).alias("total_revenue"),
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
        "pct_trips",
    )
    return report.orderBy(F.desc("total_revenue"), "payment_type")


def top_routes(trips: DataFrame, n: int = 10, digits: int | None = None) -> DataFrame:
    """Most frequent pairs of pickup and dropoff zone."""
    route = ["PULocationID", "DOLocationID"]
    by_route = summarise(trips, route, ["fare_amount", "trip_distance"], digits)
    report = by_route.select(
        *route,
        row_count().alias("trip_count"),
        F.round(mean("fare_amount"), 2).alias("avg_fare"),
        F.round(mean("trip_distance"), 2).alias("avg_distance"),
    )
    return report.orderBy(F.desc("trip_count"), *route).limit(int(n))


def monthly_growth(
    trips: DataFrame, pickup: str = "tpep_pickup_datetime", digits: int | None = None
) -> DataFrame:
    """Trips and revenue per month, and the growth of the trip count over the previous month present."""
    by_month = summarise(
        trips.withColumn("year_month", times.year_month(pickup)), ["year_month"], ["fare_amount"], digits
    ).select(
        "year_month", row_count().alias("trip_count"), F.round(total("fare_amount"), 2).alias("total_revenue")
    )
    return growth(by_month, "year_month", "trip_count", "prev_count", "growth_pct").orderBy("year_month")


def detect_anomalies(trips: DataFrame, z_threshold: float = 3.0, limit: int | None = 25) -> DataFrame:
    """Highest fares above mean + ``z_threshold`` deviations, all of them if ``limit`` is None; ties go by the other columns."""
    columns = ["tpep_pickup_datetime", "trip_distance", "fare_amount", "trip_duration_mins", "payment_type"]
    found = above_spread(trips.select(*columns), "fare_amount", z_threshold, score="z_score")
    ties = [c for c in columns if c != "fare_amount"]
    ordered = found.orderBy(F.desc("fare_amount"), *ties)
    return ordered if limit is None else ordered.limit(int(limit))


def fare_anomalies(trips: DataFrame) -> DataFrame:
    return detect_anomalies(trips, z_threshold=3.0, limit=20)


def filtered_trips(trips: DataFrame) -> DataFrame:
    """Trips inside the fare and distance ranges with cost per mile.

    Duration and hour are added where the table does not have them, here unclipped.
    """
    if "trip_duration_mins" not in trips.columns:
        trips = cleaning.add_duration(
            trips, "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_mins", limits=None
        )
    if "hour_of_day" not in trips.columns:
        trips = trips.withColumn("hour_of_day", times.hour_of_day("tpep_pickup_datetime"))
    kept = cleaning.between_filter(trips, cleaning.TRIP_RANGES)
    cost = numbers.ratio("fare_amount", "trip_distance", cleaning.DISTANCE_FLOOR)
    return kept.withColumn("cost_per_mile", cost)


def filtered_hourly_summary(filtered: DataFrame, digits: int | None = None) -> DataFrame:
    """Count and unrounded mean of the fares per hour."""
    by_hour = summarise(filtered, ["hour_of_day"], ["fare_amount"], digits)
    return by_hour.select(
        "hour_of_day", value_count("fare_amount").alias("trip_count"), mean("fare_amount").alias("avg_fare")
    )


def filtered_payment_summary(filtered: DataFrame, digits: int | None = None) -> DataFrame:
    """Sum and count of the fares per payment type that occurs."""
    by_type = summarise(filtered, ["payment_type"], ["fare_amount"], digits)
    return by_type.select(
        "payment_type", total("fare_amount").alias("sum"), value_count("fare_amount").alias("count")
    )
