import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import trips
from plumbline.plans import reports
from plumbline.sources import bindings, synthetic
from plumbline.operators.cleaning import clean_trips

SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, fare_amount double, trip_distance double, trip_duration_mins double, "
    "payment_type string, hour_of_day int, day_of_week string, PULocationID bigint, DOLocationID bigint"
)
AT = dt.datetime(2023, 1, 1)


@pytest.fixture(scope="module")
def few(spark):
    rows = [
        (AT, 10.0, 1.0, 5.0, "1", 0, "Sunday", 1, 2),
        (AT, 20.0, 2.0, 7.0, "1", 0, "Sunday", 1, 2),
        (AT, 5.005, 4.0, 9.0, "2", 3, "Monday", 2, 1),
        (AT, 5.0, 4.0, 9.0, None, 3, "Monday", 3, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_hourly_revenue(few):
    # 5.005 + 5.0 is 10.004999999999999 in doubles and 10.005 in decimals.
    assert rows(trips.hourly_revenue(few)) == [(0, 15.0, 2, 30.0), (3, 5.0, 2, 10.0)]
    assert rows(trips.hourly_revenue(few, digits=6)) == [(0, 15.0, 2, 30.0), (3, 5.0, 2, 10.01)]


def test_avg_fare_by_hour(few):
    assert rows(trips.avg_fare_by_hour(few, digits=6)) == [(0, 15.0, 2, 1.5), (3, 5.0, 2, 4.0)]


def test_top_pickup_hours_breaks_ties_by_hour(few):
    assert rows(trips.top_pickup_hours(few, n=1)) == [(0, 2, 30.0, 15.0)]


def test_avg_duration_by_dow(few):
    assert rows(trips.avg_duration_by_dow(few)) == [("Monday", 9.0, 5.0, 2), ("Sunday", 6.0, 15.0, 2)]


def test_payment_breakdown_includes_missing_types_and_adds_up(few):
    got = rows(trips.payment_breakdown(few))
    assert got == [("1", 2, 30.0, 15.0, 50.0), ("2", 1, 5.01, 5.01, 25.0), (None, 1, 5.0, 5.0, 25.0)]
    assert sum(r[4] for r in got) == 100.0


def test_top_routes(few):
    assert rows(trips.top_routes(few, n=2)) == [(1, 2, 2, 15.0, 1.5), (2, 1, 1, 5.01, 4.0)]


def test_monthly_growth_uses_the_previous_month_present(spark):
    months = ["2023-01"] * 2 + ["2023-02"] * 3 + ["2023-05"]
    df = spark.createDataFrame([(f"{m}-09 10:00:00", 1.0) for m in months], "t string, fare_amount double")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime"), "fare_amount")
    assert rows(trips.monthly_growth(df)) == [
        ("2023-01", 2, 2.0, None, None),
        ("2023-02", 3, 3.0, 2, 50.0),
        ("2023-05", 1, 1.0, 3, -66.67),
    ]
    assert rows(trips.monthly_growth(df.where("tpep_pickup_datetime < '2023-02-01'"))) == [("2023-01", 2, 2.0, None, None)]


def anomalies(spark, fares, **options):
    data = [(AT, f, 1.0, 1.0, "1", 0, "Sunday", 1, 1) for f in fares]
    return trips.detect_anomalies(spark.createDataFrame(data, SCHEMA), **options)


def test_anomalies_upper_tail_only_with_population_deviation(spark):
    got = anomalies(spark, [10.0] * 20 + [0.0, 100.0]).collect()
    mean, sd = 300 / 22, (((10 - 300 / 22) ** 2 * 20 + (300 / 22) ** 2 + (100 - 300 / 22) ** 2) / 22) ** 0.5
    assert [(r.fare_amount, r.z_score) for r in got] == [(100.0, round((100 - mean) / sd, 2))]


def test_anomalies_without_spread_or_rows(spark):
    assert anomalies(spark, [5.0] * 4).count() == 0
    assert anomalies(spark, []).count() == 0


def test_anomaly_limit_keeps_the_largest(spark):
    got = anomalies(spark, [1.0] * 1000 + [float(100 + i) for i in range(30)], limit=25).collect()
    assert [r.fare_amount for r in got] == [float(129 - i) for i in range(25)]


def test_filtered_trips_derive_what_is_missing_unclipped(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2023-01-01 10:00:00' AS tpep_pickup_datetime, timestamp_ntz'2023-01-01 09:00:00' AS tpep_dropoff_datetime,"
        " CAST(500 AS double) AS fare_amount, CAST(100 AS double) AS trip_distance, '1' AS payment_type"
    )
    got = trips.filtered_trips(df).first()
    assert (got.trip_duration_mins, got.hour_of_day, got.cost_per_mile) == (-60.0, 10, 5.0)
    assert trips.filtered_trips(df.withColumn("fare_amount", F.lit(500.01))).count() == 0


def test_filtered_summaries(few):
    assert sorted(rows(trips.filtered_hourly_summary(few))) == [(0, 2, 15.0), (3, 2, pytest.approx(5.0025))]
    got = sorted(rows(trips.filtered_payment_summary(few, digits=6)), key=str)
    assert got == [("1", 30.0, 2), ("2", 5.005, 1), (None, 5.0, 1)]


def test_reports_from_the_rollup_equal_reports_from_the_trips(spark):
    cleaned = bindings.trips(spark, "/root/testdata/sf0.001")
    bundle = reports.trip_report(cleaned, digits=6)
    assert rows(bundle["avg_fare_by_hour"]) == rows(trips.avg_fare_by_hour(cleaned, digits=6))
    assert rows(bundle["top_10_pickup_hours"]) == rows(trips.top_pickup_hours(cleaned, digits=6))
    assert rows(bundle["avg_duration_by_dow"]) == rows(trips.avg_duration_by_dow(cleaned, digits=6))
    assert rows(bundle["revenue_by_payment_type"]) == rows(trips.payment_breakdown(cleaned, digits=6))
    assert rows(bundle["fare_anomalies"]) == rows(trips.fare_anomalies(cleaned))
    bundle["rollup"].unpersist()


def test_filtered_bundle(spark):
    cleaned = bindings.trips(spark, "/root/testdata/sf0.001")
    bundle = reports.filtered_trip_summaries(cleaned, digits=6)
    filtered = trips.filtered_trips(cleaned)
    assert bundle["filtered"].count() == filtered.count()
    assert sorted(rows(bundle["hourly_summary"])) == sorted(rows(trips.filtered_hourly_summary(filtered, digits=6)))
    assert sorted(rows(bundle["payment_summary"])) == sorted(rows(trips.filtered_payment_summary(filtered, digits=6)))
    bundle["rollup"].unpersist()


def test_synthetic_trips_are_plausible_and_cleanable(spark):
    made = synthetic.synthetic_trips(spark, 2000)
    cleaned = clean_trips(made).cache()
    assert cleaned.count() == 2000 and len(cleaned.columns) == 14
    stats = cleaned.agg(
        F.min("fare_amount").alias("lo"), F.max("fare_amount").alias("hi"), F.corr("fare_amount", "trip_distance").alias("r"),
        F.min("trip_duration_mins").alias("short"), F.max("trip_duration_mins").alias("long"),
    ).first()
    assert 3 <= stats.lo and stats.hi <= 150 and stats.r > 0.8 and 3 <= stats.short and stats.long <= 60
    assert made.agg(F.max("tpep_pickup_datetime")).first()[0] == AT + dt.timedelta(minutes=2 * 1999)
    assert synthetic.synthetic_trips(spark, 50).collect() == synthetic.synthetic_trips(spark, 50).collect()
    assert synthetic.synthetic_trips(spark, 500, flat_fares=True).agg(F.max("fare_amount")).first()[0] <= 80
