import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import cleaning
from plumbline.sources import bindings

START = dt.datetime(2023, 1, 7, 13, 5)  # a Saturday


def trip(spark, rows, columns=("lpep_pickup_datetime", " LPEP_Dropoff_datetime", "Fare", "distance ", "payment_type")):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def raw(fare="10", distance="2", start="2023-01-07 13:05:00", end="2023-01-07 13:35:00", kind="1"):
    return (start, end, fare, distance, kind)


def test_clean_trips_columns_and_values(spark):
    row = cleaning.clean_trips(trip(spark, [raw(fare="7.05", distance="2")])).collect()
    assert len(row) == 1
    got = row[0].asDict()
    assert got == {
        "tpep_pickup_datetime": START,
        "tpep_dropoff_datetime": START + dt.timedelta(minutes=30),
        "fare_amount": 7.05,
        "trip_distance": 2.0,
        "payment_type": "1",
        "trip_duration_mins": 30.0,
        "cost_per_mile": 3.52,  # 352.5 goes to the even neighbour
        "hour_of_day": 13,
        "day_of_week": "Saturday",
    }


@pytest.mark.parametrize(
    ("fare", "distance", "kept"),
    [
        ("0.99", "2", False),
        ("1.0", "2", True),
        ("500.0", "2", True),
        ("500.01", "2", False),
        ("10", "0.09", False),
        ("10", "0.1", True),
        ("10", "100.0", True),
        ("10", "100.01", False),
        ("ten", "2", False),
        ("NaN", "2", False),
        (None, "2", False),
        ("10", None, False),
    ],
)
def test_range_limits_are_inclusive_and_bad_numbers_go(spark, fare, distance, kept):
    assert cleaning.clean_trips(trip(spark, [raw(fare=fare, distance=distance)])).count() == int(kept)


@pytest.mark.parametrize("bad", [None, "yesterday"])
def test_unreadable_timestamps_go(spark, bad):
    assert cleaning.clean_trips(trip(spark, [raw(start=bad)])).count() == 0
    assert cleaning.clean_trips(trip(spark, [raw(end=bad)])).count() == 0


@pytest.mark.parametrize(
    ("end", "minutes"),
    [
        ("2023-01-07 12:00:00", 0.5),
        ("2023-01-07 13:05:29", 0.5),
        ("2023-01-07 13:05:30", 0.5),
        ("2023-01-07 13:05:45.5", 45.5 / 60),
        ("2023-01-07 18:05:00", 300.0),
        ("2023-01-07 18:06:00", 300.0),
    ],
)
def test_durations_are_clipped_not_dropped(spark, end, minutes):
    assert cleaning.clean_trips(trip(spark, [raw(end=end)])).first().trip_duration_mins == pytest.approx(minutes, abs=1e-12)


def test_null_duration_stays_null(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-01-01' AS a, CAST(NULL AS timestamp_ntz) AS b")
    assert cleaning.add_duration(df, "a", "b", "m").first().m is None


def test_payment_type(spark):
    assert cleaning.clean_trips(trip(spark, [raw(kind=None)])).first().payment_type is None
    without = trip(spark, [raw()]).drop("payment_type")
    assert cleaning.clean_trips(without).first().payment_type is None
    assert cleaning.clean_trips(without, default_payment_type="2").first().payment_type == "2"


def test_missing_required_column_raises(spark):
    with pytest.raises(cleaning.MissingColumns, match="fare_amount"):
        cleaning.clean_trips(trip(spark, [raw()]).drop("Fare"))


def test_first_alias_wins(spark):
    df = spark.sql("SELECT 1 AS pickup_datetime, 2 AS tpep_pickup_datetime")
    got = cleaning.resolve_aliases(df, cleaning.TRIP_ALIASES)
    assert got.columns == ["pickup_datetime", "tpep_pickup_datetime"]
    assert cleaning.resolve_aliases(spark.sql("SELECT 1 AS fare"), cleaning.TRIP_ALIASES).columns == ["fare_amount"]


def test_extra_timestamp_format(spark):
    df = spark.sql("SELECT '07/01/2023 13:05' AS t UNION ALL SELECT '2023-01-07 13:05:00' UNION ALL SELECT 'x'")
    got = {r.t for r in cleaning.coerce_timestamp(df, ["t"], ("dd/MM/yyyy HH:mm",)).collect()}
    assert got == {START, None}


def sale(order_id="A", date="2022-03-04 05:06:07", region="North", revenue="10.5", extra=1):
    return (order_id, date, region, revenue, extra)


def sales(spark, rows):
    return spark.createDataFrame(rows, "`Order ID` string, `Date ` string, region string, revenue string, extra int")


def test_clean_sales(spark):
    rows = [sale(), sale("B", region=None), sale("C", revenue=None), sale("D", revenue="x"), sale("E", date="soon")]
    got = cleaning.clean_sales(sales(spark, rows)).collect()
    assert [(r.order_id, r.revenue, r.year_month) for r in got] == [("A", 10.5, "2022-03")]


def test_dedupe_comes_before_the_null_filter(spark):
    rows = [sale(revenue=None, extra=1), sale(revenue="3", extra=2), sale("B", revenue="4", extra=2), sale("B", revenue="5", extra=1)]
    got = cleaning.clean_sales(sales(spark, rows), order=["extra"]).collect()
    assert [(r.order_id, r.revenue) for r in got] == [("B", 5.0)]


def test_bound_sales_differ_from_cleaned_raw_ones_by_the_missing_region(spark):
    folder = "/root/testdata/sf0.001"
    cleaned = bindings.cleaned_raw_sales(spark, folder)
    whole = bindings.sales_with_product(spark, folder).select(*cleaned.columns)
    known = whole.where(F.col("region") != bindings.MISSING_REGION)
    assert whole.count() > known.count() == cleaned.count() > 0
    assert known.exceptAll(cleaned).isEmpty()


def test_drop_nulls_drops_nan(spark):
    df = spark.sql("SELECT CAST(x AS double) AS x FROM VALUES ('1'), (NULL), ('NaN') AS t(x)")
    assert cleaning.drop_nulls(df, ["x"]).count() == 1


def test_drop_failed_pages(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "timeout")], "url string, error string")
    assert {r.url for r in cleaning.drop_failed_pages(df).collect()} == {"a", "b"}


def test_dedupe_keeps_one_row_of_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = cleaning.dedupe(df, ["k"], ["id"])
    assert got.count() == df.select("k").distinct().count()
    assert got.where("k = 0").first().id == 0


def test_drops_of_each_rule_add_up(spark):
    rows = [("1", "2024-01-01", "5", "EU"), ("1", "2024-01-01", "6", "EU"), ("2", "2024-01-01", None, "EU"), ("3", "never", "5", "EU"), ("4", "2024-01-01", "much", "EU"), ("5", "2024-02-01", "1", None)]
    raw = spark.createDataFrame(rows, "order_id string, date string, revenue string, region string")
    counts = cleaning.RuleCounts()
    cleaned = cleaning.clean_sales(raw, counts=counts)
    assert [r.order_id for r in cleaned.collect()] == ["1"]
    found = counts.result()
    assert found == {"before": 6, "duplicates": 1, "no_revenue_or_region": 2, "unreadable_revenue": 1, "unreadable_date": 1, "after": 1}
    assert found["before"] == sum(v for k, v in found.items() if k != "before")
    assert cleaned.exceptAll(cleaning.clean_sales(raw)).isEmpty()


def test_drops_of_trips_are_counted_in_the_same_pass(spark):
    rows = [("2024-01-01 08:00:00", "2024-01-01 08:10:00", f, d) for f, d in ((10.0, 1.0), (0.5, 1.0), (None, 1.0), (20.0, 500.0), (1.0, 0.1))]
    raw = spark.createDataFrame(rows, "pickup_datetime string, dropoff_datetime string, fare double, distance double")
    counts = cleaning.RuleCounts()
    cleaned = cleaning.clean_trips(raw, counts=counts)
    text = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1
    assert cleaned.count() == 2
    assert counts.result() == {
        "before": 5, "no_tpep_pickup_datetime": 0, "no_tpep_dropoff_datetime": 0, "no_fare_amount": 1, "no_trip_distance": 0,
        "fare_amount_out_of_range": 1, "trip_distance_out_of_range": 1, "after": 2,
    }
