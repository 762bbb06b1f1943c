from pyspark.sql import functions as F

from plumbline.functions import numbers, texts, times


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def test_rounding(spark):
    even = [value(spark, numbers.round_half_even(F.lit(x), 2)) for x in (0.125, 0.375, -0.125, 2.5, 1.004)]
    assert even == [0.12, 0.38, -0.12, 2.5, 1.0]
    up = [value(spark, numbers.round_up_half(F.lit(x), 1)) for x in (0.25, -0.25, 0.24)]
    assert up == [0.3, -0.2, 0.2]


def test_ratio_and_clip(spark):
    assert value(spark, numbers.ratio(F.lit(10.0), F.lit(0.0), floor=0.1)) == 100.0
    assert value(spark, numbers.ratio(F.lit(10.0), F.lit(None).cast("double"), floor=0.1)) is None
    assert value(spark, numbers.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert value(spark, numbers.clip(F.lit(7.0), 0, 1)) == 1.0


def test_percent_of_nothing_is_null(spark):
    assert value(spark, numbers.percent(F.lit(1), F.lit(0), 1)) is None
    assert value(spark, numbers.percent(F.lit(1), F.lit(3), 1)) == 33.3


def test_gross_revenue(spark):
    assert value(spark, numbers.gross_revenue(F.lit(3.0), F.lit(9.99), F.lit(0.125))) == 26.22


def test_texts(spark):
    assert value(spark, texts.collapse_blanks(F.lit("  a  b\nc \t d "))) == "a b\nc d"
    assert value(spark, texts.word_count(F.lit(" a  b\nc "))) == 3
    assert value(spark, texts.word_count(F.lit(""))) == 0
    assert value(spark, texts.padded_id("ORD", F.lit(42), 6)) == "ORD-000042"
    assert texts.tidy_name("  Unit Price ", "_") == "unit_price"
    assert texts.tidy_name(" Unit Price") == "unit price"


def test_times(spark):
    assert value(spark, times.months_apart(F.lit("2021-11"), F.lit("2022-02"))) == 3
    for month in ("2021-12", "2022-01", "0001-10"):
        assert value(spark, times.month_text(times.month_number(F.lit(month)))) == month
    assert value(spark, times.year_month(F.lit("2022-02-03").cast("timestamp_ntz"))) == "2022-02"
    start, end = F.lit("2022-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2022-01-01 00:00:00.5").cast("timestamp_ntz")
    assert value(spark, times.minutes_between(start, end)) == 0.5 / 60
