import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plumbline.operators import stats


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def values_of(df, name):
    return [r[name] for r in df.collect()]


def test_minmax_and_describe(spark):
    df = column(spark, [6.0, -2.0, 1.0, 9.0, 3.5, 0.0])
    assert values_of(stats.minmax_normalize(df, "v", "n"), "n") == [0.727273, 0.0, 0.272727, 1.0, 0.5, 0.181818]
    got = stats.describe_numeric(df, "v").first()
    assert (got.input_size, got.min, got.max) == (6, -2.0, 9.0)
    assert got["mean"] == pytest.approx(2.916667, abs=5e-7) and got.std == pytest.approx(3.723984, abs=5e-7)


def test_zscore(spark):
    df = column(spark, [3.0, 8.0, 1.0, 4.0, 4.0, 12.0, 7.0])
    expected = [-0.752618, 0.710806, -1.337987, -0.459933, -0.459933, 1.881545, 0.418121]
    assert values_of(stats.zscore_normalize(df, "v", "n"), "n") == expected


@pytest.mark.parametrize("normalize", [stats.minmax_normalize, stats.zscore_normalize])
def test_equal_values_give_zero_and_null_stays_null(spark, normalize):
    assert values_of(normalize(column(spark, [7.0, 7.0]), "v", "n"), "n") == [0.0, 0.0]
    got = {r.v: r.n for r in normalize(column(spark, [1.0, None, 2.0]), "v", "n").collect()}
    assert got[None] is None and got[1.0] < got[2.0]
    assert normalize(column(spark, []), "v", "n").count() == 0


def test_describe_of_nothing_is_an_error(spark):
    with pytest.raises(PySparkException, match="no values in v"):
        stats.describe_numeric(column(spark, []), "v").collect()


def test_arrays(spark):
    df = spark.createDataFrame([(1, [6.0, -2.0, 1.0, 9.0, 3.5, 0.0]), (2, [4.0, 4.0]), (3, None), (4, [])], "id int, a array<double>")
    got = {r.id: r.n for r in stats.minmax_normalize_array(df, "a", "n").collect()}
    assert got == {1: [0.727273, 0.0, 0.272727, 1.0, 0.5, 0.181818], 2: [0.0, 0.0], 3: None, 4: []}
    df = spark.createDataFrame([(1, [3.0, 8.0, 1.0, 4.0, 4.0, 12.0, 7.0]), (2, [4.0, 4.0]), (3, None), (4, [])], "id int, a array<double>")
    got = {r.id: r.n for r in stats.zscore_normalize_array(df, "a", "n").collect()}
    assert got[1] == [-0.752618, 0.710806, -1.337987, -0.459933, -0.459933, 1.881545, 0.418121]
    assert (got[2], got[3], got[4]) == ([0.0, 0.0], None, [])


def test_ols_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    a, b = rng.uniform(0, 20, 300), rng.uniform(3, 60, 300)
    y = 2.5 * a + 0.3 * b + rng.normal(0, 4, 300) + 7
    df = spark.createDataFrame([*zip(a.tolist(), b.tolist(), y.tolist()), (1.0, None, 2.0), (float("nan"), 1.0, 1.0)], "a double, b double, y double")
    design = np.column_stack([np.ones(300), a, b])
    beta, residual, *_ = np.linalg.lstsq(design, y, rcond=None)
    r2 = 1 - residual[0] / ((y - y.mean()) ** 2).sum()
    got = stats.ols(df, "y", ["a", "b"]).first()
    assert [got.intercept, got.coef_a, got.coef_b, got.r_squared] == pytest.approx([*beta, r2], rel=1e-9)
    assert got.n == 300
    one = stats.ols(df.where("b IS NOT NULL"), "y", ["a"]).first()
    slope, intercept = np.polyfit(a, y, 1)
    assert [one.intercept, one.coef_a] == pytest.approx([intercept, slope], rel=1e-9)
    assert one.r_squared == pytest.approx(np.corrcoef(a, y)[0, 1] ** 2) and one.n == 300


def test_ols_degenerate(spark):
    flat = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "x double, y double")
    got = stats.ols(flat, "y", ["x"]).first()
    assert (got.intercept, got.coef_x, got.r_squared) == (3.0, 0.0, 0.0)
    twice = flat.withColumn("z", F.col("x"))
    assert stats.ols(twice, "y", ["x", "z"]).first().coef_x is None
    with pytest.raises(ValueError):
        stats.ols(flat, "y", [])


@pytest.mark.parametrize("factor", [0.7, 1 / 3, 3.0, -2.0])
@pytest.mark.parametrize("offset", [0.1, 1e6])
def test_collinear_regressors_give_null(spark, factor, offset):
    rng = np.random.default_rng(3)
    a = rng.uniform(0, 9, 50).tolist()
    df = spark.createDataFrame([(x, x * factor + offset, 2 * x + 1) for x in a], "a double, b double, y double")
    got = stats.ols(df, "y", ["a", "b"]).first()
    assert (got.coef_a, got.coef_b, got.intercept, got.r_squared) == (None, None, None, None)


def test_r_squared_stays_within_bounds(spark):
    df = spark.createDataFrame([(float(x), 0.1 * x + 0.3) for x in range(40)], "x double, y double")
    assert 0.0 <= stats.ols(df, "y", ["x"]).first().r_squared <= 1.0


def design_of(columns):
    return np.column_stack([np.ones(len(columns[0])), *columns])


@pytest.mark.parametrize("width", [1, 2, 5, 9])
def test_least_squares_with_any_number_of_regressors(spark, width):
    rng = np.random.default_rng(width)
    x = [rng.normal(10 * i, 1 + i, 200) for i in range(width)]
    y = sum((i - 1.5) * c for i, c in enumerate(x)) + rng.normal(0, 1, 200) + 3
    rows = [tuple(map(float, r)) for r in zip(*x, y)] + [(None,) * width + (1.0,)]
    names = [f"x{i}" for i in range(width)]
    got = stats.least_squares(spark.createDataFrame(rows, [*names, "y"]), "y", names).first()
    want = np.linalg.lstsq(design_of(x), y, rcond=None)[0]
    assert [got.intercept, *[got[f"coef_{n}"] for n in names]] == pytest.approx(want, rel=1e-7)
    assert (got.n, got["rank"]) == (200, width) and 0 < got.r_squared <= 1


@pytest.mark.parametrize("dependent", ["double", "sum", "constant", "all constant", "zero"])
def test_dependent_regressors_get_the_shortest_solution(spark, dependent):
    rng = np.random.default_rng(5)
    a, b = rng.uniform(1, 9, 60), rng.uniform(-4, 4, 60)
    third = {"double": 2 * a, "sum": a + b - 3, "constant": np.full(60, 7.0), "all constant": np.full(60, 7.0), "zero": np.zeros(60)}[dependent]
    if dependent == "all constant":
        a, b = np.full(60, 2.0), np.full(60, -1.0)
    y = 3 * a - b + rng.normal(0, 1, 60)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, third, y)], "a double, b double, c double, y double")
    got = stats.least_squares(frame, "y", ["a", "b", "c"]).first()
    want = np.linalg.lstsq(design_of([a, b, third]), y, rcond=None)[0]
    assert [got.intercept, got.coef_a, got.coef_b, got.coef_c] == pytest.approx(want, rel=1e-6, abs=1e-8)
    assert got["rank"] == (0 if dependent == "all constant" else 2)


def test_least_squares_of_nothing(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert tuple(stats.least_squares(empty, "y", ["x"]).first()) == (None, None, 0.0, 0, 0)
    with pytest.raises(ValueError):
        stats.least_squares(empty, "y", [])
