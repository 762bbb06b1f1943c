"""Regression, normalisation and description of numeric columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import round_up_half, to_double
from plumbline.session import ship_package

OUTPUT_DIGITS = 6
# Determinants up to this share of the product of variances count as zero; more where
# means are many deviations away from zero, as deviations from them are rounded then.
COLLINEAR, ROUNDING = 1e-12, 32 * 2.0**-53


def ols(df: DataFrame, y: str, x: Sequence[str]) -> DataFrame:
    """Least squares of ``y`` on one or two regressors with intercept, as one row.

    Columns: intercept, ``coef_<x>`` each, r_squared, n. All moments come from one
    aggregation over the rows without nulls. Collinear regressors have no unique
    solution and give null; r_squared is zero when ``y`` is constant.
    """
    if len(x) not in (1, 2):
        raise ValueError("one or two regressors")
    columns = [y, *x]
    rows = df.select(*[to_double(c).alias(c) for c in columns]).where(
        " AND ".join(f"`{c}` IS NOT NULL" for c in columns)
    )
    moments = [F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("_yy"), F.avg(y).alias("_y")]
    for i, name in enumerate(x):
        moments += [
            F.avg(name).alias(f"_x{i}"),
            F.var_pop(name).alias(f"_s{i}{i}"),
            F.covar_pop(name, y).alias(f"_s{i}y"),
        ]
    if len(x) == 2:
        moments.append(F.covar_pop(*x).alias("_s01"))
    fit = rows.agg(*moments)

    m = F.col
    if len(x) == 1:
        slopes = [F.try_divide(m("_s0y"), m("_s00"))]
    else:
        # Rounding leaves a determinant of collinear columns off zero by some units of its terms.
        product = m("_s00") * m("_s11")
        exact = product - m("_s01") * m("_s01")
        far = sum((F.coalesce(F.try_divide(F.abs(m(f"_x{i}")), F.sqrt(m(f"_s{i}{i}"))), F.lit(0.0)) for i in range(2)), F.lit(1.0))
        det = F.when(exact > F.greatest(F.lit(COLLINEAR), F.lit(ROUNDING) * far) * product, exact)
        slopes = [
            F.try_divide(m("_s0y") * m("_s11") - m("_s1y") * m("_s01"), det),
            F.try_divide(m("_s1y") * m("_s00") - m("_s0y") * m("_s01"), det),
        ]
    names = [f"coef_{c}" for c in x]
    fit = fit.withColumns(dict(zip(names, slopes)))
    intercept, explained = m("_y"), F.lit(0.0)
    for i, name in enumerate(names):
        intercept = intercept - m(name) * m(f"_x{i}")
        explained = explained + m(name) * m(f"_s{i}y")
    share = F.try_divide(explained, m("_yy"))
    bounded = F.when(share.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    r_squared = F.when(m("_yy") > 0, bounded).otherwise(F.lit(0.0))
    return fit.select(intercept.alias("intercept"), *names, r_squared.alias("r_squared"), "n")


def _solve(means: np.ndarray, moments: np.ndarray, with_y: np.ndarray, y_mean: float, y_var: float) -> tuple[float, np.ndarray, float, int]:
    """Intercept, coefficients, r squared and rank from centred moments: of all least-squares solutions the shortest."""
    deviation = np.sqrt(np.diag(moments))
    far = 1 + (np.abs(means) / np.where(deviation > 0, deviation, np.inf)).sum()
    moving = np.flatnonzero(deviation > 0)
    scale = deviation[moving]
    values, vectors = np.linalg.eigh(moments[np.ix_(moving, moving)] / np.outer(scale, scale))
    full = values > len(means) * max(COLLINEAR, ROUNDING * far)
    coefs = np.zeros(len(means))
    along = vectors[:, full]
    coefs[moving] = along @ ((along.T @ (with_y[moving] / scale)) / values[full]) / scale
    # Directions that change no fitted value: sums of regressors that are constant, the intercept making up for it.
    free = np.zeros((len(means), len(means) - int(full.sum())))
    free[moving, : (~full).sum()] = vectors[:, ~full] / scale[:, None]
    free[np.flatnonzero(deviation == 0), (~full).sum() + np.arange((deviation == 0).sum())] = 1.0
    intercept = y_mean - means @ coefs
    if free.shape[1]:
        moves = np.vstack([free, -(means @ free)])
        shift = np.linalg.lstsq(moves, -np.append(coefs, intercept), rcond=None)[0]
        coefs, intercept = coefs + free @ shift, intercept - means @ free @ shift
    explained = float(coefs @ with_y)
    return intercept, coefs, min(1.0, max(0.0, explained / y_var)) if y_var > 0 else 0.0, int(full.sum())


def least_squares(df: DataFrame, y: str, x: Sequence[str]) -> DataFrame:
    """Least squares of ``y`` on any number of regressors with intercept, as one row.

    Columns: intercept, ``coef_<x>`` each, r_squared, rank, n. Rows with a null or NaN do
    not count. All means, variances and covariances, n(n+1)/2 of them, come from one
    aggregation; only that row is solved outside the JVM. Where regressors are constant or
    depend on each other (``rank`` below their number), of all best solutions the one with
    the least sum of squares of intercept and coefficients is given. Without rows
    everything but r_squared, rank and n is null; r_squared is zero when ``y`` is constant.
    """
    if not x:
        raise ValueError("no regressors")
    ship_package(df.sparkSession)
    names = [f"v{i}" for i in range(len(x))]
    rows = df.select(to_double(y).alias("y"), *[to_double(c).alias(n) for n, c in zip(names, x)]).dropna()
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    fit = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("y_mean"), F.var_pop("y").alias("y_var"), F.array(*[F.avg(n) for n in names]).alias("means"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).alias("moments"), F.array(*[F.covar_pop(n, "y") for n in names]).alias("with_y"),
    )

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if not row.n:
                    out.append((None, [None] * len(x), 0.0, 0, 0))
                    continue
                moments = np.zeros((len(x), len(x)))
                for (i, j), value in zip(pairs, row.moments):
                    moments[i, j] = moments[j, i] = value
                intercept, coefs, share, rank = _solve(np.array(row.means), moments, np.array(row.with_y), row.y_mean, row.y_var)
                out.append((intercept, coefs.tolist(), share, rank, row.n))
            yield pd.DataFrame(out, columns=["intercept", "coefs", "r_squared", "rank", "n"])

    found = fit.mapInPandas(solved, "intercept double, coefs array<double>, r_squared double, rank int, n bigint")
    return found.select("intercept", *[F.col("coefs")[i].alias(f"coef_{c}") for i, c in enumerate(x)], "r_squared", "rank", "n")


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """Count, minimum, maximum, mean and population deviation; an empty column is an error."""
    value = to_double(column)
    size = F.count(value)
    return df.agg(
        F.when(size == 0, F.raise_error(F.lit(f"no values in {column}"))).otherwise(size).alias("input_size"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    )


def _scaled(value: Column, shift: Column, scale: Column) -> Column:
    """``(value - shift) / scale`` to six digits; zero where the scale is zero."""
    moved = F.when(scale == 0, F.lit(0.0)).otherwise(F.try_divide(value - shift, scale))
    return round_up_half(moved, OUTPUT_DIGITS)


def minmax_normalize(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scale a column to 0..1.

    The bounds are a scalar subquery over the one column; the rows themselves
    are neither joined nor shuffled.
    """
    value = to_double(column)
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    return df.withColumn(out, _scaled(value, bounds["low"], bounds["high"] - bounds["low"]))


def zscore_normalize(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distance from the mean in population deviations."""
    value = to_double(column)
    spread = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd")).alias("s")).scalar()
    return df.withColumn(out, _scaled(value, spread["mean"], spread["sd"]))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _array_mean(values: Column) -> Column:
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda total, v: total + v), F.size(values))


def _rescaled(values: Column, shift: Column, scale: Column) -> Column:
    """Each value minus ``shift`` over ``scale``."""
    pair = F.struct(shift.alias("shift"), scale.alias("scale"))
    return _bind(pair, lambda p: F.transform(values, lambda v: _scaled(v, p["shift"], p["scale"])))


def minmax_normalize_array(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scale the values inside each array to 0..1."""

    def scaled(values: Column) -> Column:
        low = F.array_min(values)
        return _rescaled(values, low, F.array_max(values) - low)

    return df.withColumn(out, _bind(F.col(column).cast("array<double>"), scaled))


def zscore_normalize_array(df: DataFrame, column: str, out: str) -> DataFrame:
    """Z-scores within each array."""

    def deviation(values: Column, center: Column) -> Column:
        return F.sqrt(_array_mean(F.transform(values, lambda v: (v - center) * (v - center))))

    def scored(values: Column) -> Column:
        return _bind(_array_mean(values), lambda center: _rescaled(values, center, deviation(values, center)))

    return df.withColumn(out, _bind(F.col(column).cast("array<double>"), scored))
