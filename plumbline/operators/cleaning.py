"""Cleaning and enrichment of raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from plumbline.functions import numbers, texts, times

# Column names and limits of the two data models.
TRIP_ALIASES = {
    "tpep_pickup_datetime": ("tpep_pickup_datetime", "pickup_datetime", "lpep_pickup_datetime"),
    "tpep_dropoff_datetime": ("tpep_dropoff_datetime", "dropoff_datetime", "lpep_dropoff_datetime"),
    "fare_amount": ("fare_amount", "fare"),
    "trip_distance": ("trip_distance", "distance"),
}
TRIP_RANGES = {"fare_amount": (1.0, 500.0), "trip_distance": (0.1, 100.0)}
DURATION_MINUTES = (0.5, 300.0)
DISTANCE_FLOOR = 0.1
# Tasks over which dedupe spreads the copies of one key of a large table.
COPY_SLICES = 16
SALES_NUMBERS = ("quantity", "unit_price", "discount_pct", "revenue")


class RuleCounts:
    """How many rows each rule of a cleaning drops, counted in the pass that cleans.

    Hand one to :func:`clean_trips` or :func:`clean_sales`; when an action over the result
    has finished, :meth:`result` has the figures. Rows are counted at each rule, so range
    filters no longer reach the file scan. A lost task that runs again may count twice.
    """

    def __init__(self) -> None:
        self._stages: list[tuple[str, Observation]] = []

    def after(self, rule: str, df: DataFrame) -> DataFrame:
        """``df`` as it is left by ``rule``; the first call gives the rows before any rule."""
        seen = Observation()
        self._stages.append((rule, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def result(self) -> dict[str, int]:
        """Rows ``before``, dropped by each rule in their order, and ``after``; before is the sum of the others."""
        rows = [(rule, seen.get["rows"]) for rule, seen in self._stages]
        dropped = {rule: earlier - left for (_, earlier), (rule, left) in zip(rows, rows[1:])}
        return {"before": rows[0][1], **dropped, "after": rows[-1][1]}


def _counted(counts: RuleCounts | None, rule: str, df: DataFrame) -> DataFrame:
    return df if counts is None else counts.after(rule, df)


class MissingColumns(ValueError):
    """A table lacks columns that the operator needs."""


def normalize_columns(df: DataFrame, blank_to: str | None = None) -> DataFrame:
    """Strip and lower-case every column name; ``blank_to`` replaces inner blanks."""
    return df.toDF(*[texts.tidy_name(c, blank_to) for c in df.columns])


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first alias present of each canonical column to the canonical name."""
    renames = {}
    for canonical, candidates in aliases.items():
        found = next((c for c in candidates if c in df.columns), None)
        if found is not None and found != canonical:
            renames[found] = canonical
    return df.withColumnsRenamed(renames)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def coerce_timestamp(df: DataFrame, columns: Iterable[str], formats: tuple[str, ...] = ()) -> DataFrame:
    """Make columns zone-free timestamps; what cannot be read becomes null."""
    changes: dict[str, Column] = {}
    kinds = dict(df.dtypes)
    for name in columns:
        if kinds[name] in ("timestamp", "date"):
            changes[name] = F.col(name).cast("timestamp_ntz")
        elif kinds[name] != "timestamp_ntz":
            changes[name] = times.to_timestamp(name, formats)
    return df.withColumns(changes) if changes else df


def coerce_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Make columns doubles; what is no number becomes null.

    A column that is a double already is left alone, so that later filters on it
    still reach the file scan; ``drop_nulls`` and range filters remove its NaN.
    """
    kinds = dict(df.dtypes)
    changes = {c: numbers.to_double(c) for c in columns if kinds[c] != "double"}
    return df.withColumns(changes) if changes else df


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with null or NaN in any of the columns (null checks reach the file scan)."""
    kinds = dict(df.dtypes)
    tests = [F.col(c).isNotNull() for c in columns]
    tests += [~F.isnan(c) for c in columns if kinds[c] in ("float", "double")]
    return df.where(reduce(and_, tests))


def between_filter(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside every range, bounds included."""
    return df.where(reduce(and_, [F.col(c).between(low, high) for c, (low, high) in ranges.items()]))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tasks: int | None = None) -> DataFrame:
    """Keep the first row per key in the given order.

    Rank and filter together let Spark keep one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many copies costs one row per task.

    ``tasks``, for tables too large for the session's shuffle partitions to sort in memory, deals
    the rows over that many tasks: first by key and slice, so that copies of one key are spread,
    then the first row of each slice by key. ``order`` must be plain columns there.
    """
    if tasks:
        places = [f"_order_{i}" for i in range(len(order))]
        placed = df.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(name) for c, name in zip(order, places)])
        placed = placed.withColumn("_slice", F.pmod(F.xxhash64(*places), F.lit(COPY_SLICES)))
        sliced = dedupe(placed.repartition(tasks, *keys, "_slice"), [*keys, "_slice"], places)
        return dedupe(sliced.repartition(tasks, *keys), keys, places).drop("_slice", *places)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def add_duration(
    df: DataFrame, start: str, end: str, out: str, limits: tuple[float, float] | None = DURATION_MINUTES
) -> DataFrame:
    """Minutes between two timestamps, clipped to ``limits`` unless these are None."""
    minutes = times.minutes_between(start, end)
    return df.withColumn(out, minutes if limits is None else numbers.clip(minutes, *limits))


def clean_trips(
    raw: DataFrame,
    aliases: Mapping[str, Sequence[str]] = TRIP_ALIASES,
    ranges: Mapping[str, tuple[float, float]] = TRIP_RANGES,
    default_payment_type: str | None = None,
    counts: RuleCounts | None = None,
) -> DataFrame:
    """Raw trips to typed, range-checked trips with derived columns.

    One chain of projections and filters without a shuffle. Rows with a missing
    or unreadable required value or a value out of range go; durations are
    clipped, not filtered. ``default_payment_type`` fills in a missing column. ``counts``
    takes the number of rows that each rule drops.
    """
    trips = resolve_aliases(normalize_columns(_counted(counts, "before", raw)), aliases)
    require_columns(trips, aliases)
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    trips = coerce_double(coerce_timestamp(trips, [start, end]), ["fare_amount", "trip_distance"])
    if counts is None:
        trips = between_filter(drop_nulls(trips, list(aliases)), ranges)
    else:
        for name in aliases:
            trips = counts.after(f"no_{name}", drop_nulls(trips, [name]))
        for name, limits in ranges.items():
            trips = counts.after(f"{name}_out_of_range", between_filter(trips, {name: limits}))
    kind = F.col("payment_type") if "payment_type" in trips.columns else F.lit(default_payment_type)
    return add_trip_features(trips).withColumn("payment_type", kind.cast("string"))


def add_trip_features(trips: DataFrame) -> DataFrame:
    """Duration, cost per mile, hour and weekday of a trip."""
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return trips.withColumns(
        {
            "trip_duration_mins": numbers.clip(times.minutes_between(start, end), *DURATION_MINUTES),
            "cost_per_mile": numbers.ratio("fare_amount", "trip_distance", DISTANCE_FLOOR),
            "hour_of_day": times.hour_of_day(start),
            "day_of_week": times.day_of_week(start),
        }
    )


def clean_sales(
    raw: DataFrame, keys: Sequence[str] = ("order_id",), order: Sequence[str | Column] = (), counts: RuleCounts | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Raw orders to typed orders, one per order id, with ``year_month``.

    Deduplication comes before the null filter: an order whose first copy lacks
    its revenue is gone, even if a later copy has one. ``order`` says which copy
    is first; by default the remaining columns decide, in table order.
    :func:`plumbline.sources.files.file_order` makes it the first as read from Parquet files.
    ``counts`` takes the number of rows that each rule drops; ``tasks`` is as of :func:`dedupe`.
    """
    sales = normalize_columns(raw, blank_to="_")
    order = list(order) or [c for c in sales.columns if c not in keys]
    first = dedupe(_counted(counts, "before", sales), keys, order, tasks)
    return finish_sales(_counted(counts, "duplicates", first), counts)


def finish_sales(sales: DataFrame, counts: RuleCounts | None = None) -> DataFrame:
    """Everything in :func:`clean_sales` after the deduplication; no shuffle."""
    sales = _counted(counts, "no_revenue_or_region", drop_nulls(sales, ["revenue", "region"]))
    sales = coerce_double(sales, [c for c in SALES_NUMBERS if c in sales.columns])
    sales = _counted(counts, "unreadable_revenue", drop_nulls(sales, ["revenue"]))
    sales = _counted(counts, "unreadable_date", drop_nulls(coerce_timestamp(sales, ["date"]), ["date"]))
    return sales.withColumn("year_month", times.year_month("date"))


def drop_failed_pages(pages: DataFrame) -> DataFrame:
    """Keep pages whose fetch left no error."""
    return pages.where(F.coalesce(F.col("error"), F.lit("")) == "")
