"""Keyed daily series: aggregation, calendar spine, lags, rolling and seasonal parts.

Every operator takes the key columns of the series.  Windows run per key over
daily rows, so a window never holds more rows than the series has days, however
many orders stand behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import calendar
from orderloom.functions.casts import money_sum


def _by_date(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("date")


def daily_sales(orders: DataFrame, keys: Sequence[str], ts: str, amount: str) -> DataFrame:
    return orders.groupBy(*keys, F.to_date(ts).alias("date")).agg(money_sum(F.col(amount)).alias("sales"))


def daily_profile(orders: DataFrame, keys: Sequence[str], ts: str, amount: str) -> DataFrame:
    """Sum, number of orders and mean per day."""
    daily = orders.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        money_sum(F.col(amount)).alias("sales"), F.count(F.lit(1)).alias("order_count")
    )
    return daily.withColumn("avg_order_value", F.col("sales") / F.col("order_count"))


def on_spine(daily: DataFrame, keys: Sequence[str], fill: dict[str, float] | None = None) -> DataFrame:
    """Every calendar day between the first and last day of each series.

    Each observed day is followed by the empty days up to the next one, so the
    source is read once and the result is already partitioned by series.
    Empty days are null, or ``fill`` where given.
    """
    following = F.date_sub(F.lead("date").over(_by_date(keys)), 1)
    ends = daily.withColumn("_until", F.coalesce(following, F.col("date")))
    days = ends.withColumn("_day", F.explode(F.sequence("date", "_until", F.expr("interval 1 day"))))
    values = [c for c in daily.columns if c not in keys and c != "date"]
    observed = F.col("_day") == F.col("date")
    out = days.select(*keys, F.col("_day").alias("date"), *[F.when(observed, F.col(c)).alias(c) for c in values])
    return out.fillna(fill) if fill else out


def missing_days(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days of the spine that are not observed."""
    gaps = daily.select(*keys, "date", F.lead("date").over(_by_date(keys)).alias("_next"))
    gaps = gaps.where(F.col("_next") > F.date_add("date", 1))
    inside = F.sequence(F.date_add("date", 1), F.date_sub("_next", 1), F.expr("interval 1 day"))
    return gaps.select(*keys, F.explode(inside).alias("date"))


def missing_by_weekday(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        missing_days(daily, keys)
        .groupBy(*keys, F.weekday("date").alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("n_missing"))
    )


def lag_columns(keys: Sequence[str], lags: Sequence[int], target: str = "sales", prefix: str = "sales_lag") -> dict[str, Column]:
    """Row lags; the series must lie on a gap-free spine."""
    return {f"{prefix}_{k}": F.lag(target, k).over(_by_date(keys)) for k in lags}


def rolling_columns(
    keys: Sequence[str], windows: Sequence[int], stats: Sequence[str] = ("mean",), target: str = "sales"
) -> dict[str, Column]:
    """Statistics of the previous rows, today excluded; null until the frame is full."""
    functions = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    out = {}
    for size in windows:
        frame = _by_date(keys).rowsBetween(-size, -1)
        full = F.count(target).over(frame) == size
        for stat in stats:
            out[f"rolling_{stat}_{size}"] = F.when(full, functions[stat](target).over(frame))
    return out


def expanding_mean(keys: Sequence[str], target: str = "sales") -> Column:
    return F.avg(target).over(_by_date(keys).rowsBetween(Window.unboundedPreceding, -1))


def training_features(series: DataFrame, keys: Sequence[str], lags: Sequence[int] = (1, 7), window: int = 7) -> DataFrame:
    """Calendar, pay days, lags and rolling mean; warm-up rows dropped."""
    timed = series.withColumns({**lag_columns(keys, lags), **rolling_columns(keys, [window])})
    return calendar.add_paydays(calendar.add_calendar(timed)).na.drop("any")


# The wide feature set.
WIDE_LAGS = [1, 7, 14, 21, 28]
WIDE_WINDOWS = [7, 14, 28]
WIDE_STATS = ["mean", "std", "min", "max"]


def wide_features(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Extended calendar, five lags, three rolling windows, expanding mean; warm-up dropped."""
    timed = series.withColumns(
        {
            **lag_columns(keys, WIDE_LAGS, prefix="lag"),
            **rolling_columns(keys, WIDE_WINDOWS, WIDE_STATS),
            "expanding_mean": expanding_mean(keys),
        }
    )
    return calendar.add_extended_calendar(timed).na.drop("any")


def centred_median(keys: Sequence[str], half: int = 3, target: str = "sales") -> Column:
    return F.percentile(target, F.lit(0.5)).over(_by_date(keys).rowsBetween(-half, half))


def repair_outliers(flagged: DataFrame, keys: Sequence[str], flag: str = "is_outlier") -> DataFrame:
    """Flagged days take the centred median; the old value stays as ``sales_original``."""
    median = flagged.withColumn("_median", centred_median(keys))
    return median.withColumns(
        {
            "sales_original": F.col("sales"),
            "sales": F.when(F.col(flag), F.col("_median")).otherwise(F.col("sales")),
        }
    ).drop("_median")


def weekday_profile(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, median and deviation per weekday of daily rows."""
    return series.groupBy(*keys, F.weekday("date").alias("day_of_week")).agg(
        F.avg("sales").alias("mean_sales"),
        F.percentile("sales", F.lit(0.5)).alias("median_sales"),
        F.stddev_samp("sales").alias("std_sales"),
    )


def best_and_worst_day(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    return profile.groupBy(*keys).agg(
        F.max_by("day_of_week", "mean_sales").alias("best_day"),
        F.min_by("day_of_week", "mean_sales").alias("worst_day"),
    )


def decompose(series: DataFrame, keys: Sequence[str], period: int) -> DataFrame:
    """Additive trend / seasonal / residual split with a centred moving average."""
    w = _by_date(keys)
    half = period // 2
    if period % 2:
        frame = w.rowsBetween(-half, half)
        trend = F.when(F.count("sales").over(frame) == period, F.avg("sales").over(frame))
    else:
        # Even period: both end values count half.
        full = w.rowsBetween(-half, half)
        inner = w.rowsBetween(-half + 1, half - 1)
        ends = (F.lag("sales", half).over(w) + F.lead("sales", half).over(w)) / 2
        trend = F.when(F.count("sales").over(full) == period + 1, (F.sum("sales").over(inner) + ends) / period)
    parts = series.withColumns({"trend": trend, "_row": F.row_number().over(w) - 1})
    parts = parts.withColumns({"_detrended": F.col("sales") - F.col("trend"), "_phase": F.col("_row") % period})
    parts = parts.withColumn("_mean", F.avg("_detrended").over(Window.partitionBy(*keys, "_phase")))
    centre = F.avg(F.when(F.col("_row") < period, F.col("_mean"))).over(Window.partitionBy(*keys))
    parts = parts.withColumn("seasonal", F.col("_mean") - centre)
    return parts.select(
        *keys, "date", "sales", "trend", "seasonal", (F.col("sales") - F.col("trend") - F.col("seasonal")).alias("resid")
    )


def autocorrelation(series: DataFrame, keys: Sequence[str], max_lag: int = 35, target: str = "sales") -> DataFrame:
    """Biased autocorrelation for lags 0..min(max_lag, n/2 - 1)."""
    whole = Window.partitionBy(*keys)
    centred = series.withColumns(
        {"_d": F.col(target) - F.avg(target).over(whole), "_n": F.count(target).over(whole)}
    )
    lagged = centred.select(
        *keys, "_d", "_n", *[F.lag("_d", k).over(_by_date(keys)).alias(f"_l{k}") for k in range(1, max_lag + 1)]
        , "date",
    )
    sums = lagged.groupBy(*keys).agg(
        F.max("_n").alias("n"),
        F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    entries = [
        F.struct(F.lit(k).alias("lag"), (F.col(f"_s{k}") / F.col("_s0")).alias("acf")) for k in range(max_lag + 1)
    ]
    limit = F.least(F.lit(max_lag), F.floor(F.col("n") / 2) - 1)
    return sums.select(*keys, "n", F.inline(F.array(*entries))).where(F.col("lag") <= F.when(F.col("n") / 2 > 1, limit).otherwise(0))


def partial_autocorrelation(acf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Durbin-Levinson recursion on the biased autocorrelation (at most 36 values per series), on arrays."""
    keys = list(keys)
    rows = acf.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("_rho"))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    times = lambda a, b: total(F.zip_with(a, b, lambda x, y: x * y))
    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        near = F.slice("_rho", F.lit(2), k - 1)
        last = F.try_divide(F.get("_rho", k) - times(phi, F.reverse(near)), 1.0 - times(phi, near))

        def with_last(v: Column) -> Column:
            fresh = F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - v * y), F.array(v))
            return F.struct(fresh.alias("phi"), F.concat(state["out"], F.array(v)).alias("out"))

        return F.get(F.transform(F.array(last), with_last), 0)

    lags = F.slice(F.sequence(F.lit(0), F.size("_rho")), F.lit(2), F.size("_rho") - 1)
    return rows.select(*keys, F.posexplode(F.aggregate(lags, start, step, lambda s: s["out"])).alias("lag", "pacf"))


def chrono_split(series: DataFrame, keys: Sequence[str], train_share: float = 0.8) -> DataFrame:
    """First int(share * n) days of a series are ``train``, the rest ``test``."""
    limit = F.floor(F.count(F.lit(1)).over(Window.partitionBy(*keys)) * F.lit(train_share))
    train = F.row_number().over(_by_date(keys)) <= limit
    return series.withColumn("split", F.when(train, "train").otherwise("test"))


def _fold_columns(series: DataFrame, keys: Sequence[str], n_splits: int) -> DataFrame:
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return series.withColumns(
        {
            "_pos": F.row_number().over(_by_date(keys)) - 1,
            "_n": n,
            "_size": F.floor(n / (n_splits + 1)),
        }
    )


def test_folds(series: DataFrame, keys: Sequence[str], n_splits: int) -> DataFrame:
    """Each row with the one fold it is tested in; rows tested nowhere are dropped."""
    rows = _fold_columns(series, keys, n_splits)
    fold = n_splits - 1 - F.floor((F.col("_n") - 1 - F.col("_pos")) / F.col("_size"))
    return rows.where(F.col("_size") > 0).withColumn("fold", fold.cast("int")).where("fold >= 0").drop("_pos", "_n", "_size")


def time_folds(series: DataFrame, keys: Sequence[str], n_splits: int) -> DataFrame:
    """Expanding-window folds: each row once per fold it belongs to, with its role."""
    rows = _fold_columns(series, keys, n_splits)
    rows = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (n_splits - F.col("fold")) * F.col("_size")
    role = F.when(F.col("_pos") < start, "train").when(F.col("_pos") < start + F.col("_size"), "test")
    return rows.withColumn("role", role).where("role is not null").drop("_pos", "_n", "_size")
