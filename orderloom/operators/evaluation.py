"""Forecast errors, residuals, leaderboards, confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.tails import chi2_tail

# Fixed value: the guard in the denominator of the fractional MAPE (double epsilon).
TINY = 2.220446049250313e-16

# Upper bounds of the prediction histogram.
PREDICTION_BOUNDS = [0.0, 500.0, 1000.0, 2000.0, 5000.0, 10000.0, 20000.0, 50000.0]


def long_predictions(df: DataFrame, keep: Sequence[str], models: dict[str, str]) -> DataFrame:
    """One row per model with its prediction; missing predictions are dropped."""
    entries = [F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("predicted")) for m, c in models.items()]
    return df.select(*keep, F.inline(F.array(*entries))).where("predicted is not null")


def error_metrics(df: DataFrame, by: Sequence[str], actual: str = "sales", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE and both MAPE forms.

    ``mape_frac`` divides by max(abs(actual), epsilon); ``mape_pct`` is in
    percent over the non-zero actuals and null when there are none.
    """
    y, p = F.col(actual), F.col(predicted)
    gap = F.abs(y - p)
    return df.groupBy(*by).agg(
        F.count(gap).alias("n"),
        F.avg(gap).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(gap / F.greatest(F.abs(y), F.lit(TINY))).alias("mape_frac"),
        F.avg(F.when(y != 0, 100.0 * gap / F.abs(y))).alias("mape_pct"),
    )


def residual_stats(df: DataFrame, by: Sequence[str], actual: str = "sales", predicted: str = "predicted") -> DataFrame:
    r = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(
        F.avg(r).alias("mean_resid"),
        F.stddev_pop(r).alias("std_resid"),
        F.min(r).alias("min_resid"),
        F.max(r).alias("max_resid"),
    )


def fold_summary(fold_metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population deviation of the fold MAE."""
    return fold_metrics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_folds"), F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae")
    )


def leaderboard(metrics: DataFrame, metric: str = "mae") -> DataFrame:
    return metrics.groupBy("model").agg(F.avg(metric).alias(f"mean_{metric}")).orderBy(f"mean_{metric}", "model")


def champion(metrics: DataFrame, by: Sequence[str] = (), metric: str = "mae") -> DataFrame:
    """The model with the lowest mean error, per group."""
    means = metrics.groupBy(*by, "model").agg(F.avg(metric).alias("_m"))
    return means.groupBy(*by).agg(
        F.min_by("model", F.struct("_m", "model")).alias("champion"), F.min("_m").alias(f"mean_{metric}")
    )


def results_table(baseline: DataFrame, advanced: DataFrame) -> DataFrame:
    """Both result tables with their type, the rank by MAE and the gain over the best baseline in percent."""
    best = baseline.agg(F.min("mae").alias("m")).scalar()
    rows = baseline.withColumn("type", F.lit("Baseline")).unionByName(advanced.withColumn("type", F.lit("Advanced")))
    # One row per model, so a single ranking window is small.
    return rows.withColumns(
        {
            "improvement_pct": 100.0 * (best - F.col("mae")) / best,
            "position": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("mae", "model")),
        }
    )


def forecast_pivot(long: DataFrame, keys: Sequence[str], models: Sequence[str], actual: str = "sales") -> DataFrame:
    """Forecasts of all models next to the actual value, one row per day."""
    wide = long.groupBy(*keys, "date").pivot("model", list(models)).agg(F.first("predicted"))
    actuals = long.groupBy(*keys, "date").agg(F.first(actual).alias("actual"))
    return actuals.join(wide, [*keys, "date"])


def prediction_buckets(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts of values up to each bound, the last bound being infinite."""
    bounds = [*PREDICTION_BOUNDS, float("inf")]
    row = df.groupBy(*by).agg(*[F.count_if(F.col(column) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)])
    entries = [
        F.struct(F.lit("+Inf" if b == float("inf") else str(int(b))).alias("le"), F.col(f"_b{i}").alias("n"))
        for i, b in enumerate(bounds)
    ]
    return row.select(*by, F.inline(F.array(*entries)))


def ljung_box(acf: DataFrame, keys: Sequence[str], lags: Sequence[int] = (7, 14)) -> DataFrame:
    """Portmanteau statistic and its chi-square tail at each lag."""
    part = F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag"))
    sums = acf.where("lag > 0").groupBy(*keys, "n").agg(
        *[F.sum(F.when(F.col("lag") <= k, part)).alias(f"_q{k}") for k in lags]
    )
    entries = [
        F.struct(F.lit(k).alias("lag"), (F.col("n") * (F.col("n") + 2) * F.col(f"_q{k}")).alias("statistic")) for k in lags
    ]
    return sums.select(*keys, F.inline(F.array(*entries))).withColumn("p_value", chi2_tail("statistic", "lag"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts for every pair of classes that occur as truth or prediction."""
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where("truth is not null and predicted is not null")
    names = counts.select(F.inline(F.array(F.struct(F.col("truth").alias("c")), F.struct(F.col("predicted").alias("c")))))
    # The class list of a classifier: as long as its label set.
    classes = names.agg(F.array_sort(F.collect_set("c")).alias("c")).scalar()
    rows = names.distinct().select(F.col("c").alias("truth"), F.explode(classes).alias("predicted"))
    return rows.join(counts, ["truth", "predicted"], "left").fillna({"n": 0})


def class_f1(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class from confusion counts; 0 where undefined."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("given"), hit.alias("hit")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("given"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    sums = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("given").alias("given"), F.sum("hit").alias("hit"))

    def share(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    return sums.select(
        "label",
        "support",
        share(F.col("hit"), F.col("given")).alias("precision"),
        share(F.col("hit"), F.col("support")).alias("recall"),
        share(2 * F.col("hit"), F.col("support") + F.col("given")).alias("f1"),
        F.col("hit"),
    )


def macro_scores(per_class: DataFrame) -> DataFrame:
    return per_class.agg(
        F.avg("f1").alias("f1_macro"),
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_classes"),
    )
