"""Outlier flags on daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def iqr_flags(series: DataFrame, keys: Sequence[str], flag: str = "is_outlier", factor: float = 1.5) -> DataFrame:
    """Fences from the non-zero days; a zero day is never a low outlier."""
    whole = Window.partitionBy(*keys)
    positive = F.when(F.col("sales") > 0, F.col("sales"))
    marked = series.withColumns(
        {
            "_q1": F.percentile(positive, F.lit(0.25)).over(whole),
            "_q3": F.percentile(positive, F.lit(0.75)).over(whole),
        }
    )
    spread = factor * (F.col("_q3") - F.col("_q1"))
    low = (F.col("sales") < F.col("_q1") - spread) & (F.col("sales") > 0)
    high = F.col("sales") > F.col("_q3") + spread
    return marked.withColumn(flag, F.coalesce(high | low, F.lit(False))).drop("_q1", "_q3")


def zscore_flags(series: DataFrame, keys: Sequence[str], flag: str = "anomaly_zscore", limit: float = 3.0) -> DataFrame:
    """Score against mean and population deviation of the non-zero days; zero days score 0."""
    whole = Window.partitionBy(*keys)
    positive = F.when(F.col("sales") > 0, F.col("sales"))
    mean, std = F.avg(positive).over(whole), F.stddev_pop(positive).over(whole)
    marked = series.withColumns({"_m": mean, "_s": std})
    score = F.when((F.col("sales") > 0) & (F.col("_s") > 0), (F.col("sales") - F.col("_m")) / F.col("_s"))
    return marked.withColumn("z_score", F.coalesce(score, F.lit(0.0))).withColumn(
        flag, F.abs("z_score") > limit
    ).drop("_m", "_s")


def combine_flags(flagged: DataFrame, flags: Sequence[str], out: str = "anomaly_any") -> DataFrame:
    any_flag = F.lit(False)
    for flag in flags:
        any_flag = any_flag | F.col(flag)
    return flagged.withColumn(out, any_flag)


def flag_summary(flagged: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Count and percent of flagged rows, one row per method."""
    row = flagged.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    entries = [
        F.struct(
            F.lit(f).alias("method"),
            F.col(f).alias("n_flagged"),
            F.try_divide(100.0 * F.col(f), F.col("_n")).alias("flagged_pct"),
        )
        for f in flags
    ]
    return row.select(F.inline(F.array(*entries)))


def method_list(flags: dict[str, str]):
    """Comma list of the methods whose flag is set."""
    return F.concat_ws(",", *[F.when(F.col(flag), F.lit(name)) for name, flag in flags.items()])
