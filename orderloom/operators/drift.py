"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.ranks import melt, running_total
from orderloom.functions.tails import chi2_tail, kolmogorov_tail

# Columns that are never tested for drift.
EXCLUDED = [
    "sales", "prediction", "date", "ds", "anomaly_score", "is_anomaly", "anomaly_any",
    "anomaly_isoforest", "anomaly_zscore", "anomaly_iqr", "z_score", "is_outlier",
]
# Limits of the tests.
P_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
SMALL_REFERENCE = 1000
FEW_VALUES = 5
DATASET_SHARE = 0.5
PSI_EPS = 1e-6
PERFORMANCE_LIMIT = 0.10


def feature_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [n for n, t in df.dtypes if t in numeric and n not in EXCLUDED and n not in by]


def _sides(reference: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    a = melt(reference, columns, by).withColumn("_ref", F.lit(1))
    b = melt(current, [c for c in columns if c in current.columns], by).withColumn("_ref", F.lit(0))
    return a.unionByName(b)


def psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per column over equal-width reference bins.

    Current values outside the reference range fall in no bin but stay in the
    denominator.
    """
    ends = melt(reference, columns).groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # One entry per named column.
    bounds = ends.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("lo", "hi")))).alias("m")).scalar()
    long = _sides(reference, current, columns, []).withColumn("_b", F.element_at(bounds, F.col("metric")))
    flat = F.col("_b")["hi"] == F.col("_b")["lo"]
    lo = F.when(flat, F.col("_b")["lo"] - 0.5).otherwise(F.col("_b")["lo"])
    hi = F.when(flat, F.col("_b")["hi"] + 0.5).otherwise(F.col("_b")["hi"])
    slot = F.least(F.floor((F.col("value") - lo) * bins / (hi - lo)), F.lit(bins - 1))
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    counts = long.groupBy("metric", F.when(inside, slot).alias("bin")).agg(
        F.sum("_ref").alias("_r"), F.sum(1 - F.col("_ref")).alias("_c")
    )
    # At most bins + 1 rows per column.
    whole = Window.partitionBy("metric")
    shares = counts.withColumns(
        {
            "_rp": F.coalesce(F.try_divide(F.col("_r"), F.sum("_r").over(whole)), F.lit(0.0)) + PSI_EPS,
            "_cp": F.coalesce(F.try_divide(F.col("_c"), F.sum("_c").over(whole)), F.lit(0.0)) + PSI_EPS,
        }
    ).where("bin is not null")
    out = shares.groupBy("metric").agg(
        F.sum((F.col("_cp") - F.col("_rp")) * F.log(F.col("_cp") / F.col("_rp"))).alias("psi")
    )
    band = F.when(F.col("psi") < 0.1, "none").when(F.col("psi") < 0.2, "moderate").otherwise("significant")
    return out.withColumn("band", band)


def feature_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), tests: str = "by_size"
) -> DataFrame:
    """One row per group and feature: the test chosen, its score and the verdict.

    ``tests`` "p_value": Kolmogorov-Smirnov (more than five values), chi-square
    (up to five) or a two-proportion z-test (two), drift below p = 0.05.
    "distance": Wasserstein distance over the reference deviation, or
    Jensen-Shannon distance for few values, drift from 0.1.  "by_size", the
    common library rule: p-values for a reference of at most 1000 rows, where
    they still tell, and distances beyond.
    """
    if tests not in ("by_size", "p_value", "distance"):
        raise ValueError(f"unknown tests '{tests}'")
    by = list(by)
    columns = list(columns or feature_columns(reference, by))
    group = [*by, "metric"]
    counts = _sides(reference, current, columns, by).groupBy(*group, "value").agg(
        F.sum("_ref").alias("_r"), F.sum(1 - F.col("_ref")).alias("_c")
    )
    counts = counts.withColumn("_rv", F.col("_r") * F.col("value"))
    ranked = running_total(counts, [F.col("value")], {"_ru": "_r", "_cu": "_c", "_rs": "_rv"}, by=group, next_of="value")
    nr, nc = F.col("_ru_all"), F.col("_cu_all")
    gap = F.abs(F.try_divide(F.col("_ru"), nr) - F.try_divide(F.col("_cu"), nc))
    p, q = F.try_divide(F.col("_r"), nr), F.try_divide(F.col("_c"), nc)
    mid = (p + q) / 2
    expected = F.try_divide(F.col("_r") * nc, nr)
    away = F.col("value") - F.try_divide(F.col("_rs_all"), nr)
    stats = ranked.groupBy(*group).agg(
        F.max(nr).alias("n_ref"),
        F.max(nc).alias("n_cur"),
        F.count_if(F.col("_r") > 0).alias("n_values"),
        F.count(F.lit(1)).alias("_n_all"),
        F.max(gap).alias("ks"),
        F.sum(gap * (F.col("_next") - F.col("value"))).alias("_area"),
        F.sum(F.col("_r") * away * away).alias("_s2"),
        F.sum(F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)).alias("_js"),
        F.sum(F.when(expected > 0, (F.col("_c") - expected) * (F.col("_c") - expected) / expected)).alias("_chi"),
        F.count_if((F.col("_c") > 0) & (F.col("_r") == 0)).alias("_new"),
        F.max_by(p, F.col("value")).alias("_p"),
        F.max_by(q, F.col("value")).alias("_q"),
    )
    deviation = F.sqrt(F.try_divide(F.col("_s2"), F.col("n_ref")))
    small = F.col("n_ref") <= SMALL_REFERENCE if tests == "by_size" else F.lit(tests == "p_value")
    few, two = F.col("n_values") <= FEW_VALUES, F.col("_n_all") <= 2
    pooled = (F.col("_p") * F.col("n_ref") + F.col("_q") * F.col("n_cur")) / (F.col("n_ref") + F.col("n_cur"))
    noise = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_ref") + 1 / F.col("n_cur")))
    z = F.when(noise > 0, (F.col("_p") - F.col("_q")) / noise).otherwise(F.lit(0.0))
    stats = stats.withColumns(
        {
            "test": F.when(small & two, "z")
            .when(small & few, "chisquare")
            .when(small, "ks")
            .when(few, "jensenshannon")
            .otherwise("wasserstein"),
            "_ks_p": kolmogorov_tail(F.col("ks"), F.col("n_ref"), F.col("n_cur")),
            "_z_p": chi2_tail(F.when(small & two, z * z), F.lit(1)),
            # A value the reference never had makes the expected count zero.
            "_chi_p": F.when(F.col("_new") > 0, F.lit(0.0)).otherwise(
                chi2_tail(F.when(small & few, F.col("_chi")), F.greatest(F.col("n_values") - 1, F.lit(1)))
            ),
            "_w": F.col("_area") / F.greatest(deviation, F.lit(0.001)),
            "_jsd": F.sqrt(F.greatest(F.col("_js") / 2, F.lit(0.0))),
        }
    )
    score = (
        F.when(F.col("test") == "z", F.col("_z_p"))
        .when(F.col("test") == "chisquare", F.col("_chi_p"))
        .when(F.col("test") == "ks", F.col("_ks_p"))
        .when(F.col("test") == "jensenshannon", F.col("_jsd"))
        .otherwise(F.coalesce("_w", F.lit(0.0)))
    )
    drifted = F.when(small, F.col("score") < P_LIMIT).otherwise(F.col("score") >= DISTANCE_LIMIT)
    return stats.withColumn("score", score).select(
        *by, F.col("metric").alias("feature"), "test", "ks", "score", drifted.alias("drifted")
    )


def dataset_drift(per_feature: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of drifted features and the data set verdict."""
    share = F.avg(F.col("drifted").cast("double"))
    return per_feature.groupBy(*by).agg(
        share.alias("drift_share"),
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))).alias("drifted_features"),
        (share >= DATASET_SHARE).alias("dataset_drift"),
    )


def performance_check(
    predictions: DataFrame, baseline: DataFrame, by: Sequence[str], actual: str = "sales", predicted: str = "predicted"
) -> DataFrame:
    """Current MAE against ``baseline`` (by..., baseline_mae); alert above 10 percent."""
    current = predictions.groupBy(*by).agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("_mae"))
    joined = current.join(baseline, list(by))
    change = F.when(F.col("baseline_mae") > 0, (F.col("_mae") - F.col("baseline_mae")) / F.col("baseline_mae")).otherwise(0.0)
    return joined.select(
        *by,
        F.round("_mae", 2).alias("current_mae"),
        F.round("baseline_mae", 2).alias("baseline_mae"),
        F.round(change * 100, 2).alias("degradation_pct"),
        (change > PERFORMANCE_LIMIT).alias("alert"),
    )
