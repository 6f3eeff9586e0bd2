"""Quality, drift, performance and retraining decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import drift, quality, retraining
from orderloom.operators import series as series_ops
from orderloom.plans.inputs import DAILY_SQL, KEYS, ORDERS_SQL, daily_series, orders_grain, rounded
from orderloom.plans.registry import query
from orderloom.plans.series_queries import test_predictions, _LONG_SQL

_CUT = "1998-05-01"


def _quality_frames(spark, d):
    """Reference days, and current days with nulls, a wild value, repeated dates and a lost column."""
    base = daily_series(spark, d).select(
        "series", "date", "sales", F.weekday("date").alias("day_of_week"), F.month("date").alias("month"),
        series_ops.lag_columns(KEYS, [1])["sales_lag_1"].alias("lag_1"),
    )
    reference = base.where(F.col("date") < _CUT)
    current = base.where(F.col("date") >= _CUT)
    day = F.dayofmonth("date")
    damaged = current.select(
        "series",
        "date",
        F.when((day == 15) & (F.col("month") == 6), F.col("sales") - 100000000.0).otherwise(F.col("sales")).alias("sales"),
        "day_of_week",
        F.when(day > 3, F.col("lag_1")).alias("lag_1"),
    )
    repeated = damaged.where(day == 28)
    return reference, damaged.unionByName(repeated)


_QUALITY_COLUMNS = ["date", "sales", "day_of_week", "month", "lag_1"]
_QUALITY_SQL = DAILY_SQL + f"""
, base AS (SELECT series, date, sales, CAST(isodow(date) - 1 AS INT) AS day_of_week, lag(sales) OVER (PARTITION BY series ORDER BY date) AS lag_1 FROM daily),
ref AS (SELECT * FROM base WHERE date < DATE '{_CUT}'),
dmg AS (SELECT series, date, CASE WHEN day(date) = 15 AND month(date) = 6 THEN sales - 100000000.0 ELSE sales END AS sales, day_of_week,
   CASE WHEN day(date) > 3 THEN lag_1 END AS lag_1 FROM base WHERE date >= DATE '{_CUT}'),
cur AS (SELECT * FROM dmg UNION ALL SELECT * FROM dmg WHERE day(date) = 28),
s AS (SELECT series, COUNT(*) AS n, SUM(CASE WHEN sales IS NULL THEN 1 ELSE 0 END) AS n_sales, SUM(CASE WHEN lag_1 IS NULL THEN 1 ELSE 0 END) AS n_lag,
   MIN(sales) AS lo, MAX(sales) AS hi, MIN(lag_1) AS lo_lag, MAX(lag_1) AS hi_lag, COUNT(*) - COUNT(DISTINCT date) AS dups FROM cur GROUP BY 1),
p AS (SELECT series, MIN(sales) AS rlo, MAX(sales) AS rhi, MIN(lag_1) AS rlo_lag, MAX(lag_1) AS rhi_lag FROM ref GROUP BY 1),
j AS (SELECT * FROM s JOIN p USING (series)),
report AS (
  SELECT series, 'missing_column' AS "check", 'month' AS column_name, 'error' AS severity, CAST(1 AS DOUBLE) AS value FROM j
  UNION ALL SELECT series, 'null_rate', 'lag_1', CASE WHEN 100.0 * n_lag / n > 50 THEN 'error' ELSE 'warning' END, round(100.0 * n_lag / n, 1) FROM j WHERE round(100.0 * n_lag / n, 1) > 5
  UNION ALL SELECT series, 'range_low', 'sales', 'warning', lo FROM j WHERE lo < rlo - 3 * (rhi - rlo)
  UNION ALL SELECT series, 'range_high', 'sales', 'warning', hi FROM j WHERE hi > rhi + 3 * (rhi - rlo)
  UNION ALL SELECT series, 'range_low', 'lag_1', 'warning', lo_lag FROM j WHERE lo_lag < rlo_lag - 3 * (rhi_lag - rlo_lag)
  UNION ALL SELECT series, 'range_high', 'lag_1', 'warning', hi_lag FROM j WHERE hi_lag > rhi_lag + 3 * (rhi_lag - rlo_lag)
  UNION ALL SELECT series, 'duplicate_dates', 'date', 'error', dups FROM j WHERE dups > 0
  UNION ALL SELECT series, 'min_rows', '', 'warning', n FROM j WHERE n < 7
  UNION ALL SELECT series, 'n_rows', '', 'stat', n FROM j
  UNION ALL SELECT series, 'n_cols', '', 'stat', 5 FROM j
  UNION ALL SELECT series, 'null_rate_all', '', 'stat', round(n_lag / (n * 5.0), 4) FROM j)
"""


def _report(spark, d):
    reference, current = _quality_frames(spark, d)
    profile = quality.reference_profile(reference, ["sales", "day_of_week", "month", "lag_1"], by=KEYS)
    return quality.quality_report(current, profile, _QUALITY_COLUMNS, by=KEYS)


@query("quality_report", "WITH " + _QUALITY_SQL + 'SELECT series, "check", column_name, severity, value FROM report')
def quality_report(spark, d):
    return rounded(_report(spark, d).drop("message"))


@query(
    "quality_verdict",
    "WITH " + _QUALITY_SQL + """SELECT series, CAST(COUNT(*) FILTER (severity = 'error') AS BIGINT) AS n_errors,
    CAST(COUNT(*) FILTER (severity = 'warning') AS BIGINT) AS n_warnings, CAST(COUNT(*) FILTER (severity = 'error') = 0 AS INT) AS is_valid FROM report GROUP BY 1""",
)
def quality_verdict(spark, d):
    return rounded(quality.quality_verdict(_report(spark, d), KEYS))


_PROFILE_COLUMNS = ["order_amount_brutto", "avg_item_price", "n_items"]


@query(
    "reference_profile",
    "WITH " + ORDERS_SQL + " UNION ALL ".join(f"""
    SELECT payment_name, '{c}' AS metric, round(CAST(MIN({c}) AS DOUBLE), 5) AS min, round(CAST(MAX({c}) AS DOUBLE), 5) AS max,
      round(AVG({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(quantile_cont(CAST({c} AS DOUBLE), 0.01), 5) AS q01,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.99), 5) AS q99 FROM og GROUP BY 1""" for c in _PROFILE_COLUMNS),
)
def reference_profile(spark, d):
    profile = quality.reference_profile(orders_grain(spark, d), _PROFILE_COLUMNS, by=["payment_name"])
    return rounded(profile.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)}), 5)


_DRIFT_FEATURES = ["order_amount_brutto", "n_items", "total_quantity", "day_of_week", "status_code", "is_large"]


def _drift_frames(spark, d):
    """Order features before and after a cut; later amounts are 40 percent higher."""
    og = orders_grain(spark, d).select(
        "date_add",
        "delivery_type",
        "order_amount_brutto",
        "n_items",
        "total_quantity",
        "day_of_week",
        F.when(F.col("payment_name") == "F", 0).when(F.col("payment_name") == "O", 1).otherwise(2).alias("status_code"),
        (F.col("n_items") > 4).cast("int").alias("is_large"),
    )
    early = og.where(F.col("date_add") < _CUT)
    late = og.where(F.col("date_add") >= _CUT).withColumn(
        "order_amount_brutto", F.col("order_amount_brutto") * 1.4
    )
    return early, late


_DRIFT_SQL = ORDERS_SQL + f"""
, f AS (SELECT CASE WHEN date_add < TIMESTAMP '{_CUT} 00:00:00' THEN 1 ELSE 0 END AS r, delivery_type,
    CASE WHEN date_add < TIMESTAMP '{_CUT} 00:00:00' THEN order_amount_brutto ELSE order_amount_brutto * CAST(1.4 AS DOUBLE) END AS order_amount_brutto,
    n_items, total_quantity, day_of_week, CASE payment_name WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS status_code,
    CAST(n_items > 4 AS INT) AS is_large FROM og),
long AS (""" + " UNION ALL ".join(
    f"SELECT r, delivery_type, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM f" for c in _DRIFT_FEATURES) + ")"


def _two_sample_sql(keys: str) -> str:
    """Running shares of both samples over the sorted distinct values."""
    return f"""
, c AS (SELECT {keys}, v, SUM(r) AS a, SUM(1 - r) AS b FROM long GROUP BY {keys}, v),
u AS (SELECT {keys}, v, a, b, SUM(a) OVER (PARTITION BY {keys}) AS na, SUM(b) OVER (PARTITION BY {keys}) AS nb,
   lead(v) OVER (PARTITION BY {keys} ORDER BY v) - v AS step,
   abs(SUM(a) OVER w / SUM(a) OVER (PARTITION BY {keys}) - SUM(b) OVER w / SUM(b) OVER (PARTITION BY {keys})) AS gap
   FROM c WINDOW w AS (PARTITION BY {keys} ORDER BY v ROWS UNBOUNDED PRECEDING)),
g AS (SELECT {keys}, MAX(na) AS na, MAX(nb) AS nb, MAX(gap) AS ks, SUM(gap * step) AS area, COUNT(*) FILTER (a > 0) AS nv, COUNT(*) AS nall,
   sqrt(SUM(a * v * v) / MAX(na) - (SUM(a * v) / MAX(na)) ** 2) AS sd,
   sqrt(SUM(CASE WHEN a > 0 THEN (a / na) * log2((a / na) / ((a / na + b / nb) / 2)) ELSE 0 END
      + CASE WHEN b > 0 THEN (b / nb) * log2((b / nb) / ((a / na + b / nb) / 2)) ELSE 0 END) / 2) AS js,
   arg_max(a / na, v) AS p, arg_max(b / nb, v) AS q,
   SUM(CASE WHEN a > 0 THEN (b - a * nb / na) ** 2 / (a * nb / na) END) AS chi
   FROM u GROUP BY {keys}),
l AS (SELECT *, (sqrt(na * nb / (na + nb)) + 0.12 + 0.11 / sqrt(na * nb / (na + nb))) * ks AS lam FROM g)
"""


_KS_P = """CASE WHEN lam < 0.3 THEN 1.0 ELSE least(greatest(
   list_sum(list_transform(range(1, 61), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) END"""


# Two-sided normal tail by the series of the error function.
_Z = "abs(p - q) / sqrt((p * na + q * nb) / (na + nb) * (1 - (p * na + q * nb) / (na + nb)) * (1 / na + 1 / nb)) / sqrt(2)"
_Z_P = f"""(1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60),
   lambda n: (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * ({_Z}) ** (2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))))"""


@query(
    "feature_drift",
    "WITH " + _DRIFT_SQL + _two_sample_sql("feature") + """
    SELECT feature, CASE WHEN nv <= 5 THEN 'jensenshannon' ELSE 'wasserstein' END AS test, round(ks, 6) AS ks,
      round(CASE WHEN nv <= 5 THEN js ELSE area / sd END, 6) AS score,
      CAST(CASE WHEN nv <= 5 THEN js ELSE area / sd END >= 0.1 AS INT) AS drifted FROM l WHERE na > 1000
    UNION ALL SELECT feature, 'ks', round(ks, 6), round(""" + _KS_P + """, 6), CAST(""" + _KS_P + """ < 0.05 AS INT) FROM l WHERE na <= 1000 AND nv > 5
    UNION ALL SELECT feature, 'chisquare', round(ks, 6), round(exp(-chi / 2), 6), CAST(exp(-chi / 2) < 0.05 AS INT) FROM l WHERE na <= 1000 AND nv = 3
    UNION ALL SELECT feature, 'z', round(ks, 6), round(""" + _Z_P + """, 6), CAST(""" + _Z_P + """ < 0.05 AS INT) FROM l WHERE na <= 1000 AND nall = 2""",
)
def feature_drift(spark, d):
    early, late = _drift_frames(spark, d)
    return rounded(drift.feature_drift(early, late, _DRIFT_FEATURES))


_DAILY_DRIFT_SQL = DAILY_SQL + """
, base AS (SELECT series, date, lag(sales, 1) OVER (PARTITION BY series ORDER BY date) AS lag_1,
    CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(month(date) AS INT) AS month FROM daily),
long AS (SELECT CASE WHEN date < DATE '1997-01-01' THEN 1 ELSE 0 END AS r, series, 'lag_1' AS feature, lag_1 AS v FROM base WHERE lag_1 IS NOT NULL
   UNION ALL SELECT CASE WHEN date < DATE '1997-01-01' THEN 1 ELSE 0 END, series, 'day_of_week', day_of_week FROM base
   UNION ALL SELECT CASE WHEN date < DATE '1997-01-01' THEN 1 ELSE 0 END, series, 'month', month FROM base)
""" + _two_sample_sql("series, feature")


def _daily_drift(spark, d):
    base = daily_series(spark, d).select(
        "series", "date", "sales", series_ops.lag_columns(KEYS, [1])["sales_lag_1"].alias("lag_1"),
        F.weekday("date").alias("day_of_week"), F.month("date").alias("month"),
    )
    early, late = base.where("date < '1997-01-01'"), base.where("date >= '1997-01-01'")
    return drift.feature_drift(early, late, by=KEYS)


@query(
    "ks_drift",
    "WITH " + _DAILY_DRIFT_SQL + f"SELECT series, feature, 'ks' AS test, round(ks, 6) AS ks, round({_KS_P}, 6) AS score, CAST({_KS_P} < 0.05 AS INT) AS drifted FROM l",
)
def ks_drift(spark, d):
    return rounded(_daily_drift(spark, d))


@query(
    "dataset_drift",
    "WITH " + _DAILY_DRIFT_SQL + f""", v AS (SELECT series, feature, {_KS_P} < 0.05 AS drifted FROM l)
    SELECT series, round(AVG(CAST(drifted AS INT)), 6) AS drift_share, CAST(COUNT(*) FILTER (drifted) AS BIGINT) AS number_of_drifted_columns,
      COALESCE(string_agg(feature, ',' ORDER BY feature) FILTER (drifted), '') AS drifted_features,
      CAST(AVG(CAST(drifted AS INT)) >= 0.5 AS INT) AS dataset_drift FROM v GROUP BY 1""",
)
def dataset_drift(spark, d):
    return rounded(drift.dataset_drift(_daily_drift(spark, d), KEYS))


@query(
    "psi",
    "WITH " + _DRIFT_SQL + """
    , b AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM long WHERE r = 1 GROUP BY 1),
    s AS (SELECT feature, r, CASE WHEN v BETWEEN lo AND hi THEN least(floor((v - lo) * 10 / (hi - lo)), 9) END AS bin FROM long JOIN b USING (feature)),
    c AS (SELECT feature, bin, SUM(r) AS a, SUM(1 - r) AS k FROM s GROUP BY 1, 2),
    h AS (SELECT feature, bin, a / SUM(a) OVER (PARTITION BY feature) + 1e-6 AS rp, k / SUM(k) OVER (PARTITION BY feature) + 1e-6 AS cp FROM c)
    , t AS (SELECT feature AS metric, SUM((cp - rp) * ln(cp / rp)) AS psi FROM h WHERE bin IS NOT NULL GROUP BY 1)
    SELECT metric, round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS band FROM t""",
)
def psi(spark, d):
    early, late = _drift_frames(spark, d)
    return rounded(drift.psi(early, late, _DRIFT_FEATURES))


def _performance(spark, d):
    """Moving average as production model, the lag-7 error as its earlier baseline."""
    long = test_predictions(spark, d)
    current = long.where("model = 'Naive-1'")
    baseline = long.where("model = 'Moving Avg (7)'").groupBy(*KEYS).agg(
        F.avg(F.abs(F.col("sales") - F.col("predicted"))).alias("baseline_mae")
    )
    return drift.performance_check(current, baseline, KEYS)


_PERF_SQL = DAILY_SQL + _LONG_SQL + """
, perf AS (SELECT series, AVG(abs(sales - predicted)) FILTER (model = 'Naive-1') AS mae,
   AVG(abs(sales - predicted)) FILTER (model = 'Moving Avg (7)') AS base FROM long GROUP BY 1)
"""


@query(
    "performance_check",
    "WITH " + _PERF_SQL + """SELECT series, round(mae, 2) AS current_mae, round(base, 2) AS baseline_mae,
    round(100 * (mae - base) / base, 2) AS degradation_pct, CAST((mae - base) / base > 0.1 AS INT) AS alert FROM perf""",
)
def performance_check(spark, d):
    return rounded(_performance(spark, d))


@query(
    "retrain_triggers",
    "WITH " + _PERF_SQL.rstrip() + ", " + _DAILY_DRIFT_SQL.split(DAILY_SQL)[1].strip().lstrip(",").replace("long AS", "dlong AS").replace("FROM long", "FROM dlong") + f"""
    , st AS (SELECT series, MAX(date) AS last_day, COUNT(*) AS new_rows FROM daily WHERE date >= DATE '2001-07-01' GROUP BY 1),
    dd AS (SELECT series, COUNT(*) FILTER ({_KS_P} < 0.05) AS k, AVG(CAST({_KS_P} < 0.05 AS INT)) >= 0.5 AS flag FROM l GROUP BY 1),
    x AS (SELECT st.series, epoch(TIMESTAMP '2001-08-10 00:00:00' - CAST(last_day AS TIMESTAMP)) / 3600.0 AS h, new_rows,
       (mae - base) / base > 0.1 AS alert, round(100 * (mae - base) / base, 2) AS deg, k, flag
       FROM st JOIN perf USING (series) JOIN dd USING (series))
    SELECT series, round(h, 1) AS hours_since_last_retrain, CAST(h > 168 OR alert OR flag AS INT) AS should_retrain,
      concat_ws('; ', CASE WHEN h > 168 THEN 'Time-based: ' || CAST(CAST(round(h) AS BIGINT) AS VARCHAR) || 'h since last retrain (threshold: 168h)' END,
        CASE WHEN alert THEN 'Performance-based: MAE degraded by ' || printf('%.1f', deg) || '%' END,
        CASE WHEN flag THEN 'Data-based: Drift detected in ' || CAST(k AS VARCHAR) || ' features' END) AS reasons,
      CAST(new_rows >= 30 AS INT) AS sufficient_new_data FROM x""",
)
def retrain_triggers(spark, d):
    """Last training assumed on the last day of each series, ten days before now."""
    state = daily_series(spark, d).where("date >= '2001-07-01'").groupBy(*KEYS).agg(
        F.max("date").cast("timestamp").alias("last_retrain"), F.count(F.lit(1)).alias("new_rows")
    )
    out = retraining.retrain_triggers(
        state, _performance(spark, d), drift.dataset_drift(_daily_drift(spark, d), KEYS), KEYS,
        F.lit("2001-08-10 00:00:00").cast("timestamp"),
    )
    return rounded(out)


@query(
    "improvement_gate",
    "WITH " + _PERF_SQL + """SELECT p.series, round(base, 4) AS new_mae, round(mae, 4) AS current_mae,
    CAST(mae IS NULL OR base < mae AS INT) AS register FROM perf p""",
)
def improvement_gate(spark, d):
    long = test_predictions(spark, d)
    mae = F.avg(F.abs(F.col("sales") - F.col("predicted")))
    new = long.where("model = 'Moving Avg (7)'").groupBy(*KEYS).agg(mae.alias("new_mae"))
    old = long.where("model = 'Naive-1'").groupBy(*KEYS).agg(mae.alias("current_mae"))
    return rounded(retraining.improvement_gate(new, old, KEYS), 4)
