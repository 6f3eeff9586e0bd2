"""Daily series: spine, features, repair, decomposition, folds, baselines, metrics."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orderloom.functions import calendar
from orderloom.operators import anomalies, evaluation
from orderloom.operators import profiles
from orderloom.operators import series as ops
from orderloom.plans.inputs import DAILY_SQL, KEYS, daily_series, observed_days, rounded
from orderloom.plans.registry import query

# Easter Sundays of the years the order dates cover, listed for the SQL side.
_EASTER = "('1995-04-16'),('1996-04-07'),('1997-03-30'),('1998-04-12'),('1999-04-04'),('2000-04-23'),('2001-04-15')"
HOLIDAY_SQL = f"""
easter AS (SELECT CAST(col0 AS DATE) AS e FROM (VALUES {_EASTER})),
holidays AS (
  SELECT e + CAST(o AS INTEGER) AS h FROM easter, (SELECT UNNEST([0, 1, 49, 60]) AS o)
  UNION SELECT make_date(y, m, dd) FROM (SELECT UNNEST(range(1995, 2002)) AS y) CROSS JOIN
    (VALUES (1,1),(5,1),(5,3),(8,15),(11,1),(11,11),(12,25),(12,26)) AS f(m, dd))
"""
_CAL = """CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month, CAST(month(date) AS INT) AS month,
  CAST(quarter(date) AS INT) AS quarter, CAST(year(date) AS INT) AS year, CAST(isodow(date) IN (6, 7) AS INT) AS is_weekend,
  CAST(date IN (SELECT h FROM holidays) AS INT) AS is_holiday,
  CAST(day(date) IN (1,2,3) AS INT) AS is_payday_1st, CAST(day(date) IN (10,11,12) AS INT) AS is_payday_10th,
  CAST(day(date) IN (1,2,3,10,11,12) AS INT) AS is_payday"""
# Moves exact ties off the rounding boundary, where the two engines may differ.
NUDGE = 1e-7
_W = "PARTITION BY series ORDER BY date"


def _roll(stat: str, size: int) -> str:
    frame = f"({_W} ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN COUNT(sales) OVER {frame} = {size} THEN {stat}(sales) OVER {frame} END"


@query("daily_sales", "WITH " + DAILY_SQL + "SELECT series, CAST(date AS VARCHAR) AS date, sales FROM observed")
def daily_sales(spark, d):
    return rounded(observed_days(spark, d))


@query("daily_sales_gapfilled", "WITH " + DAILY_SQL + "SELECT series, CAST(date AS VARCHAR) AS date, sales FROM daily")
def daily_sales_gapfilled(spark, d):
    return rounded(daily_series(spark, d))


@query(
    "daily_features",
    "WITH " + DAILY_SQL + "," + HOLIDAY_SQL + f"""
    , t AS (SELECT *, lag(sales, 1) OVER ({_W}) AS sales_lag_1, lag(sales, 7) OVER ({_W}) AS sales_lag_7,
            round({_roll('AVG', 7)}, 6) AS rolling_mean_7 FROM daily)
    SELECT series, CAST(date AS VARCHAR) AS date, sales, sales_lag_1, sales_lag_7, rolling_mean_7, {_CAL}
    FROM t WHERE sales_lag_7 IS NOT NULL AND rolling_mean_7 IS NOT NULL""",
)
def daily_features(spark, d):
    return rounded(ops.training_features(daily_series(spark, d), KEYS))


@query(
    "holiday_flags",
    "WITH " + DAILY_SQL + "," + HOLIDAY_SQL + f"SELECT series, CAST(date AS VARCHAR) AS date, {_CAL} FROM daily",
)
def holiday_flags(spark, d):
    return rounded(calendar.add_paydays(calendar.add_calendar(daily_series(spark, d).drop("sales"))))


@query(
    "lag_features",
    "WITH " + DAILY_SQL + "SELECT series, CAST(date AS VARCHAR) AS date, sales, " + ", ".join(
        f"lag(sales, {k}) OVER ({_W}) AS lag_{k}" for k in ops.WIDE_LAGS) + " FROM daily",
)
def lag_features(spark, d):
    return rounded(daily_series(spark, d).withColumns(ops.lag_columns(KEYS, ops.WIDE_LAGS, prefix="lag")))


_SQL_STAT = {"mean": "AVG", "std": "stddev_samp", "min": "MIN", "max": "MAX"}
_ROLLS = ", ".join(f"round({_roll(_SQL_STAT[s], w)}, 4) AS rolling_{s}_{w}" for w in ops.WIDE_WINDOWS for s in ops.WIDE_STATS)


@query("rolling_stats", "WITH " + DAILY_SQL + f"SELECT series, CAST(date AS VARCHAR) AS date, sales, {_ROLLS} FROM daily")
def rolling_stats(spark, d):
    return rounded(daily_series(spark, d).withColumns(ops.rolling_columns(KEYS, ops.WIDE_WINDOWS, ops.WIDE_STATS)), 4)


_EXPAND = f"AVG(sales) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("expanding_mean", "WITH " + DAILY_SQL + f"SELECT series, CAST(date AS VARCHAR) AS date, round({_EXPAND} + 1e-7, 4) AS expanding_mean FROM daily")
def expanding_mean(spark, d):
    return rounded(daily_series(spark, d).select("series", "date", (ops.expanding_mean(KEYS) + NUDGE).alias("expanding_mean")), 4)


def _cyc(name: str, value: str, period: int) -> str:
    angle = f"{value} * {2 * math.pi!r}::DOUBLE / {period}"
    return f"round(sin({angle}), 4) + 0.0 AS {name}_sin, round(cos({angle}), 4) + 0.0 AS {name}_cos"


_EXTENDED = f"""CAST(isodow(date) - 1 AS INT) AS weekday, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day_of_month,
  CAST(weekofyear(date) AS INT) AS week_of_year, CAST(dayofyear(date) AS INT) AS day_of_year,
  CAST(isodow(date) IN (6, 7) AS INT) AS is_weekend, {_cyc('weekday', '(isodow(date) - 1)', 7)},
  {_cyc('month', 'month(date)', 12)}, {_cyc('day', 'dayofyear(date)', 365)}"""


@query(
    "full_features",
    "WITH " + DAILY_SQL + f", t AS (SELECT series, date, sales, " + ", ".join(
        f"lag(sales, {k}) OVER ({_W}) AS lag_{k}" for k in ops.WIDE_LAGS
    ) + f", {_ROLLS}, round({_EXPAND} + 1e-7, 4) AS expanding_mean FROM daily) SELECT series, CAST(date AS VARCHAR) AS date, sales, "
    + ", ".join(f"lag_{k}" for k in ops.WIDE_LAGS) + ", "
    + ", ".join(f"rolling_{s}_{w}" for w in ops.WIDE_WINDOWS for s in ops.WIDE_STATS)
    + f", expanding_mean, {_EXTENDED} FROM t WHERE lag_28 IS NOT NULL AND rolling_mean_28 IS NOT NULL",
)
def full_features(spark, d):
    wide = ops.wide_features(daily_series(spark, d), KEYS)
    return rounded(wide.withColumn("expanding_mean", F.col("expanding_mean") + NUDGE), 4)


_IQR_SQL = """
, q AS (SELECT series, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3 FROM daily WHERE sales > 0 GROUP BY 1),
flagged AS (SELECT d.series, d.date, d.sales,
   (d.sales > q3 + 1.5 * (q3 - q1) OR (d.sales < q1 - 1.5 * (q3 - q1) AND d.sales > 0)) AS is_outlier
   FROM daily d JOIN q USING (series))
"""


@query(
    "rolling_median_repair",
    "WITH " + DAILY_SQL + _IQR_SQL + f"""
    , m AS (SELECT *, quantile_cont(sales, 0.5) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS med FROM flagged)
    SELECT series, CAST(date AS VARCHAR) AS date, CAST(is_outlier AS INT) AS is_outlier, sales AS sales_original,
           round(CASE WHEN is_outlier THEN med ELSE sales END, 6) AS sales FROM m""",
)
def rolling_median_repair(spark, d):
    return rounded(ops.repair_outliers(anomalies.iqr_flags(daily_series(spark, d), KEYS), KEYS))


_Z_SQL = """
, z AS (SELECT series, AVG(sales) AS m, stddev_pop(sales) AS s FROM daily WHERE sales > 0 GROUP BY 1),
scored AS (SELECT d.series, d.date, d.sales, CASE WHEN d.sales > 0 THEN (d.sales - m) / s ELSE 0 END AS z_score
   FROM daily d JOIN z USING (series))
"""


@query(
    "zscore_flags",
    "WITH " + DAILY_SQL + _Z_SQL + """SELECT series, CAST(date AS VARCHAR) AS date, sales, round(z_score, 6) + 0.0 AS z_score,
    CAST(abs(z_score) > 3 AS INT) AS anomaly_zscore FROM scored""",
)
def zscore_flags(spark, d):
    return rounded(anomalies.zscore_flags(daily_series(spark, d), KEYS))


def _flagged(spark, d):
    marked = anomalies.zscore_flags(daily_series(spark, d), KEYS)
    marked = anomalies.iqr_flags(marked, KEYS, "anomaly_iqr")
    return anomalies.combine_flags(marked, ["anomaly_zscore", "anomaly_iqr"])


_FLAGS_SQL = _IQR_SQL + ", " + _Z_SQL.strip().lstrip(",") + """
, flags AS (SELECT series, date, f.sales, z_score, abs(z_score) > 3 AS anomaly_zscore, is_outlier AS anomaly_iqr,
   (abs(z_score) > 3 OR is_outlier) AS anomaly_any FROM flagged f JOIN scored s USING (series, date))
"""


@query(
    "outlier_days",
    "WITH " + DAILY_SQL + _FLAGS_SQL + """
    SELECT series, CAST(date AS VARCHAR) AS date, sales,
      concat_ws(',', CASE WHEN anomaly_zscore THEN 'zscore' END, CASE WHEN anomaly_iqr THEN 'iqr' END) AS methods
    FROM flags WHERE anomaly_any ORDER BY sales DESC, date, series LIMIT 10""",
)
def outlier_days(spark, d):
    days = _flagged(spark, d).where("anomaly_any").withColumn(
        "methods", anomalies.method_list({"zscore": "anomaly_zscore", "iqr": "anomaly_iqr"})
    )
    top = profiles.top_rows(days, [F.desc("sales"), F.col("date"), F.col("series")], 10)
    return rounded(top.select("series", "date", "sales", "methods"))


@query(
    "anomaly_summary",
    "WITH " + DAILY_SQL + _FLAGS_SQL + " UNION ALL ".join(
        f"""SELECT '{f}' AS method, CAST(COUNT(*) FILTER ({f}) AS BIGINT) AS n_flagged,
        round(100.0 * COUNT(*) FILTER ({f}) / COUNT(*), 6) AS flagged_pct FROM flags"""
        for f in ("anomaly_zscore", "anomaly_iqr", "anomaly_any")),
)
def anomaly_summary(spark, d):
    return rounded(anomalies.flag_summary(_flagged(spark, d), ["anomaly_zscore", "anomaly_iqr", "anomaly_any"]))


def _decompose_sql(p: int) -> str:
    half = p // 2
    full = f"({_W} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    if p % 2:
        trend = f"CASE WHEN COUNT(*) OVER {full} = {p} THEN AVG(sales) OVER {full} END"
    else:
        trend = (f"CASE WHEN COUNT(*) OVER {full} = {p + 1} THEN (SUM(sales) OVER {full} - "
                 f"(lag(sales, {half}) OVER ({_W}) + lead(sales, {half}) OVER ({_W})) / 2) / {p} END")
    return "WITH " + DAILY_SQL + f"""
    , t AS (SELECT *, {trend} AS trend, (row_number() OVER ({_W}) - 1) % {p} AS phase FROM daily),
    s AS (SELECT series, phase, AVG(sales - trend) AS m FROM t GROUP BY 1, 2),
    c AS (SELECT series, phase, m - AVG(m) OVER (PARTITION BY series) AS seasonal FROM s)
    SELECT t.series, CAST(t.date AS VARCHAR) AS date, t.sales, round(t.trend, 4) AS trend, round(c.seasonal, 4) AS seasonal,
           round(t.sales - t.trend - c.seasonal, 4) + 0.0 AS resid FROM t JOIN c USING (series, phase)"""


@query("seasonal_decompose_7", _decompose_sql(7))
def seasonal_decompose_7(spark, d):
    return rounded(ops.decompose(daily_series(spark, d), KEYS, 7), 4)


@query("seasonal_decompose_30", _decompose_sql(30))
def seasonal_decompose_30(spark, d):
    return rounded(ops.decompose(daily_series(spark, d), KEYS, 30), 4)


@query(
    "acf",
    "WITH " + DAILY_SQL + """
    , c AS (SELECT series, sales - AVG(sales) OVER (PARTITION BY series) AS x, row_number() OVER (PARTITION BY series ORDER BY date) AS i,
            COUNT(*) OVER (PARTITION BY series) AS n FROM daily),
    v AS (SELECT series, SUM(x * x) AS s FROM c GROUP BY 1)
    SELECT a.series, a.n, CAST(b.i - a.i AS INT) AS lag, round(SUM(a.x * b.x) / MAX(v.s), 6) + 0.0 AS acf
    FROM c a JOIN c b ON a.series = b.series AND b.i - a.i BETWEEN 0 AND 35 JOIN v ON v.series = a.series
    GROUP BY 1, 2, 3""",
)
def acf(spark, d):
    return rounded(ops.autocorrelation(daily_series(spark, d), KEYS))


_ACF_SQL = """
, c AS (SELECT series, sales - AVG(sales) OVER (PARTITION BY series) AS x, row_number() OVER (PARTITION BY series ORDER BY date) AS i,
        COUNT(*) OVER (PARTITION BY series) AS n FROM daily),
v AS (SELECT series, SUM(x * x) AS s FROM c GROUP BY 1),
acf AS (SELECT a.series, a.n, CAST(b.i - a.i AS INT) AS lag, SUM(a.x * b.x) / MAX(v.s) AS r
  FROM c a JOIN c b ON a.series = b.series AND b.i - a.i BETWEEN 0 AND 35 JOIN v ON v.series = a.series GROUP BY 1, 2, 3)
"""


@query(
    "pacf",
    "WITH RECURSIVE " + DAILY_SQL + _ACF_SQL + """
    , listed AS (SELECT series, list(r ORDER BY lag) AS rho FROM acf GROUP BY 1),
    walk AS (SELECT series, rho, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS last FROM listed
      UNION ALL SELECT series, rho, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - next * phi[k + 1 - j]), next), next
      FROM (SELECT *, (rho[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[k + 2 - j])), 0))
        / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[j + 1])), 0)) AS next FROM walk WHERE k + 1 < len(rho)))
    SELECT series, CAST(k AS INT) AS lag, round(last, 6) + 0.0 AS pacf FROM walk""",
)
def pacf(spark, d):
    return rounded(ops.partial_autocorrelation(ops.autocorrelation(daily_series(spark, d), KEYS), KEYS))


@query(
    "ljung_box",
    # The tail of chi-square is one less the series of the lower incomplete gamma function.
    "WITH " + DAILY_SQL + _ACF_SQL + """
    , q AS (SELECT series, m AS lag, n * (n + 2) * SUM(r * r / (n - acf.lag)) AS statistic FROM acf, (VALUES (7), (14)) l(m)
      WHERE acf.lag BETWEEN 1 AND m GROUP BY series, n, m)
    SELECT series, CAST(lag AS INT) AS lag, round(statistic, 6) AS statistic,
      CASE WHEN statistic > 2000 THEN 0.0 ELSE round(1 - (SELECT SUM(exp((lag / 2.0 + i) * ln(statistic / 2) - statistic / 2 - lgamma(lag / 2.0 + i + 1))) FROM range(0, 3000) g(i)), 6) + 0.0 END AS p_value
    FROM q""",
)
def ljung_box(spark, d):
    return rounded(evaluation.ljung_box(ops.autocorrelation(daily_series(spark, d), KEYS), KEYS))


_SPLIT_SQL = f"""
, split AS (SELECT *, CASE WHEN row_number() OVER ({_W}) <= floor(CAST(0.8 AS DOUBLE) * COUNT(*) OVER (PARTITION BY series))
    THEN 'train' ELSE 'test' END AS split,
    lag(sales, 1) OVER ({_W}) AS naive_1, lag(sales, 7) OVER ({_W}) AS naive_7, {_roll('AVG', 7)} AS moving_avg_7 FROM daily)
"""


@query("chrono_split", "WITH " + DAILY_SQL + _SPLIT_SQL + "SELECT series, CAST(date AS VARCHAR) AS date, sales, split FROM split")
def chrono_split(spark, d):
    return rounded(ops.chrono_split(daily_series(spark, d), KEYS))


_FOLD_SQL = f"""
, pos AS (SELECT *, row_number() OVER ({_W}) - 1 AS p, COUNT(*) OVER (PARTITION BY series) AS n FROM daily),
folds AS (SELECT pos.*, f.fold, n // 4 AS t FROM pos, (SELECT CAST(UNNEST([0, 1, 2]) AS INT) AS fold) f),
roles AS (SELECT *, CASE WHEN p < n - (3 - fold) * t THEN 'train' WHEN p < n - (2 - fold) * t THEN 'test' END AS role FROM folds)
"""


@query(
    "time_series_folds",
    "WITH " + DAILY_SQL + _FOLD_SQL + "SELECT series, CAST(date AS VARCHAR) AS date, sales, fold, role FROM roles WHERE role IS NOT NULL",
)
def time_series_folds(spark, d):
    return rounded(ops.time_folds(daily_series(spark, d), KEYS, 3))


BASELINES = {"Naive-1": "naive_1", "Naive-7": "naive_7", "Moving Avg (7)": "moving_avg_7"}


def with_baselines(series):
    return series.withColumns(
        {
            **{f"naive_{k}": c for k, c in zip((1, 7), ops.lag_columns(KEYS, [1, 7]).values())},
            "moving_avg_7": ops.rolling_columns(KEYS, [7])["rolling_mean_7"],
        }
    )


def _baseline_query(name: str, column: str):
    sql = "WITH " + DAILY_SQL + _SPLIT_SQL + f"""SELECT series, CAST(date AS VARCHAR) AS date, sales,
        round({column}, 6) AS predicted FROM split WHERE split = 'test'"""

    @query(name, sql)
    def run(spark, d):
        rows = ops.chrono_split(with_baselines(daily_series(spark, d)), KEYS).where("split = 'test'")
        return rounded(rows.select("series", "date", "sales", F.col(column).alias("predicted")))

    return run


naive_1 = _baseline_query("naive_1", "naive_1")
naive_7 = _baseline_query("naive_7", "naive_7")
moving_avg_7 = _baseline_query("moving_avg_7", "moving_avg_7")


def test_predictions(spark, d):
    rows = ops.chrono_split(with_baselines(daily_series(spark, d)), KEYS).where("split = 'test'")
    return evaluation.long_predictions(rows, ["series", "date", "sales"], BASELINES)


_LONG_SQL = _SPLIT_SQL + ", long AS (" + " UNION ALL ".join(
    f"SELECT series, date, sales, '{m}' AS model, {c} AS predicted FROM split WHERE split = 'test' AND {c} IS NOT NULL"
    for m, c in BASELINES.items()) + ")"
_METRIC_SQL = """COUNT(*) AS n, round(AVG(abs(sales - predicted)), 4) AS mae,
  round(sqrt(AVG((sales - predicted) * (sales - predicted))), 4) AS rmse,
  round(AVG(100.0 * abs(sales - predicted) / abs(sales)) FILTER (sales <> 0), 4) AS mape_pct"""


@query("baseline_metrics", "WITH " + DAILY_SQL + _LONG_SQL + f"SELECT series, model, {_METRIC_SQL} FROM long GROUP BY 1, 2")
def baseline_metrics(spark, d):
    # The fractional form explodes on days without sales, so it is left to the tests.
    return rounded(evaluation.error_metrics(test_predictions(spark, d), ["series", "model"]).drop("mape_frac"), 4)


@query(
    "residual_stats",
    "WITH " + DAILY_SQL + _LONG_SQL + """SELECT series, model, round(AVG(sales - predicted), 4) + 0.0 AS mean_resid,
    round(stddev_pop(sales - predicted), 4) AS std_resid, round(MIN(sales - predicted), 4) AS min_resid,
    round(MAX(sales - predicted), 4) AS max_resid FROM long GROUP BY 1, 2""",
)
def residual_stats(spark, d):
    return rounded(evaluation.residual_stats(test_predictions(spark, d), ["series", "model"]), 4)


def _cv_folds(spark, d, n_splits=5):
    rows = ops.test_folds(with_baselines(daily_series(spark, d)), KEYS, n_splits)
    long = evaluation.long_predictions(rows, ["series", "date", "sales", "fold"], BASELINES)
    return evaluation.error_metrics(long, ["series", "model", "fold"]).where("n >= 7")


_CV_SQL = f"""
, b AS (SELECT *, lag(sales, 1) OVER ({_W}) AS naive_1, lag(sales, 7) OVER ({_W}) AS naive_7, {_roll('AVG', 7)} AS moving_avg_7,
   row_number() OVER ({_W}) - 1 AS p, COUNT(*) OVER (PARTITION BY series) AS n FROM daily),
f AS (SELECT b.*, fold FROM b, (SELECT UNNEST([0, 1, 2, 3, 4]) AS fold)
   WHERE p >= n - (5 - fold) * (n // 6) AND p < n - (4 - fold) * (n // 6)),
e AS (""" + " UNION ALL ".join(
    f"SELECT series, fold, '{m}' AS model, abs(sales - {c}) AS gap FROM f WHERE {c} IS NOT NULL" for m, c in BASELINES.items()
) + """),
cv AS (SELECT series, fold, model, AVG(gap) AS mae FROM e GROUP BY 1, 2, 3 HAVING COUNT(*) >= 7)
"""


@query(
    "baseline_cv",
    "WITH " + DAILY_SQL + _CV_SQL + """SELECT series, model, COUNT(*) AS n_folds, round(AVG(mae), 4) AS mean_mae,
    round(stddev_pop(mae), 4) AS std_mae FROM cv GROUP BY 1, 2""",
)
def baseline_cv(spark, d):
    return rounded(evaluation.fold_summary(_cv_folds(spark, d), ["series", "model"]), 4)


@query("leaderboard", "WITH " + DAILY_SQL + _CV_SQL + "SELECT model, round(AVG(mae), 4) AS mean_mae FROM cv GROUP BY 1")
def leaderboard(spark, d):
    return rounded(evaluation.leaderboard(_cv_folds(spark, d)), 4)


@query(
    "champions",
    "WITH " + DAILY_SQL + _CV_SQL + """, m AS (SELECT series, model, AVG(mae) AS a FROM cv GROUP BY 1, 2)
    SELECT series, arg_min(model, a) AS champion, round(MIN(a), 4) AS mean_mae FROM m GROUP BY 1""",
)
def champions(spark, d):
    return rounded(evaluation.champion(_cv_folds(spark, d), ["series"]), 4)


@query(
    "results_table",
    "WITH " + DAILY_SQL + _LONG_SQL + """
    , m AS (SELECT model, AVG(abs(sales - predicted)) AS mae FROM long GROUP BY 1),
    best AS (SELECT MIN(mae) AS b FROM m WHERE model LIKE 'Naive%')
    SELECT model, round(mae, 4) AS mae, CASE WHEN model LIKE 'Naive%' THEN 'Baseline' ELSE 'Advanced' END AS type,
      round(100 * (b - mae) / b, 4) + 0.0 AS improvement_pct, CAST(row_number() OVER (ORDER BY mae, model) AS INT) AS position FROM m, best""",
)
def results_table(spark, d):
    """The moving average plays the advanced model against the two naive ones."""
    metrics = evaluation.error_metrics(test_predictions(spark, d), ["model"]).select("model", "mae")
    naive = F.col("model").startswith("Naive")
    return rounded(evaluation.results_table(metrics.where(naive), metrics.where(~naive)), 4)


@query(
    "forecast_pivot",
    "WITH " + DAILY_SQL + _SPLIT_SQL + """SELECT series, CAST(date AS VARCHAR) AS date, sales AS actual, naive_1 AS "Naive-1",
    naive_7 AS "Naive-7", round(moving_avg_7, 6) AS "Moving Avg (7)" FROM split WHERE split = 'test'""",
)
def forecast_pivot(spark, d):
    return rounded(evaluation.forecast_pivot(test_predictions(spark, d), KEYS, list(BASELINES)))


@query(
    "prediction_buckets",
    "WITH " + DAILY_SQL + _LONG_SQL + " UNION ALL ".join(
        f"SELECT model, '{le}' AS le, CAST(COUNT(*) FILTER (predicted <= {b}) AS BIGINT) AS n FROM long GROUP BY 1"
        for le, b in [*[(str(int(x)), x) for x in evaluation.PREDICTION_BOUNDS], ("+Inf", "'inf'::DOUBLE")]),
)
def prediction_buckets(spark, d):
    return evaluation.prediction_buckets(test_predictions(spark, d), "predicted", ["model"])
