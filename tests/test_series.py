import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderloom.functions import calendar
from orderloom.functions.tails import _chi2_tail
from orderloom.operators import anomalies, evaluation, forecasting, isolation
from orderloom.operators import series as ops

KEYS = ["k"]


def frame(spark, values, start=date(2023, 1, 1), key="a"):
    return spark.createDataFrame([(key, start + timedelta(i), float(v)) for i, v in enumerate(values)], "k string, date date, sales double")


def wave(n, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + 0.1 * t + 20 * np.sin(2 * math.pi * t / 7) + rng.normal(0, 2, n)


def test_daily_sum_and_gap_fill(spark):
    orders = spark.createDataFrame(
        [("a", "2023-01-01 10:00:00", 100.0), ("a", "2023-01-01 12:00:00", 200.0), ("a", "2023-01-02 01:00:00", 150.0), ("a", "2023-01-06 01:00:00", 1.0)],
        "k string, ts string, amount double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    daily = ops.daily_sales(orders, KEYS, "ts", "amount")
    filled = {str(r.date): r.sales for r in ops.on_spine(daily, KEYS, {"sales": 0.0}).collect()}
    assert filled == {"2023-01-01": 300.0, "2023-01-02": 150.0, "2023-01-03": 0.0, "2023-01-04": 0.0, "2023-01-05": 0.0, "2023-01-06": 1.0}
    assert ops.missing_days(daily, KEYS).count() == 3


def test_features(spark):
    rows = frame(spark, [100, 200, 150, 300, 250]).withColumns({**ops.lag_columns(KEYS, [1]), **ops.rolling_columns(KEYS, [3])})
    rows = calendar.add_calendar(rows).orderBy("date").collect()
    assert rows[0].day_of_week == 6 and rows[0].is_weekend == 1
    assert [r.sales_lag_1 for r in rows] == [None, 100.0, 200.0, 150.0, 300.0]
    assert [r.rolling_mean_3 for r in rows][:4] == [None, None, None, 150.0]
    assert abs(rows[4].rolling_mean_3 - 650 / 3) < 1e-9
    with pytest.raises(ValueError):
        calendar.add_calendar(spark.range(1))


def test_holidays(spark):
    days = ["2025-04-20", "2025-04-21", "2025-06-08", "2025-06-19", "2025-12-24", "2024-12-24", "2011-01-06", "2010-01-06", "2024-03-31", "2025-07-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("date"))
    got = {str(r.date): r.is_holiday for r in calendar.add_calendar(df).collect()}
    assert [got[d] for d in days] == [1, 1, 1, 1, 1, 0, 1, 0, 1, 0]


def test_warm_up_rows_go(spark):
    assert ops.training_features(frame(spark, wave(20)), KEYS).count() == 13
    assert ops.wide_features(frame(spark, wave(40)), KEYS).count() == 12


def test_decompose_against_pandas(spark):
    for period in (7, 30):
        y = wave(90)
        got = ops.decompose(frame(spark, y), KEYS, period).orderBy("date").toPandas()
        s = pd.Series(y)
        if period % 2:
            trend = s.rolling(period, center=True).mean()
        else:
            w = np.r_[0.5, np.ones(period - 1), 0.5] / period
            trend = pd.Series(np.r_[[np.nan] * (period // 2), np.convolve(y, w, "valid"), [np.nan] * (period // 2)])
        phase = np.arange(90) % period
        means = (s - trend).groupby(phase).mean()
        seasonal = (means - means.mean()).to_numpy()[phase]
        assert np.allclose(got.trend, trend, equal_nan=True)
        assert np.allclose(got.seasonal, seasonal)


def test_acf_pacf_and_portmanteau(spark):
    y = wave(80)
    acf = ops.autocorrelation(frame(spark, y), KEYS)
    got = acf.orderBy("lag").toPandas().acf.to_numpy()
    d = y - y.mean()
    want = np.array([1.0] + [(d[k:] * d[:-k]).sum() / (d * d).sum() for k in range(1, 36)])
    assert np.allclose(got, want)
    pacf = ops.partial_autocorrelation(acf, KEYS).orderBy("lag").toPandas().pacf.to_numpy()
    for k in (1, 2, 5):
        r = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(pacf[k] - np.linalg.solve(r, want[1 : k + 1])[-1]) < 1e-9
    box = {r.lag: r for r in evaluation.ljung_box(acf, KEYS).collect()}
    q = 80 * 82 * sum(want[k] ** 2 / (80 - k) for k in range(1, 8))
    assert abs(box[7].statistic - q) < 1e-6 and box[7].p_value < 0.01
    # Upper 5 percent points of the chi-square table.
    for point, df in ((3.841, 1), (5.991, 2), (7.815, 3), (14.067, 7), (23.685, 14)):
        assert abs(_chi2_tail(point, df) - 0.05) < 1e-4


def test_folds(spark):
    rows = ops.time_folds(frame(spark, range(11)), KEYS, 3).collect()
    sizes = {(f, r): sum(1 for x in rows if x.fold == f and x.role == r) for f in range(3) for r in ("train", "test")}
    assert sizes == {(0, "train"): 5, (0, "test"): 2, (1, "train"): 7, (1, "test"): 2, (2, "train"): 9, (2, "test"): 2}
    tested = ops.test_folds(frame(spark, range(11)), KEYS, 3).collect()
    assert sorted((r.date, r.fold) for r in tested) == sorted((r.date, r.fold) for r in rows if r.role == "test")


def test_repair_keeps_the_original(spark):
    values = [10, 11, 12, 11, 10, 500, 11, 12, 0, 10, 11, 12]
    fixed = ops.repair_outliers(anomalies.iqr_flags(frame(spark, values), KEYS), KEYS).orderBy("date").collect()
    assert [r.is_outlier for r in fixed] == [v == 500 for v in values]
    assert fixed[5].sales_original == 500 and fixed[5].sales == 11
    z = anomalies.zscore_flags(frame(spark, values), KEYS).orderBy("date").collect()
    assert z[8].z_score == 0.0 and z[5].anomaly_zscore


def test_both_mape_forms(spark):
    df = spark.createDataFrame([("m", 100.0, 90.0), ("m", 0.0, 1.0)], "model string, sales double, predicted double")
    row = evaluation.error_metrics(df, ["model"]).first()
    assert row.mae == 5.5 and row.mape_pct == 10.0 and row.mape_frac > 1e15
    zero = evaluation.error_metrics(df.where("sales = 0"), ["model"]).first()
    assert zero.mape_pct is None


def test_isolation_forest_finds_the_spikes(spark):
    y = wave(300)
    y[[50, 200]] = [900, -400]
    flagged = isolation.detect_series_anomalies(frame(spark, y), KEYS, 0.05, trees=50)
    rows = flagged.orderBy("date").collect()
    assert 0 < sum(r.is_anomaly for r in rows) <= 16
    assert rows[50].is_anomaly and rows[200].is_anomaly
    assert all((r.decision < 0) == r.is_anomaly == (r.anomaly_score == -1) for r in rows)
    again = isolation.detect_series_anomalies(frame(spark, y), KEYS, 0.05, trees=50).orderBy("date").collect()
    assert [r.decision for r in again] == [r.decision for r in rows]


def test_per_series_models_beat_the_zero_forecast(spark):
    y = wave(200)
    both = frame(spark, y).unionByName(frame(spark, y * 10, key="b"))
    split = ops.chrono_split(both, KEYS)
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    for model in (forecasting.additive_forecast,):
        metrics = {r.k: r for r in evaluation.error_metrics(model(train, test, KEYS), KEYS).collect()}
        assert metrics["a"].n == 40 and metrics["a"].mape_pct < 12 and abs(metrics["b"].mae / metrics["a"].mae - 10) < 3


def test_additive_fit_is_that_of_the_whole_series(spark, tmp_path):
    y = wave(400)
    both = frame(spark, y).unionByName(frame(spark, y[::-1] * 3, key="b")).withColumn("sales", F.expr("if(k = 'b' and day(date) = 7, null, sales)"))
    fitted = forecasting.fit_additive(both, KEYS)
    forecasting.save_additive(fitted, str(tmp_path / "additive"))
    got = {r.k: r for r in forecasting.load_additive(spark, str(tmp_path / "additive")).collect()}
    for k in ("a", "b"):
        rows = [r for r in both.where(F.col("k") == k).orderBy("date").collect() if r.sales is not None]
        day = np.array([(r.date - date(1970, 1, 1)).days for r in rows], float)
        t = (day - day[0]) / (day[-1] - day[0])
        x = [np.ones_like(t), t] + [np.maximum(t - c, 0) for c in np.arange(1, 26) * 0.8 / 25]
        x += [f(2 * np.pi * j * day / p) for p, n in ((7.0, 3), (365.25, 10)) for j in range(1, n + 1) for f in (np.sin, np.cos)]
        x, penalty = np.array(x).T, np.r_[1e-8, 1e-8, np.ones(51)]
        want = np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ np.array([r.sales for r in rows]))
        assert (got[k].origin, got[k].span) == (day[0], day[-1] - day[0]) and np.allclose(got[k].weights, want, rtol=1e-6, atol=1e-6)
    unknown = forecasting.predict_additive(fitted, frame(spark, range(3), key="new"), KEYS).collect()
    assert [r.predicted for r in unknown] == [0.0, 0.0, 0.0]


def test_a_kept_additive_winner(spark, tmp_path):
    features = ops.training_features(frame(spark, wave(120)), KEYS)
    path = str(tmp_path / "winner")
    ahead = forecasting.forecast_with("additive", features, KEYS, 14, path=path).orderBy("date").collect()
    kept = forecasting.load_additive(spark, path)
    future = forecasting.future_features(features, KEYS, 14).withColumn("sales", F.lit(None).cast("double"))
    again = forecasting.predict_additive(kept, future, KEYS).orderBy("date").collect()
    assert [r.forecast for r in ahead] == [round(r.predicted, 2) for r in again] and {r.model for r in ahead} == {"additive"}


def test_short_series_is_forecast(spark):
    rows = ops.chrono_split(frame(spark, range(10)), KEYS)
    out = forecasting.additive_forecast(rows.where("split = 'train'"), rows.where("split = 'test'"), KEYS).collect()
    assert len(out) == 2 and all(0 < r.predicted < 12 for r in out)


def test_boosted_forecast_and_reload(spark, tmp_path):
    from pyspark.ml import PipelineModel

    features = ops.training_features(frame(spark, wave(120)), KEYS).cache()
    model = forecasting.train_final(features, KEYS, str(tmp_path / "gbt"), {"maxIter": 5})
    ahead = forecasting.batch_forecast(PipelineModel.load(str(tmp_path / "gbt")), features, KEYS, 14).orderBy("date").collect()
    assert len(ahead) == 14 and ahead[0].date == date(2023, 5, 1)
    assert all(80 < r.forecast < 140 for r in ahead)
    columns = forecasting.feature_columns(features, KEYS)
    table = forecasting.importance_table(model, columns, spark).orderBy("position").collect()
    assert abs(table[-1].cumulative - 1) < 1e-9 and len(table) == len(columns)
    with pytest.raises(ValueError):
        forecasting.future_features(features, KEYS, 91)


def test_carry_forward_of_wide_features(spark):
    features = ops.wide_features(frame(spark, wave(60)), KEYS)
    last = features.orderBy(F.desc("date")).first()
    future = forecasting.future_features(features, KEYS, 3).orderBy("date").collect()
    assert [r.lag_14 for r in future] == [last.lag_14] * 3
    assert [r.rolling_std_28 for r in future] == [last.rolling_std_28] * 3
    assert future[0].weekday == (last.weekday + 1) % 7
