"""Learned forecasts, anomaly forest and categorisers, with small settings for a quick answer."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from orderloom.functions import text as text_ops
from orderloom.operators import anomalies, categorise, evaluation, forecasting, isolation, retraining
from orderloom.operators import series as series_ops
from orderloom.operators.tfidf import add_terms
from orderloom.plans.inputs import DAILY_SQL, KEYS, daily_series, rounded
from orderloom.plans.registry import query
from orderloom.plans.series_queries import _W, _roll
from orderloom.plans.text_queries import ATTRIBUTES_SQL, attributes
from orderloom.session import settle, shared_folder

# Ten rounds instead of the library default of a hundred.
QUICK = {"maxIter": 10, "maxDepth": 4}


def _features(spark, d):
    return settle(series_ops.training_features(daily_series(spark, d), KEYS))


def _split(spark, d):
    rows = series_ops.chrono_split(_features(spark, d), KEYS)
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


@query("gbt_forecast")
def gbt_forecast(spark, d):
    train, test = _split(spark, d)
    model = forecasting.fit_gbt(train, forecasting.feature_columns(train, KEYS), QUICK)
    return rounded(forecasting.predict_gbt(model, test).select("series", "date", "sales", "predicted"))


@query("additive_forecast")
def additive_forecast(spark, d):
    return rounded(forecasting.additive_forecast(*_split(spark, d), KEYS))


@query("model_cv")
def model_cv(spark, d):
    return rounded(forecasting.run_cv(_features(spark, d), KEYS, 3, params=QUICK))


@query("param_search")
def param_search(spark, d):
    train, _ = _split(spark, d)
    return forecasting.search_params(train, KEYS, forecasting.feature_columns(train, KEYS), forecasting.random_params(20))


def _importance(spark, d):
    train, _ = _split(spark, d)
    columns = forecasting.feature_columns(train, KEYS)
    return forecasting.importance_table(forecasting.fit_gbt(train, columns, QUICK), columns, spark)


@query("importance")
def importance(spark, d):
    return rounded(_importance(spark, d).orderBy("position").limit(15))


@query("importance_counts")
def importance_counts(spark, d):
    return forecasting.features_for_share(_importance(spark, d))


@query(
    "future_features",
    "WITH " + DAILY_SQL + f"""
    , t AS (SELECT series, date, sales, lag(sales, 7) OVER ({_W}) AS l7, {_roll('AVG', 7)} AS r7 FROM daily),
    last AS (SELECT series, MAX(date) AS d, arg_max(sales, date) AS s FROM t WHERE l7 IS NOT NULL AND r7 IS NOT NULL GROUP BY 1),
    f AS (SELECT series, s, CAST(UNNEST(generate_series(d + 1, d + 14, INTERVAL 1 DAY)) AS DATE) AS date FROM last)
    SELECT series, CAST(date AS VARCHAR) AS date, s AS sales_lag_1, s AS sales_lag_7, s AS rolling_mean_7,
      CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month, CAST(month(date) AS INT) AS month,
      CAST(quarter(date) AS INT) AS quarter, CAST(year(date) AS INT) AS year, CAST(isodow(date) IN (6, 7) AS INT) AS is_weekend, 0 AS is_holiday,
      CAST(day(date) IN (1,2,3) AS INT) AS is_payday_1st, CAST(day(date) IN (10,11,12) AS INT) AS is_payday_10th,
      CAST(day(date) IN (1,2,3,10,11,12) AS INT) AS is_payday FROM f""",
)
def future_features(spark, d):
    return rounded(forecasting.future_features(series_ops.training_features(daily_series(spark, d), KEYS), KEYS, 14))


@query("batch_forecast")
def batch_forecast(spark, d):
    features = _features(spark, d)
    model = forecasting.train_final(features, KEYS, params=QUICK)
    return rounded(forecasting.batch_forecast(model, features, KEYS, 30))


@query("isolation_forest")
def isolation_forest(spark, d):
    flagged = isolation.detect_series_anomalies(daily_series(spark, d), KEYS)
    return rounded(flagged.select("series", "date", "sales", "decision", "anomaly_score", "is_anomaly"))


@query("combined_anomalies")
def combined_anomalies(spark, d):
    """Three methods side by side: count and percent per method and for any of them."""
    flagged = isolation.detect_series_anomalies(daily_series(spark, d), KEYS, positive_only=True)
    flagged = flagged.withColumnRenamed("is_anomaly", "anomaly_isoforest")
    flagged = anomalies.iqr_flags(anomalies.zscore_flags(flagged, KEYS), KEYS, "anomaly_iqr")
    names = ["anomaly_isoforest", "anomaly_zscore", "anomaly_iqr"]
    return rounded(anomalies.flag_summary(anomalies.combine_flags(flagged, names), [*names, "anomaly_any"]))


@query("forecast_run")
def forecast_run(spark, d):
    """Series, features, champion by cross-validation, anomalies, and 14 days ahead in one table."""
    series, features = daily_series(spark, d), _features(spark, d)
    best = forecasting.champion_name(forecasting.run_cv(features, KEYS, 3, params=QUICK))
    ahead = settle(forecasting.forecast_with(best, features, KEYS, 14, QUICK))
    flagged = isolation.detect_series_anomalies(series, KEYS)
    # The champion is the model that made the forecast rows.
    return rounded(forecasting.forecast_chart(series, ahead, flagged, KEYS).withColumn("champion", F.lit(ahead.first().model)))


@query("retrain_run")
def retrain_run(spark, d):
    """Champion by cross-validation, the gate against lag-7 forecasts on the same folds, and the champion refitted on all days.

    Whichever model won is saved, loaded again and forecasts 14 days.
    """
    features = _features(spark, d)
    cv = settle(forecasting.run_cv(features, KEYS, 3, params=QUICK))
    path = f"{shared_folder(spark).rstrip('/')}/champion-{uuid.uuid4().hex}"
    if forecasting.champion_name(cv) == "boosted_trees":
        forecasting.train_final(features, KEYS, path, QUICK)
        ahead = forecasting.batch_forecast(PipelineModel.load(path), features, KEYS, 14)
    else:
        ahead = forecasting.forecast_with("additive", features, KEYS, 14, path=path)
    candidate = evaluation.champion(cv).select(F.lit("all").alias("scope"), "champion", F.col("mean_mae").alias("new_mae"))
    naive = series_ops.test_folds(features, KEYS, 3).groupBy("fold").agg(F.avg(F.abs(F.col("sales") - F.col("sales_lag_7"))).alias("mae"))
    production = naive.agg(F.avg("mae").alias("current_mae")).select(F.lit("all").alias("scope"), "current_mae")
    gate = retraining.improvement_gate(candidate, production, ["scope"])
    return rounded(gate.withColumn("n_forecasts", F.lit(ahead.where("forecast is not null").count())))


# --- categorisation ----------------------------------------------------------

SETTINGS = {
    "svm": {"max_iter": 20},
    "random_forest": {"trees": 10, "depth": 10},
    "boosted_trees": {"rounds": 3, "depth": 4},
}


def _labelled(spark, d):
    rows = add_terms(text_ops.add_tokens(attributes(spark, d)), "name_clean")
    marked = settle(categorise.mark_labeled(rows.select("p_partkey", "name_clean", "terms", "product_type"), min_class_size=10))
    return marked.where("is_labeled").drop("is_labeled"), marked.where("not is_labeled").drop("is_labeled")


@query(
    "stratified_folds",
    "WITH " + ATTRIBUTES_SQL + """, p AS (SELECT product_type, row_number() OVER (PARTITION BY product_type ORDER BY p_partkey) AS p FROM attr
      WHERE product_type IN (SELECT product_type FROM attr GROUP BY 1 HAVING COUNT(product_type) >= 10))
    SELECT product_type, CAST(p % 5 AS INT) AS fold, COUNT(*) AS n FROM p GROUP BY 1, 2""",
)
def stratified_folds(spark, d):
    labelled, _ = _labelled(spark, d)
    folds = categorise.stratified_folds(labelled, "p_partkey", "product_type", 5)
    return folds.groupBy("product_type", "fold").agg(F.count(F.lit(1)).alias("n"))


def _categorise(model_type: str, name: str):
    @query(name)
    def run(spark, d):
        labelled, rest = _labelled(spark, d)
        model = categorise.fit_classifier(labelled, model_type, SETTINGS[model_type])
        return categorise.predict_unlabeled(model, rest).select("p_partkey", "name_clean", "product_type")

    return run


svm_categorise = _categorise("svm", "svm_categorise")
rf_categorise = _categorise("random_forest", "rf_categorise")
gbt_categorise = _categorise("boosted_trees", "gbt_categorise")


@query("categoriser_leaderboard")
def categoriser_leaderboard(spark, d):
    labelled, _ = _labelled(spark, d)
    return rounded(categorise.evaluate_models(labelled, "p_partkey", categorise.MODEL_TYPES, SETTINGS, k=5))


@query("text_run")
def text_run(spark, d):
    """Tokens, attributes, champion on the labelled rows, predictions for the rest, one table."""
    labelled, rest = _labelled(spark, d)
    board = categorise.evaluate_models(labelled, "p_partkey", categorise.MODEL_TYPES, SETTINGS, k=5)
    best = board.first().model
    model = categorise.fit_classifier(labelled, best, SETTINGS[best])
    predicted = categorise.predict_unlabeled(model, rest).withColumn("source", F.lit("predicted"))
    known = labelled.withColumn("source", F.lit("dictionary"))
    return known.unionByName(predicted).select("p_partkey", "name_clean", "product_type", "source")
