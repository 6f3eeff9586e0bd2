from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.functions import ranks
from orderloom.functions.ranks import exact_quantiles, running_total
from orderloom.operators import drift, profiles, quality, retraining
from orderloom.streaming import streams


def daily(spark, n=100, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(date(2023, 1, 1) + timedelta(i), float(rng.normal(1000, 200)), i % 7, i % 12 + 1, float(rng.normal(1000, 200))) for i in range(n)]
    return spark.createDataFrame(rows, "date date, sales double, day_of_week int, month int, lag_1 double")


NUMERIC = ["sales", "day_of_week", "month", "lag_1"]


def findings(spark, df):
    ref = daily(spark)
    report = quality.quality_report(df, quality.reference_profile(ref, NUMERIC), ref.columns)
    rows = {(r.check, r.column_name): r for r in report.collect()}
    return rows, quality.quality_verdict(report).first().is_valid


def test_quality_of_the_reference_itself(spark):
    rows, valid = findings(spark, daily(spark))
    assert valid and {r.severity for r in rows.values()} == {"stat"}
    assert rows["n_rows", ""].value == 100 and rows["n_cols", ""].value == 5


def test_quality_findings(spark):
    rows, valid = findings(spark, daily(spark).drop("month", "lag_1"))
    assert not valid and ("missing_column", "month") in rows and ("missing_column", "lag_1") in rows
    wild = daily(spark).withColumn("sales", F.when(F.col("date") == "2023-01-05", -100000.0).otherwise(F.col("sales")))
    rows, valid = findings(spark, wild)
    assert valid and rows["range_low", "sales"].severity == "warning" and "-100000.0" in rows["range_low", "sales"].message
    repeated = daily(spark).unionByName(daily(spark).limit(5))
    rows, valid = findings(spark, repeated)
    assert not valid and rows["duplicate_dates", "date"].value == 5
    gaps = daily(spark).withColumn("lag_1", F.when(F.dayofmonth("date") > 20, F.col("lag_1")))
    rows, valid = findings(spark, gaps)
    assert rows["null_rate", "lag_1"].severity == "error"
    rows, _ = findings(spark, daily(spark, 5))
    assert rows["min_rows", ""].severity == "warning"


def normal(spark, mean, std, n=200, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(float(a), int(b), int(c)) for a, b, c in zip(rng.normal(mean, std, n), rng.integers(0, 3, n), rng.integers(0, 2, n))]
    return spark.createDataFrame(rows, "lag_1 double, kind int, flag int")


def test_psi_matches_numpy(spark):
    a, b = normal(spark, 100, 20), normal(spark, 115, 25, seed=2)
    x, y = (np.array([r.lag_1 for r in f.collect()]) for f in (a, b))
    h, edges = np.histogram(x, 10)
    g, _ = np.histogram(y, edges)
    p, q = h / len(x) + 1e-6, g / len(y) + 1e-6
    assert abs(drift.psi(a, b, ["lag_1"]).first().psi - np.sum((q - p) * np.log(q / p))) < 1e-9
    same = drift.psi(a, a, ["lag_1"]).first()
    assert same.psi < 0.01 and same.band == "none"
    assert drift.psi(a, normal(spark, 200, 20), ["lag_1"]).first().band == "significant"


def test_drift_tests_by_kind_of_column(spark):
    ref, shifted = normal(spark, 1000, 200), normal(spark, 5000, 200, seed=3)
    same = {r.feature: r for r in drift.feature_drift(ref, ref).collect()}
    assert {f: r.test for f, r in same.items()} == {"lag_1": "ks", "kind": "chisquare", "flag": "z"}
    assert not any(r.drifted for r in same.values())
    moved = {r.feature: r for r in drift.feature_drift(ref, shifted).collect()}
    assert moved["lag_1"].drifted and moved["lag_1"].ks == 1.0
    report = drift.dataset_drift(drift.feature_drift(ref, shifted)).first()
    assert report.number_of_drifted_columns >= 1 and "lag_1" in report.drifted_features
    big = normal(spark, 0, 1, 3000), normal(spark, 0.5, 1, 3000, seed=9)
    rows = {r.feature: r for r in drift.feature_drift(*big).collect()}
    assert {f: r.test for f, r in rows.items()} == {"lag_1": "wasserstein", "kind": "jensenshannon", "flag": "jensenshannon"}
    x, y = (np.sort([r.lag_1 for r in f.collect()]) for f in big)
    assert abs(rows["lag_1"].score - np.abs(x - y).mean() / x.std()) < 1e-9
    assert rows["lag_1"].drifted and not rows["kind"].drifted


def test_excluded_columns(spark):
    df = daily(spark).withColumn("z_score", F.lit(1.0))
    assert drift.feature_columns(df) == ["day_of_week", "month", "lag_1"]


def test_performance_and_triggers(spark):
    preds = spark.createDataFrame([("a", 10.0, 8.0), ("a", 10.0, 12.4), ("b", 1.0, 1.0), ("c", 5.0, 4.0)], "k string, sales double, predicted double")
    base = spark.createDataFrame([("a", 2.0), ("b", 0.0), ("c", 1.0)], "k string, baseline_mae double")
    perf = drift.performance_check(preds, base, ["k"])
    rows = {r.k: r for r in perf.collect()}
    assert rows["a"].degradation_pct == 10.0 and not rows["c"].alert and rows["b"].degradation_pct == 0.0
    state = spark.createDataFrame(
        [("a", datetime(2025, 1, 1), 3), ("b", datetime(2025, 1, 9), 50), ("c", datetime(2025, 1, 9), 1)], "k string, last_retrain timestamp, new_rows long"
    )
    none = spark.createDataFrame([("c", True, 2)], "k string, dataset_drift boolean, number_of_drifted_columns int")
    now = F.lit("2025-01-10 00:00:00").cast("timestamp")
    got = {r.k: r for r in retraining.retrain_triggers(state, perf, none, ["k"], now).collect()}
    assert got["a"].should_retrain and "Time-based: 216h" in got["a"].reasons and not got["a"].sufficient_new_data
    assert not got["b"].should_retrain and got["b"].reasons == "" and got["b"].sufficient_new_data
    assert got["c"].reasons == "Data-based: Drift detected in 2 features"
    gate = retraining.improvement_gate(
        spark.createDataFrame([("a", 1.0), ("b", 3.0), ("n", 9.0)], "k string, new_mae double"),
        spark.createDataFrame([("a", 2.0), ("b", 3.0)], "k string, current_mae double"), ["k"])
    assert {r.k: r.register for r in gate.collect()} == {"a": True, "b": False, "n": True}


def test_quantiles_by_brackets(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(ranks, "KEEP_ALL", 1000)
    x = np.r_[rng.lognormal(size=60_000), np.full(30_000, 1.5), -rng.random(10_000)]
    rows = [(float(v), None if i % 3 else float(i % 7), float("nan") if i % 2 else -float(v), None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    wanted = {"lo": 0.0, "q": 0.25, "m": 0.5, "m2": 0.5003, "t": 0.99, "u": 0.99999, "hi": 1.0}
    data = {"a": x, "b": np.array([r[1] for r in rows if r[1] is not None]), "c": np.array([r[2] for r in rows if r[2] == r[2]])}
    for one_task in (10**6, 10):
        monkeypatch.setattr(ranks, "ONE_TASK", one_task)
        got = {r.metric: r for r in exact_quantiles(df, ["a", "b", "c", "d"], wanted, moments=True).collect()}
        assert set(got) == set(data)
        for c, v in data.items():
            assert got[c].n == len(v) and np.allclose([got[c][k] for k in wanted], np.quantile(v, list(wanted.values())), rtol=1e-12, atol=0)
            assert np.allclose([got[c].mean, got[c].std, got[c].min, got[c].max], [v.mean(), v.std(ddof=1), v.min(), v.max()])
    monkeypatch.setattr(ranks.F, "percentile_approx", lambda v, asked, accuracy: F.array(*[F.lit(-5.0)] * len(asked)))
    broken = {r.metric: r.m for r in exact_quantiles(df, ["a"], {"m": 0.5}).collect()}
    assert broken == {"a": np.quantile(x, 0.5)}


def test_quantiles_with_heavy_ties(spark):
    rng = np.random.default_rng(5)
    x = np.r_[rng.exponential(10, 700), np.full(400, 7.0)]
    df = spark.createDataFrame([(["a", "b"][i % 2], float(v), 1.0) for i, v in enumerate(x)], "g string, v double, one double").repartition(16)
    got = exact_quantiles(df, ["v", "one"], {"lo": 0.0, "m": 0.5, "t": 0.99, "hi": 1.0}).collect()
    row = [r for r in got if r.metric == "v"][0]
    assert np.allclose([row.lo, row.m, row.t, row.hi], np.quantile(x, [0, 0.5, 0.99, 1]))
    by = {r.g: r.m for r in exact_quantiles(df, ["v"], {"m": 0.5}, by=["g"]).collect()}
    assert np.isclose(by["a"], np.median(x[::2])) and np.isclose(by["b"], np.median(x[1::2]))


def test_running_total_over_many_ranges(spark):
    df = spark.range(500).select("id", F.lit(2).alias("v"), (F.col("id") % 3).alias("g")).repartition(20)
    got = {r.id: r for r in running_total(df, [F.desc("id")], {"t": "v"}, next_of=None).collect()}
    assert got[499].t == 2 and got[0].t == 1000 and got[0].t_all == 1000
    after = {r.id: r._next for r in running_total(df, [F.col("id")], {"t": "v"}, by=["g"], next_of="id").collect()}
    assert after[0] == 3 and after[496] == 499 and after[499] is None


def test_histogram_and_fences(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double")
    bins = {r.bin: r.n for r in profiles.histogram(df, "v", 10).collect()}
    assert bins == {0: 9, 9: 1}
    assert profiles.upper_fence_counts(df, ["v"]).first().n_outliers == 1
    assert profiles.histogram(df.where("v = 1"), "v", 5).first().n == 1


def event_rows(spark, rows):
    return spark.createDataFrame(rows, "ts string, event_type string, value double, event_id long").withColumn("ts", F.col("ts").cast("timestamp"))


def test_late_rows_are_dropped_between_batches(spark, tmp_path):
    source = tmp_path / "in"
    batches = [
        [("2024-01-01 10:00:00", "a", 1.0, 1), ("2024-01-02 10:00:00", "a", 2.0, 2)],
        [("2024-01-06 10:00:00", "a", 4.0, 3)],
        [("2024-01-01 11:00:00", "a", 50.0, 4), ("2024-01-09 10:00:00", "a", 8.0, 5)],
    ]
    for rows in batches:
        event_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
        stream = streams.read_parquet_stream(spark, str(source), event_rows(spark, rows).schema, "part*")
        days = streams.run_to_parquet(streams.daily_sales(stream, ["event_type"], "ts", "value"), str(tmp_path), "daily")
    got = {str(r.date): r.sales for r in days.collect()}
    assert got["2024-01-01"] == 1.0 and got["2024-01-02"] == 2.0 and got["2024-01-06"] == 4.0
    assert "2024-01-09" not in got


def test_repeats_within_the_watermark(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", "a", 1.0, 1), ("2024-01-01 10:00:05", "a", 1.0, 1), ("2024-01-01 11:00:00", "b", 2.0, 2)]
    event_rows(spark, rows).write.parquet(str(tmp_path / "in"))
    stream = streams.read_parquet_stream(spark, str(tmp_path / "in"), event_rows(spark, rows).schema, "part*")
    kept = streams.run_to_parquet(streams.drop_repeats(stream, ["event_id"], "ts"), str(tmp_path), "dedup")
    assert sorted(r.event_id for r in kept.collect()) == [1, 2]


def test_order_documents_as_a_stream(spark, order_folder, tmp_path):
    from orderloom.operators import orders as order_ops
    from orderloom.sources import xml

    raw = streams.read_order_stream(spark, str(order_folder), xml.order_schema())
    table = order_ops.order_table(xml.tidy_orders(raw, xml.ORDER_FIELDS, xml.ITEM_FIELDS))
    assert streams.run_to_parquet(table, str(tmp_path / "run"), "orders").count() == 4


def test_performance_check_needs_a_baseline(spark):
    preds = spark.createDataFrame([("a", 1.0, 2.0)], "k string, sales double, predicted double")
    with pytest.raises(Exception):
        drift.performance_check(preds, preds, ["k"]).collect()
