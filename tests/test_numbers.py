"""Numbers that a table with small, round values would not show to be wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.functions import calendar, casts
from orderloom.functions.text import coverage
from orderloom.operators import anomalies, clustering, drift, profiles


def test_deviation_of_large_values(spark):
    df = spark.createDataFrame([(1e9 + i,) for i in range(3)], "x double")
    row = profiles.describe(df, ["x"]).first()
    assert row["mean"] == 1e9 + 1 and row["std"] == pytest.approx(1.0)


def test_dispersion_of_large_values(spark):
    rows = [(c, [1e9 + 10 * c + i]) for c in range(2) for i in range(3)]
    df = clustering.array_to_vector
    vectors = spark.createDataFrame(rows, "cluster_id int, a array<double>").select("cluster_id", df("a").alias("features"))
    assert clustering.calinski_harabasz(vectors).first().calinski_harabasz == pytest.approx(150 / (4 / 4))


def test_drift_of_large_values(spark):
    a = spark.createDataFrame([(1e9 + i % 10,) for i in range(2000)], "x double")
    b = spark.createDataFrame([(1e9 + i % 10 + 1,) for i in range(2000)], "x double")
    row = drift.feature_drift(a, b, ["x"]).first()
    assert row.test == "wasserstein" and row.score == pytest.approx(1 / (8.25**0.5))


def test_casts(spark):
    df = spark.createDataFrame([("3000000000", 1.004), ("x", 1.004)], "t string, m double")
    assert [r[0] for r in df.select(casts.safe_int(F.col("t"))).collect()] == [3000000000, 0]
    assert df.agg(casts.money_sum(F.col("m"))).first()[0] == 2.008


def test_holidays_of_any_year(spark):
    days = [datetime.date(2500, 1, 1), datetime.date(1583, 12, 25), datetime.date(2024, 3, 31), datetime.date(2024, 5, 30), datetime.date(2024, 12, 24), datetime.date(2025, 12, 24), None]
    got = calendar.add_calendar(spark.createDataFrame([(d,) for d in days], "date date")).collect()
    assert {r.date: r.is_holiday for r in got} == dict(zip(days, [1, 1, 1, 1, 0, 1, 0]))


def test_no_rows(spark):
    none = spark.createDataFrame([], "a boolean, b string, x double")
    assert {r.flagged_pct for r in anomalies.flag_summary(none, ["a"]).collect()} == {None}
    assert {r.coverage_pct for r in coverage(none, ["b"]).collect()} == {None}
    assert profiles.kpis(none, "b", "a", "x").first().noise_pct is None
    some = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert drift.psi(some, none.select("x"), ["x"]).count() == 1
    assert drift.feature_drift(some, none.select("x"), ["x"]).count() == 1
