"""Descriptive tables over the order grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import orders as order_ops
from orderloom.operators import profiles as ops
from orderloom.operators import series as series_ops
from orderloom.plans.inputs import DAILY_SQL, KEYS, ORDERS_SQL, keyed_orders, observed_days, orders_grain, rounded
from orderloom.plans.registry import query
from orderloom.sources.tables import read_table

NUMERIC = ["order_amount_brutto", "n_items", "avg_item_price", "max_item_price"]


def _per_metric(template: str, columns=NUMERIC) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


@query(
    "describe_orders",
    "WITH " + ORDERS_SQL + _per_metric("""
    SELECT '{c}' AS metric, COUNT({c}) AS n, round(AVG({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           round(CAST(MIN({c}) AS DOUBLE), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
           round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
           round(CAST(MAX({c}) AS DOUBLE), 4) AS max FROM og"""),
)
def describe_orders(spark, d):
    return rounded(ops.describe(orders_grain(spark, d), NUMERIC), 4)


_NULL_COLUMNS = ["o_orderkey", "o_totalprice", "l_partkey", "l_quantity"]


@query(
    "null_profile",
    "WITH j AS (SELECT * FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey)" + _per_metric(
        """ SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_null, COUNT(*) AS n_rows,
        round(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 6) AS null_pct FROM j""", _NULL_COLUMNS),
)
def null_profile(spark, d):
    orders, lines = read_table(spark, d, "orders"), read_table(spark, d, "lineitem")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(*_NULL_COLUMNS)
    return rounded(ops.null_profile(joined).orderBy(F.desc("n_null")))


@query(
    "skew_profile",
    "WITH " + ORDERS_SQL + _per_metric("""
    SELECT '{c}' AS metric, round(skewness({c}), 6) AS skew_raw, round(skewness(ln(1 + {c})), 6) AS skew_log FROM og"""),
)
def skew_profile(spark, d):
    return rounded(ops.skew_profile(orders_grain(spark, d), NUMERIC))


PERCENTS = [50, 75, 90, 95, 99, 100]


@query(
    "percentile_table",
    " UNION ALL ".join(
        f"SELECT {p} AS percent, round(quantile_cont(o_totalprice, {p / 100}), 6) AS value FROM orders" for p in PERCENTS
    ),
)
def percentile_table(spark, d):
    return rounded(ops.percentile_table(read_table(spark, d, "orders"), "o_totalprice", PERCENTS))


@query(
    "iqr_counts",
    "WITH " + ORDERS_SQL + _per_metric("""
    SELECT '{c}' AS metric, round(t, 6) AS threshold, CAST(COUNT(*) FILTER (v > t) AS BIGINT) AS n_outliers,
           round(100.0 * COUNT(*) FILTER (v > t) / COUNT(*), 6) AS outlier_pct
    FROM (SELECT CAST({c} AS DOUBLE) AS v FROM og),
         (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST({c} AS DOUBLE), 0.75)
                 - quantile_cont(CAST({c} AS DOUBLE), 0.25)) AS t FROM og) GROUP BY t"""),
)
def iqr_counts(spark, d):
    return rounded(ops.upper_fence_counts(orders_grain(spark, d), NUMERIC))


@query(
    "value_counts",
    "SELECT o_custkey AS value, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
)
def value_counts(spark, d):
    return ops.value_counts(read_table(spark, d, "orders"), "o_custkey", 10)


@query(
    "distinct_counts",
    _per_metric("SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct FROM orders",
                ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]),
)
def distinct_counts(spark, d):
    return ops.distinct_counts(read_table(spark, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


LIMITS = [10, 50, 100]


@query(
    "rare_categories",
    "WITH c AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)" + " UNION ALL ".join(
        f""" SELECT {m} AS min_count, CAST(COUNT(*) FILTER (n < {m}) AS BIGINT) AS n_categories,
        round(100.0 * COALESCE(SUM(n) FILTER (n < {m}), 0) / SUM(n), 6) AS row_pct FROM c""" for m in LIMITS),
)
def rare_categories(spark, d):
    return rounded(ops.rare_categories(read_table(spark, d, "orders"), "o_custkey", LIMITS))


_CUMSHARE_SQL = """
    WITH c AS (SELECT o_custkey AS value, COUNT(*) AS n FROM orders GROUP BY 1),
    r AS (SELECT value, n, row_number() OVER w AS position,
          round(100.0 * SUM(n) OVER (w ROWS UNBOUNDED PRECEDING) / SUM(n) OVER (), 6) AS cum_pct
          FROM c WINDOW w AS (ORDER BY n DESC, value))
"""


@query("category_cumshare", _CUMSHARE_SQL + "SELECT value, n, position, cum_pct FROM r")
def category_cumshare(spark, d):
    return rounded(ops.cumulative_share(read_table(spark, d, "orders"), "o_custkey"))


@query("categories_for_95", _CUMSHARE_SQL + "SELECT CAST(COUNT(*) FILTER (cum_pct <= 95) + 1 AS BIGINT) AS n_needed FROM r")
def categories_for_95(spark, d):
    return ops.categories_for_share(ops.cumulative_share(read_table(spark, d, "orders"), "o_custkey"), 95)


@query(
    "hour_weekday_means",
    """SELECT CAST(hour(ts) AS INT) AS hour_of_day, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
       round(AVG(value), 6) AS mean_value, COUNT(*) AS n FROM events GROUP BY 1, 2""",
)
def hour_weekday_means(spark, d):
    events = read_table(spark, d, "events").select(
        F.hour("ts").alias("hour_of_day"), F.weekday("ts").alias("day_of_week"), "value"
    )
    return rounded(ops.mean_by(events, ["hour_of_day", "day_of_week"], "value"))


@query(
    "weekday_profile",
    "WITH " + DAILY_SQL + """
    SELECT series, CAST(isodow(date) - 1 AS INT) AS day_of_week, round(AVG(sales) + 1e-7, 4) AS mean_sales,
           round(quantile_cont(sales, 0.5), 4) AS median_sales, round(stddev_samp(sales), 4) AS std_sales
    FROM observed GROUP BY 1, 2""",
)
def weekday_profile(spark, d):
    profile = series_ops.weekday_profile(observed_days(spark, d), KEYS)
    # Both sides move exact ties off the rounding boundary.
    return rounded(profile.withColumn("mean_sales", F.col("mean_sales") + 1e-7), 4)


@query(
    "best_worst_day",
    "WITH " + DAILY_SQL + """
    , p AS (SELECT series, CAST(isodow(date) - 1 AS INT) AS dow, AVG(sales) AS m FROM observed GROUP BY 1, 2)
    SELECT series, arg_max(dow, m) AS best_day, arg_min(dow, m) AS worst_day FROM p GROUP BY 1""",
)
def best_worst_day(spark, d):
    return series_ops.best_and_worst_day(series_ops.weekday_profile(observed_days(spark, d), KEYS), KEYS)


@query(
    "missing_days",
    "WITH " + DAILY_SQL + "SELECT series, CAST(date AS VARCHAR) AS date FROM (SELECT series, date FROM spine EXCEPT SELECT series, date FROM observed)",
)
def missing_days(spark, d):
    return rounded(series_ops.missing_days(observed_days(spark, d), KEYS))


@query(
    "missing_by_weekday",
    "WITH " + DAILY_SQL + """SELECT series, CAST(isodow(date) - 1 AS INT) AS day_of_week, COUNT(*) AS n_missing
    FROM (SELECT series, date FROM spine EXCEPT SELECT series, date FROM observed) GROUP BY 1, 2""",
)
def missing_by_weekday(spark, d):
    return series_ops.missing_by_weekday(observed_days(spark, d), KEYS)


_FIRST_MISSING_SQL = """, m AS (SELECT series, date, row_number() OVER (ORDER BY date, series) AS rn
    FROM (SELECT series, date FROM spine EXCEPT SELECT series, date FROM observed))
    SELECT series, CAST(date AS VARCHAR) AS date FROM m WHERE rn <= 20"""


@query("first_missing_days", "WITH " + DAILY_SQL + _FIRST_MISSING_SQL)
def first_missing_days(spark, d):
    missing = series_ops.missing_days(observed_days(spark, d), KEYS)
    return rounded(ops.top_rows(missing, [F.col("date"), F.col("series")], 20))


@query(
    "corr_matrix",
    "WITH " + ORDERS_SQL + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM og"
        for a in NUMERIC for b in NUMERIC),
)
def corr_matrix(spark, d):
    return rounded(ops.correlation_pairs(orders_grain(spark, d), NUMERIC))


@query(
    "histogram",
    """
    WITH b AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders),
    s AS (SELECT CAST(least(floor((o_totalprice - lo) * 50 / (hi - lo)), 49) AS INT) AS bin, lo, hi FROM orders, b)
    SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_start, COUNT(*) AS n FROM s GROUP BY bin, lo, hi
    """,
)
def histogram(spark, d):
    return rounded(ops.histogram(read_table(spark, d, "orders"), "o_totalprice", 50))


@query(
    "box_stats",
    "WITH " + ORDERS_SQL + _per_metric("""
    SELECT payment_name, '{c}' AS metric, COUNT(*) AS n, round(CAST(MIN({c}) AS DOUBLE), 6) AS low,
           round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
           round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, round(CAST(MAX({c}) AS DOUBLE), 6) AS high
    FROM og GROUP BY 1""", ["order_amount_brutto", "n_items"]),
)
def box_stats(spark, d):
    return rounded(ops.box_stats(orders_grain(spark, d), ["payment_name"], ["order_amount_brutto", "n_items"]))


@query(
    "top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_orders(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ops.top_rows(orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query(
    "daily_profile",
    "WITH " + DAILY_SQL + """SELECT series, CAST(date AS VARCHAR) AS date, sales, order_count,
    round(sales / order_count, 6) AS avg_order_value FROM observed""",
)
def daily_profile(spark, d):
    return rounded(series_ops.daily_profile(keyed_orders(spark, d), KEYS, "o_orderdate", "o_totalprice"))


@query(
    "eda_summary",
    "WITH " + DAILY_SQL + """
    , q AS (SELECT s.series, s.date, o.sales, o.order_count FROM spine s LEFT JOIN observed o USING (series, date)),
    f AS (SELECT series, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3 FROM q WHERE sales > 0 GROUP BY 1)
    SELECT q.series, CAST(MIN(q.date) AS VARCHAR) AS first_day, CAST(MAX(q.date) AS VARCHAR) AS last_day, COUNT(*) AS n_days,
      CAST(COUNT(*) FILTER (q.sales IS NULL) AS BIGINT) AS n_missing,
      round(100.0 * COUNT(*) FILTER (q.sales IS NULL) / COUNT(*), 6) AS missing_pct,
      CAST(COUNT(*) FILTER (q.sales > q3 + 1.5 * (q3 - q1) OR (q.sales < q1 - 1.5 * (q3 - q1) AND q.sales > 0)) AS BIGINT) AS n_outliers,
      round(AVG(COALESCE(q.sales, 0)), 4) AS mean_sales, round(quantile_cont(COALESCE(q.sales, 0), 0.5), 4) AS median_sales,
      round(stddev_samp(COALESCE(q.sales, 0)), 4) AS std_sales, MIN(COALESCE(q.sales, 0)) AS min_sales, MAX(q.sales) AS max_sales,
      round(AVG(COALESCE(q.order_count, 0)), 6) AS mean_orders_per_day,
      round(AVG(q.sales / q.order_count) FILTER (q.sales > 0), 4) AS mean_order_value
    FROM q JOIN f USING (series) GROUP BY 1""",
)
def eda_summary(spark, d):
    from orderloom.operators.anomalies import iqr_flags

    daily = series_ops.daily_profile(keyed_orders(spark, d), KEYS, "o_orderdate", "o_totalprice")
    days = series_ops.on_spine(daily, KEYS).withColumn("_missing", F.col("sales").isNull())
    days = iqr_flags(days.fillna({"sales": 0.0, "order_count": 0}), KEYS)
    out = days.groupBy(*KEYS).agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
        F.count_if("_missing").alias("n_missing"),
        (100.0 * F.count_if("_missing") / F.count(F.lit(1))).alias("missing_pct"),
        F.count_if("is_outlier").alias("n_outliers"),
        F.round(F.avg("sales"), 4).alias("mean_sales"),
        F.round(F.percentile("sales", F.lit(0.5)), 4).alias("median_sales"),
        F.round(F.stddev_samp("sales"), 4).alias("std_sales"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
        F.avg("order_count").alias("mean_orders_per_day"),
        F.round(F.avg(F.when(F.col("sales") > 0, F.col("avg_order_value"))), 4).alias("mean_order_value"),
    )
    return rounded(out)


SEGMENT_RULE = "CASE WHEN n_items >= 6 THEN 'Large' WHEN n_items >= 2 THEN 'Middle' ELSE 'Small' END"


@query(
    "kpis",
    "WITH " + ORDERS_SQL + f"""
    SELECT COUNT(*) AS n_orders, COUNT(DISTINCT {SEGMENT_RULE}) AS n_segments, CAST(COUNT(*) FILTER (n_items = 0) AS BIGINT) AS n_noise,
           round(100.0 * COUNT(*) FILTER (n_items = 0) / COUNT(*), 6) AS noise_pct,
           round(AVG(order_amount_brutto), 4) AS mean_order_value FROM og""",
)
def kpis(spark, d):
    og = orders_grain(spark, d).select(
        F.expr(SEGMENT_RULE).alias("segment"), (F.col("n_items") == 0).alias("is_noise"), "order_amount_brutto"
    )
    return rounded(ops.kpis(og, "segment", "is_noise", "order_amount_brutto").withColumn("mean_order_value", F.round("mean_order_value", 4)))


EXPLORER_COLUMNS = ["order_id", "date_add", "order_amount_brutto", "n_items", "avg_item_price", "max_item_price",
                    "delivery_type", "payment_name", "segment", "is_noise"]


@query(
    "explorer",
    "WITH " + ORDERS_SQL + f"""
    SELECT order_id, CAST(date_add AS VARCHAR) AS date_add, order_amount_brutto, n_items, round(avg_item_price, 8) AS avg_item_price,
           round(max_item_price, 8) AS max_item_price, delivery_type, payment_name, {SEGMENT_RULE} AS segment,
           CAST(n_items = 0 AS INT) AS is_noise FROM og WHERE {SEGMENT_RULE} IN ('Large', 'Small')""",
)
def explorer(spark, d):
    og = orders_grain(spark, d).withColumns(
        {"segment": F.expr(SEGMENT_RULE), "is_noise": F.col("n_items") == 0}
    )
    return rounded(ops.explore(og, ["Large", "Small"], columns=EXPLORER_COLUMNS), 8)


@query(
    "frequent_category_rows",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) >= 15)""",
)
def frequent_category_rows(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    counts = ops.value_counts(orders, "o_custkey").where("n >= 15").select(F.col("value").alias("o_custkey"))
    return orders.join(counts, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query(
    "size_distribution",
    "SELECT p_brand, COUNT(*) AS size, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS pct FROM part GROUP BY 1",
)
def size_distribution(spark, d):
    return rounded(ops.size_distribution(read_table(spark, d, "part"), "p_brand"))
