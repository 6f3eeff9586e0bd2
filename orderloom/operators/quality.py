"""Data-quality checks against a reference profile, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.ranks import exact_quantiles

# Limits of the checks.
NULL_ERROR_PCT = 50
NULL_WARNING_PCT = 5
RANGE_FACTOR = 3
MIN_ROWS = 7


def reference_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """min, max, mean, std, q01, q99 of each numeric column."""
    table = exact_quantiles(df, columns, {"q01": 0.01, "q99": 0.99}, by=by, moments=True)
    return table.select(*by, "metric", "min", "max", "mean", "std", "q01", "q99")


def _entry(check: str, column: str, severity: Column, value: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        severity.alias("severity"),
        value.cast("double").alias("value"),
        message.alias("message"),
    )


def quality_report(
    df: DataFrame,
    profile: DataFrame,
    expected: Sequence[str],
    by: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """One row per finding: by..., check, column_name, severity, value, message."""
    by = list(by)
    data = [c for c in df.columns if c not in by]
    numeric = [n for n, t in df.dtypes if n in data and t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in data]
    for c in numeric:
        aggregates += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")]
    if date in data:
        aggregates.append((F.count(date) - F.count_distinct(date)).alias("_dups"))
    facts = df.groupBy(*by).agg(*aggregates)

    bounds = profile.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct("min", "max")))).alias("_ref")
    )
    if by:
        facts = facts.join(bounds, by, "left")
    else:
        facts = facts.withColumn("_ref", bounds.scalar())

    rows = F.col("_rows")
    entries = []
    for c in expected:
        if c not in df.columns:
            entries.append(_entry("missing_column", c, F.lit("error"), F.lit(1), F.lit(f"Missing column: {c}")))
    for c in data:
        pct = F.bround(100.0 * F.col(f"_null_{c}") / rows, 1)
        level = F.when(pct > NULL_ERROR_PCT, "error").when(pct > NULL_WARNING_PCT, "warning")
        entries.append(_entry("null_rate", c, level, pct, F.format_string(f"Column '{c}' has %.1f%% nulls", pct)))
    for c in numeric:
        ref = F.try_element_at(F.col("_ref"), F.lit(c))
        span = ref["max"] - ref["min"]
        low, high = F.col(f"_min_{c}").cast("double"), F.col(f"_max_{c}").cast("double")
        text = "Column '%s' %s=%%.1f is far %s reference range [%%.1f, %%.1f]"
        under = (span > 0) & (low < ref["min"] - RANGE_FACTOR * span)
        over = (span > 0) & (high > ref["max"] + RANGE_FACTOR * span)
        entries.append(_entry("range_low", c, F.when(under, "warning"), low,
                              F.format_string(text % (c, "min", "below"), low, ref["min"], ref["max"])))
        entries.append(_entry("range_high", c, F.when(over, "warning"), high,
                              F.format_string(text % (c, "max", "above"), high, ref["min"], ref["max"])))
    if date in data:
        dups = F.col("_dups")
        entries.append(_entry("duplicate_dates", date, F.when(dups > 0, "error"), dups,
                              F.format_string("Found %d duplicate dates", dups)))
    entries.append(_entry("min_rows", "", F.when(rows < MIN_ROWS, "warning"), rows,
                          F.format_string("Dataset has only %d rows, may be insufficient for reliable analysis", rows)))
    total_nulls = sum((F.col(f"_null_{c}") for c in data), F.lit(0))
    entries.append(_entry("n_rows", "", F.lit("stat"), rows, F.lit("rows")))
    entries.append(_entry("n_cols", "", F.lit("stat"), F.lit(len(df.columns)), F.lit("columns")))
    entries.append(_entry("null_rate_all", "", F.lit("stat"),
                          F.round(total_nulls / (rows * len(df.columns)), 4), F.lit("mean null rate")))
    return facts.select(*by, F.inline(F.array(*entries))).where("severity is not null")


def quality_verdict(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return report.groupBy(*by).agg(
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
        (F.count_if(F.col("severity") == "error") == 0).alias("is_valid"),
    )
