"""Descriptive tables over order-grain data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.ranks import QUARTILES, exact_quantiles, melt, running_total


def unpivot_one(row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column_name") -> DataFrame:
    """Turn one wide row with ``{name}__{field}`` columns into one row per name."""
    entries = [F.struct(F.lit(n).alias(key), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names]
    return row.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column."""
    table = exact_quantiles(df, columns, QUARTILES, moments=True)
    return table.select("metric", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column and their share, in one pass."""
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__n_null") for c in df.columns],
        *[F.count(F.lit(1)).alias(f"{c}__n_rows") for c in df.columns],
    )
    return unpivot_one(row, df.columns, ["n_null", "n_rows"]).withColumn(
        "null_pct", F.when(F.col("n_rows") > 0, 100.0 * F.col("n_null") / F.col("n_rows"))
    )


def corrected_skew(value: Column) -> Column:
    """Bias-corrected sample skewness from the population skewness."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def skew_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = melt(df, columns)
    return long.groupBy("metric").agg(
        corrected_skew(F.col("value")).alias("skew_raw"),
        corrected_skew(F.log1p("value")).alias("skew_log"),
    )


def percentile_table(df: DataFrame, column: str, percents: Sequence[int]) -> DataFrame:
    names = {f"p{p}": p / 100.0 for p in percents}
    row = exact_quantiles(df, [column], names)
    entries = [F.struct(F.lit(p).alias("percent"), F.col(f"p{p}").alias("value")) for p in percents]
    return row.select(F.inline(F.array(*entries)))


def upper_fence_counts(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Rows strictly above Q3 + factor * IQR, per column."""
    fences = exact_quantiles(df, columns, {"q25": 0.25, "q75": 0.75}).select(
        "metric", "n", (F.col("q75") + factor * (F.col("q75") - F.col("q25"))).alias("threshold")
    )
    # One fence row per named column, so the map below has a handful of entries.
    bounds = fences.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "threshold"))).alias("bounds")
    ).scalar()
    above = melt(df, columns).groupBy("metric").agg(
        F.count_if(F.col("value") > F.element_at(bounds, F.col("metric"))).alias("n_outliers")
    )
    return fences.join(above, "metric").select(
        "metric", "threshold", "n_outliers", (100.0 * F.col("n_outliers") / F.col("n")).alias("outlier_pct")
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if top is None:
        return counts
    return counts.orderBy(F.desc("n"), "value").limit(top)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column; duplicates collapse on the map side."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    return long.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def rare_categories(df: DataFrame, column: str, limits: Sequence[int]) -> DataFrame:
    """For each limit: categories with fewer rows, and the share of rows they hold."""
    counts = value_counts(df.where(F.col(column).isNotNull()), column)
    row = counts.agg(
        F.sum("n").alias("n_rows"),
        *[F.count_if(F.col("n") < m).alias(f"c{m}") for m in limits],
        *[F.coalesce(F.sum(F.when(F.col("n") < m, F.col("n"))), F.lit(0)).alias(f"r{m}") for m in limits],
    )
    entries = [
        F.struct(
            F.lit(m).alias("min_count"),
            F.col(f"c{m}").alias("n_categories"),
            (100.0 * F.col(f"r{m}") / F.col("n_rows")).alias("row_pct"),
        )
        for m in limits
    ]
    return row.select(F.inline(F.array(*entries)))


def cumulative_share(df: DataFrame, column: str) -> DataFrame:
    """Categories by falling count with the running share of rows in percent."""
    counts = value_counts(df.where(F.col(column).isNotNull()), column).withColumn("_one", F.lit(1))
    run = running_total(counts, [F.desc("n"), F.col("value")], {"_upto": "n", "position": "_one"})
    return run.select(
        "value", "n", F.col("position"), (100.0 * F.col("_upto") / F.col("_upto_all")).alias("cum_pct")
    )


def categories_for_share(shares: DataFrame, percent: float, column: str = "cum_pct") -> DataFrame:
    """Number of leading entries whose running share stays within ``percent``, plus one."""
    return shares.agg((F.count_if(F.col(column) <= percent) + 1).alias("n_needed"))


def mean_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n")
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of Pearson correlations in one pass, as a long table."""
    pairs = [(a, b) for a in columns for b in columns]
    half = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in half])
    entries = []
    for a, b in pairs:
        source = f"{a}|{b}" if f"{a}|{b}" in row.columns else f"{b}|{a}"
        entries.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{source}`").alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over min..max; the last bin is closed on the right."""
    value = F.col(column)
    edges = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    lo, hi = edges["lo"], edges["hi"]
    slot = F.when(hi > lo, F.floor((value - lo) * bins / (hi - lo))).otherwise(F.lit(0))
    binned = df.where(value.isNotNull()).select(F.least(slot, F.lit(bins - 1)).cast("int").alias("bin"), lo.alias("_lo"), hi.alias("_hi"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return counts.select("bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"), "n")


def box_stats(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return exact_quantiles(
        df, columns, {"low": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "high": 1.0}, by=by
    )


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def kpis(orders: DataFrame, segment: str, noise: str, amount: str) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_distinct(segment).alias("n_segments"),
        F.count_if(F.col(noise)).alias("n_noise"),
        F.try_divide(100.0 * F.count_if(F.col(noise)), F.count(F.lit(1))).alias("noise_pct"),
        F.avg(amount).alias("mean_order_value"),
    )


def explore(
    df: DataFrame,
    segments: Sequence[str],
    noise_only: bool = False,
    columns: Sequence[str] | None = None,
    amount: str = "order_amount_brutto",
) -> DataFrame:
    """Rows of the chosen segments, optionally only noise, highest amount first."""
    kept = df.where(F.col("segment").isin(list(segments)))
    if noise_only:
        kept = kept.where("is_noise")
    present = [c for c in columns if c in kept.columns] if columns else kept.columns
    return kept.select(*present).orderBy(F.desc(amount))


def size_distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per group and their percent of all rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumn("pct", 100.0 * F.col("size") / sizes.agg(F.sum("size").alias("n")).scalar())
