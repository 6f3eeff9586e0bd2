"""Exact running totals and quantiles without a single-task sort.

A window with no partition key, or the built-in exact ``percentile``, brings a
whole group into one task.  Here equal values are counted first (so repeated
values cost one row), the counts are range-partitioned over all tasks, and each
range only needs the total of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import settle

#: Values a column may have before ranks are bracketed, and counted rows one task may rank.
KEEP_ALL, ONE_TASK = 100_000, 1_000_000
ACCURACY = 10_000  # of the approximate percentiles; brackets reach five times their error


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    values: dict[str, str],
    by: Sequence[str] = (),
    next_of: str | None = None,
) -> DataFrame:
    """Add, for every ``values`` item (out -> column), the running total in
    ``order`` including the row itself as ``out`` and the total of the group as
    ``out + "_all"``.  With ``next_of`` (the ascending order column) the value
    of the following row is added as ``_next``.
    """
    by = list(by)
    spread = df.repartitionByRange(*[F.col(c) for c in by], *order)
    # The range bounds come from a sample, so the slices are fixed by a
    # checkpoint before they are used by two branches of the plan.
    sliced = settle(spread.withColumn("_slice", F.spark_partition_id()))
    first = [F.min(next_of).alias("_first")] if next_of else []
    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in values.items()], *first)
    # One row per slice and group: at most (slices + groups) rows.
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in values],
        *[F.sum(f"_t_{o}").over(whole).alias(f"{o}_all") for o in values],
        *([F.lead("_first").over(whole.orderBy("_slice")).alias("_after")] if next_of else []),
    )
    inner = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = sliced.join(offsets, [*by, "_slice"])
    for out, column in values.items():
        joined = joined.withColumn(out, F.sum(column).over(inner) + F.col(f"_b_{out}"))
    if next_of:
        following = F.lead(next_of).over(Window.partitionBy(*by, "_slice").orderBy(*order))
        joined = joined.withColumn("_next", F.coalesce(following, F.col("_after"))).drop("_after")
    return joined.drop("_slice", *[f"_b_{o}" for o in values])


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., metric, value) with missing values removed."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(*by, F.inline(pairs))
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _brackets(lows: list[float], highs: list[float]) -> list[tuple[float, float]]:
    """The ranges [low, high] joined where they overlap, rising."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(zip(lows, highs)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _selected(df: DataFrame, columns: list[str], probabilities: dict[str, float], moments: bool) -> DataFrame | None:
    """``exact_quantiles`` by selection: the first pass brackets each rank, the second counts what lies below the brackets
    and keeps only values within them.  None should a rank lie outside its bracket (the error bound would be broken)."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    reach = 5.0 / ACCURACY
    asked = [max(0.0, p - reach) for p in probabilities.values()] + [min(1.0, p + reach) for p in probabilities.values()]
    first = df.agg(*[
        f(value[c]).alias(f"{c}__{name}")
        for c in columns
        for name, f in (("n", F.count), ("q", lambda v: F.percentile_approx(v, asked, ACCURACY)), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]).first()
    present = [c for c in columns if first[f"{c}__n"]]
    if not present:
        return None
    parts = []
    for c in present:
        v, half = value[c], len(probabilities)
        kept, below = v.isNotNull(), F.lit(0)
        if first[f"{c}__n"] > KEEP_ALL:
            ranges = _brackets(first[f"{c}__q"][:half], first[f"{c}__q"][half:])
            kept = F.lit(False)
            for low, high in ranges:
                kept, below = kept | v.between(low, high), below + (v > high).cast("int")
        parts.append(F.struct(F.lit(c).alias("metric"), F.when(kept, v).alias("value"), F.when(v.isNotNull(), below).alias("_gap")))
    # A row outside the brackets only counts for the gap it lies in, before the bracket of the same number.
    long = df.select(F.inline(F.array(*parts))).where("_gap is not null")
    counts = settle(long.groupBy("metric", "_gap", "value").agg(F.count(F.lit(1)).alias("_n")))
    if counts.count() <= ONE_TASK:
        order = Window.partitionBy("metric").orderBy("_gap", F.asc_nulls_first("value"))
        ranked = counts.withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        ranked = running_total(counts, [F.col("_gap"), F.col("value")], {"_upto": "_n"}, by=["metric"])
    chosen = lambda items: F.coalesce(*[F.when(F.col("metric") == c, F.lit(x)) for c, x in items])
    ranked = ranked.withColumn("n", chosen((c, first[f"{c}__n"]) for c in present))
    start, picks, out = F.col("_upto") - F.col("_n"), [], []
    for name, p in probabilities.items():
        position = (F.col("n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.max(F.when((start <= rank) & (rank < F.col("_upto")), F.col("value"))).alias(f"_{name}_{side}"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    found = settle(ranked.groupBy("metric", "n").agg(*picks))  # a row for each column
    lost = F.lit(False)
    for name in probabilities:
        lost = lost | F.col(f"_{name}_lo").isNull() | F.col(f"_{name}_hi").isNull()
    if not found.where(lost).isEmpty():
        return None
    known = [chosen((c, first[f"{c}__{x}"]) for c in present).cast("double").alias(x) for x in ("mean", "std", "min", "max")] if moments else []
    return found.select("metric", "n", *known, *out)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    moments: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group and column.

    Without groups ranks are found by selection: two passes, and only values near a rank are moved.

    Output: by..., metric, n, and one double per ``probabilities`` item; with
    ``moments`` also mean, std (sample), min and max from the same pass.
    """
    if not by:
        found = _selected(df, list(columns), probabilities, moments)
        if found is not None:
            return found
    by = list(by)
    counts = melt(df, columns, by).groupBy(*by, "metric", "value").agg(F.count(F.lit(1)).alias("_n"))
    totals = {"_upto": "_n"}
    if moments:
        counts = counts.withColumn("_weighted", F.col("value") * F.col("_n"))
        totals["_sum"] = "_weighted"
    ranked = running_total(counts, [F.col("value")], totals, by=[*by, "metric"])
    start = F.col("_upto") - F.col("_n")
    picks = [F.max("_upto_all").alias("n")]
    for name, p in probabilities.items():
        position = (F.col("_upto_all") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (start <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"_{name}_{side}"))
    if moments:
        # The group's total is on every row, so deviations are taken from the mean itself.
        away = F.col("value") - F.col("_sum_all") / F.col("_upto_all")
        picks += [
            F.max(F.col("_sum_all") / F.col("_upto_all")).alias("mean"),
            F.sum(F.col("_n") * away * away).alias("_s2"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        ]
    found = ranked.groupBy(*by, "metric").agg(*picks)
    out = []
    if moments:
        out += [
            F.col("mean"),
            F.when(F.col("n") > 1, F.sqrt(F.col("_s2") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("std"),
            F.col("min"),
            F.col("max"),
        ]
    for name, p in probabilities.items():
        position = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(*by, "metric", "n", *out)


def widen(stats: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row with ``{column}_{name}`` from a long table keyed by ``metric``."""
    return stats.agg(
        *[F.max(F.when(F.col("metric") == c, F.col(n))).alias(f"{c}_{n}") for c in columns for n in names]
    )


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
