"""Retraining decisions per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The retraining schedule and the row count that is only reported.
SCHEDULE_HOURS = 168
MIN_NEW_ROWS = 30


def retrain_triggers(
    state: DataFrame, performance: DataFrame, drift: DataFrame, by: Sequence[str], now: Column
) -> DataFrame:
    """Reasons to retrain.

    ``state`` holds by..., last_retrain and new_rows.  The number of new rows
    is reported but does not decide.
    """
    by = list(by)
    joined = state.join(performance, by, "left").join(drift, by, "left")
    hours = (F.unix_timestamp(now) - F.unix_timestamp("last_retrain")) / 3600.0
    reasons = F.array_compact(
        F.array(
            F.when(
                hours > SCHEDULE_HOURS,
                F.format_string(f"Time-based: %.0fh since last retrain (threshold: {SCHEDULE_HOURS}h)", hours),
            ),
            F.when(F.col("alert"), F.format_string("Performance-based: MAE degraded by %.1f%%", F.col("degradation_pct"))),
            F.when(
                F.col("dataset_drift"),
                F.format_string("Data-based: Drift detected in %d features", F.col("number_of_drifted_columns")),
            ),
        )
    )
    return joined.select(
        *by,
        F.round(hours, 1).alias("hours_since_last_retrain"),
        (F.size(reasons) > 0).alias("should_retrain"),
        F.concat_ws("; ", reasons).alias("reasons"),
        (F.col("new_rows") >= MIN_NEW_ROWS).alias("sufficient_new_data"),
    )


def improvement_gate(candidates: DataFrame, production: DataFrame, by: Sequence[str]) -> DataFrame:
    """Register a candidate whose MAE beats production, or that has no predecessor."""
    joined = candidates.join(production, list(by), "left")
    return joined.withColumn("register", F.col("current_mae").isNull() | (F.col("new_mae") < F.col("current_mae")))
