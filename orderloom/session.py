"""Session settings and lineage control shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with the settings the operators assume.

    On a cluster the master, memory and shuffle partition count come from
    spark-submit; only the semantic settings are fixed here.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
        if master.startswith("local["):
            builder = builder.config("spark.sql.shuffle.partitions", master[6:-1].replace("*", str(os.cpu_count())))
            builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and stream state that every executor can reach.

    It is the one named by ``spark.checkpoint.dir``; a temporary folder is only
    acceptable for a local master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None and context.getCheckpointDir() is not None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="orderloom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


#: Rows of a few numbers that are worth a file of their own.
FILE_ROWS = 50_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` narrow rows, in no more partitions than that many fill: each partition written is a file.

    The rows are dealt out anew, so that what makes them keeps its own partitions.
    """
    return df.repartition(max(1, -(-rows // FILE_ROWS)))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back.

    Used where a plan must not be evaluated twice with different outcomes
    (range bounds) or where an iteration would grow its lineage.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
