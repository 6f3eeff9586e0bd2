"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import shared_folder

#: ASCII white space, as the word patterns of the operators name it.
WHITE = " \t\n\x0b\f\r"

#: Bytes of an Arrow batch, beyond which the rows go to the next one.  Spark's own 64 MB are held several times over, by
#: the JVM and by each Python worker, in memory that neither gives back.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names an operator is about to give to its own results (in any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def plus(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    """The schema of ``df`` with more columns."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in kinds.items()]])


def arrow_map(df: DataFrame, batch: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` for a function of one batch; batches have about BATCH_BYTES, and at least a row.

    The limit is a setting of the session, read when the plan runs, so it stays; a lower one is left as it is.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(key)) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))

    def run(batches):
        for b in batches:
            made = batch(b)
            if isinstance(made, pa.RecordBatch):
                yield made
            else:
                yield from made

    return df.mapInArrow(run, schema)


def slices(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` characters, so that a batch of long texts needs no more memory than a few."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


class Workspace:
    """Intermediate tables in the folder all executors share (``spark.checkpoint.dir``).

    A table is written once and read back, so later stages survive the loss of an executor and nothing is computed
    twice.  ``drop`` removes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
