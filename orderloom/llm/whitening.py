"""Embedding whitening by spectrum slicing.

Entries become whole numbers (floor of 256 times the entry), and each distinct vector is fitted to once.  Tasks sum
centred outer products, rows of the sums are added, and the covariance, as wide as a vector, comes to the driver.  There
a leading eigenvalue is isolated by counts: by Sylvester's law, the pivots of L D L' of the covariance less a shift have
as many positive signs as there are eigenvalues above the shift.  Bisection goes on until one eigenvalue is left between
two shifts, Rayleigh quotient iteration converges to it, and two more counts, just below and just above, certify its
number.  Eigenvalues too close for double precision to tell apart are taken as one cluster with an orthonormal basis.

Vectors that are null or hold null or non-finite entries are dropped (``whiten`` keeps the row, with null results).
Vectors shorter than the longest are filled up with 0; repeated vectors and rows without vec_id are rows like others.
There are no more components than dimensions.  A component whose eigenvalue is 0 to double precision has null as
``whitened`` and takes no part in identity_error (null if none does); ``explained`` is null where all vectors are equal.
A deviation too large for a long is null as such and whole in ``deviation_digits``.  An empty table gives an empty
table; columns named like a result are replaced, others kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Workspace, arrow_map, plus, without

COMPONENTS = 4
STEP = 4096  # vectors a worker takes at once
GROUPS = 32  # first-level sums of a row of the covariance
EPS = np.finfo(float).eps


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` exceed ``shift``: positive ones of D in L D L' (Bunch-Kaufman pivots)."""
    m = a - shift * np.eye(len(a))
    size, limit, k, count = len(m), (1 + math.sqrt(17)) / 8, 0, 0
    none = EPS * EPS * float(np.abs(m).max())  # far below what rounding leaves
    while k < size:
        width, pivot = 1, k
        own = abs(m[k, k])
        if k + 1 < size:
            below = np.abs(m[k + 1 :, k])
            r = k + 1 + int(below.argmax())
            most = below[r - k - 1]
            if max(own, most) <= none:
                k += 1
                continue
            if own < limit * most:
                row = np.abs(m[k:, r])
                row[r - k] = 0
                other = row.max()
                if own * other >= limit * most * most:
                    pass
                elif abs(m[r, r]) >= limit * other:
                    pivot = r
                else:
                    width, pivot = 2, r
        at = k + width - 1
        if pivot != at:
            m[[at, pivot]] = m[[pivot, at]]
            m[:, [at, pivot]] = m[:, [pivot, at]]
        if width == 2:
            count += 1  # the two signs of a 2 x 2 pivot differ
            side = m[k + 2 :, k : k + 2]
            change = side @ np.linalg.solve(m[k : k + 2, k : k + 2], side.T)
            m[k + 2 :, k + 2 :] -= (change + change.T) / 2  # symmetric to the last bit, as the choice of pivots asks
        elif abs(m[k, k]) > none:
            count += bool(m[k, k] > 0)
            side = m[k + 1 :, k]
            m[k + 1 :, k + 1 :] -= np.outer(side, side) / m[k, k]
        k += width
    return count


def _solved(a: np.ndarray, shift: float, b: np.ndarray, nudge: float) -> np.ndarray:
    try:
        return np.linalg.solve(a - shift * np.eye(len(a)), b)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        return np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), b)


def _rayleigh(a: np.ndarray, shift: float, tiny: float) -> tuple[float, np.ndarray]:
    """The eigenpair to which inverse iteration at ``shift``, then at the quotient, comes; the error falls by its third power."""
    x = np.random.default_rng(len(a)).normal(size=len(a))
    for _ in range(2):
        x = _solved(a, shift, x, tiny)
        x /= np.linalg.norm(x)
    best, value, vector = np.inf, 0.0, x
    for _ in range(30):
        q = float(x @ a @ x)
        error = float(np.linalg.norm(a @ x - q * x))
        if error >= best / 2:
            break
        best, value, vector = error, q, x
        if error == 0:
            break
        x = _solved(a, q, x, tiny)
        x /= np.linalg.norm(x)
    return value, vector


def _cluster(a: np.ndarray, shift: float, size: int, tiny: float) -> tuple[list[float], np.ndarray]:
    """An orthonormal basis of ``size`` eigenvalues at ``shift``."""
    x = np.random.default_rng(size).normal(size=(len(a), size))
    for _ in range(4):
        x = np.linalg.qr(_solved(a, shift + tiny, np.linalg.qr(x)[0], tiny))[0]
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return [float(v) for v in values[order]], x[:, order]


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns; the entry of largest size is positive."""
    scale = float(np.abs(a).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger
    if scale == 0:
        return np.zeros(k), np.eye(len(a))[:, :k]
    a = (a + a.T) / 2
    tiny = 4 * len(a) * EPS * scale
    values, vectors = [], []
    top = 2 * scale
    while len(values) < k:
        number = len(values) + 1
        low, high, under = -2 * scale, top, len(a)  # ``under`` eigenvalues above low, number - 1 above high
        while True:
            if under == number:
                value, vector = _rayleigh(a, (low + high) / 2, tiny / 4)
                if low - tiny <= value <= high + tiny and above(a, value - tiny) == number and above(a, value + tiny) == number - 1:
                    values.append(value)
                    vectors.append(vector)
                    top = value - tiny
                    break
            if high - low <= tiny:
                size = above(a, low - tiny) - (number - 1)
                found, basis = _cluster(a, (low + high) / 2, size, tiny / 4)
                values += found
                vectors += list(basis.T)
                top = low - tiny
                break
            middle = (low + high) / 2
            n = above(a, middle)
            if n >= number:
                low, under = middle, n
            else:
                high = middle
    w = np.linalg.qr(np.array(vectors[:k]).T)[0]  # close eigenvalues, found one by one, leave their vectors slightly askew
    return np.array(values[:k]), w * np.where(w[np.abs(w).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Model:
    n: int  # distinct vectors
    sums: tuple[int, ...]
    largest: int  # size of any entry
    values: np.ndarray  # falling
    vectors: np.ndarray  # in columns
    trace: float
    identity_error: float | None

    @property
    def usable(self) -> np.ndarray:
        return self.values > 4 * len(self.sums) * EPS * max(self.trace, 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x.astype(float) - np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(np.where(self.usable, self.values, 1.0)))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n * x - sums)^2, exact."""
        n, largest, top = self.n, max(self.largest, 1), max(map(abs, self.sums), default=0)
        if (n * largest + top) ** 2 * len(self.sums) < 2**63:
            y = n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        if largest * max(largest, top) * len(self.sums) < 2**63:
            squares, products, rest = (x * x).sum(axis=1).tolist(), (x @ np.array(self.sums, np.int64)).tolist(), sum(s * s for s in self.sums)
            return [n * n * a - 2 * n * b + rest for a, b in zip(squares, products)]
        y = n * x.astype(object) - np.array(self.sums, object)
        return (y * y).sum(axis=1).tolist()


def _usable(column: str) -> Column:
    v = F.col(f"`{column}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False))


def _scaled(column: str, size: int | None = None) -> Column:
    """The vector as array<long>, filled up to ``size``."""
    x = F.transform(F.col(f"`{column}`"), lambda c: F.floor(c.cast("double") * 256))
    return x if size is None else F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(size) - F.size(x))))


def _matrix(lists: pa.Array, d: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.int64).reshape(-1, d)


def distinct_vectors(df: DataFrame, space: Workspace, column: str = "embedding") -> tuple[DataFrame, int]:
    """The fit list, written, with one column ``x``; and the number of dimensions."""
    made = space.keep(df.where(_usable(column)).select(_scaled(column).alias("x")).distinct(), "distinct")
    sizes = made.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if sizes.low != sizes.high:
        made = space.keep(made.select(F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(sizes.high) - F.size("x"))).alias("x")).distinct(), "filled")
    return made, sizes.high or 0


def totals(rows: DataFrame, d: int) -> tuple[int, tuple[int, ...], int]:
    """Number of vectors, exact sums by dimension, and the largest entry."""

    def run(batches):
        n, sums, largest = 0, [0] * d, 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            if len(x):
                top = max(abs(int(x.max())), abs(int(x.min())))
                largest = max(largest, top)
                part = x.sum(axis=0) if top * len(x) < 2**62 else x.astype(object).sum(axis=0)
                sums = [a + int(b) for a, b in zip(sums, part)]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(s) for s in sums]]), pa.array([str(largest)])], ["n", "sums", "largest"])

    big = T.DecimalType(38, 0)
    parts = rows.select("x").mapInArrow(run, "n long, sums array<string>, largest string").select("n", "largest", F.posexplode("sums").alias("i", "s"))
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(big)).alias("s"), F.max(F.col("largest").cast(big)).alias("largest")).orderBy("i").collect()  # a row for each dimension
    return int(found[0].n), tuple(int(r.s) for r in found), int(found[0].largest)


def covariance(rows: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    d = len(sums)
    mean = np.array([s / n for s in sums])

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for at in range(0, len(batch), STEP):
                y = _matrix(batch.column(0).slice(at, STEP), d) - mean
                total += y.T @ y
        for at in range(0, d, 256):
            part = range(at, min(d, at + 256))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([total[i].tobytes() for i in part], pa.binary())], ["i", "v"])

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:  # one row from each task, or from each first-level sum
        return pd.DataFrame({"i": [key[0]], "v": [np.sum([np.frombuffer(b) for b in part["v"]], axis=0).tobytes()]})

    kind = "i int, v binary"
    parts = rows.select("x").mapInArrow(run, kind).withColumn("part", F.spark_partition_id() % GROUPS)
    few = parts.groupBy("i", "part").applyInPandas(add, kind).groupBy("i").applyInPandas(add, kind)
    return np.array([np.frombuffer(r.v) for r in few.orderBy("i").collect()]) / n  # as many rows as dimensions


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """None where no vector can be used or none has an entry."""
    rows, d = distinct_vectors(df, Workspace(df.sparkSession, "whitening"), column)
    if d == 0:
        return None
    n, sums, largest = totals(rows, d)
    v = covariance(rows, n, sums)
    values, vectors = leading(v, min(components, d))
    model = Model(n, sums, largest, values, vectors, float(np.trace(v)), None)

    def run(batch: pa.RecordBatch):
        for at in range(0, len(batch), STEP):
            z = model.whitened(_matrix(batch.column(0).slice(at, STEP), d))
            yield pa.RecordBatch.from_arrays([pa.array(list(z), pa.list_(pa.float64()))], ["z"])

    used = np.flatnonzero(model.usable).tolist()
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return model
    z = arrow_map(rows.select("x"), run, "z array<double>")
    found = z.agg(*[F.covar_pop(F.get("z", i), F.get("z", j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return Model(n, sums, largest, values, vectors, model.trace, max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs))


def whiten(df: DataFrame, model: Model, column: str = "embedding") -> DataFrame:
    """``df`` with ``whitened`` array<double>, a value for each component, and ``deviation_digits``; null for vectors that are not used."""
    d = len(model.sums)
    df = without(df, "whitened", "deviation_digits", "_x")
    kind = plus(df, whitened=T.ArrayType(T.DoubleType()), deviation_digits=T.StringType())
    names = [f.name for f in kind.fields]

    def run(batch: pa.RecordBatch):
        for at in range(0, len(batch), STEP):
            part = batch.slice(at, STEP)
            lists = part.column(part.num_columns - 1)
            full = np.asarray(lists.is_valid())
            z, deviation = [None] * len(part), [None] * len(part)
            x = _matrix(lists.drop_null(), d)
            found = model.whitened(x).astype(object)
            found[:, ~model.usable] = None
            for i, w, s in zip(np.flatnonzero(full), found.tolist(), model.deviations(x)):
                z[i], deviation[i] = w, str(s)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(z, pa.list_(pa.float64())), pa.array(deviation, pa.string())], names)

    # A vector longer than all that were fitted to has no place among the components.
    fits = _usable(column) & (F.size(F.col(f"`{column}`")) <= d)
    return arrow_map(df.withColumn("_x", F.when(fits, _scaled(column, d))), run, kind)


def report(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits) of every used row."""
    model = fit(df, components=components)
    rows = df.select("vec_id", "embedding").where(_usable("embedding"))
    if model is None:
        none = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double", "deviation_digits": "string"}
        return rows.where("false").select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    shares = [float(max(v, 0.0)) / model.trace if model.trace > 0 else None for v in model.values]
    long = whiten(rows, model).select("vec_id", "deviation_digits", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.expr("try_cast(deviation_digits AS bigint)").alias("deviation"), "whitened",
        F.get(F.array(*[F.lit(s).cast("double") for s in shares]), "at").alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"), "deviation_digits",
    )
