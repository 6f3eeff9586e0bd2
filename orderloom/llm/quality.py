"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

A document is described by a few statistics of its whole text.  Standardised, they go through random Fourier features,
whose inner products approximate a Gaussian kernel.  Partitions of the labelled rows sum their part of the normal
equations per fold; the sums give one ridge fit for all rows and, less one fold each, fits that have not seen a row.
Their scores of the rows left out, counted by score bin, are pooled into a monotone calibration.

At most ``MAX_LABELLED`` labelled rows, those with the lowest hash of their doc_id, are used to fit; all rows are scored.
doc_id, lang, source and labels are no inputs of a score.  Null and empty texts have the statistics of no words; texts are
read whole; equal texts have equal scores; without labelled rows (or of both kinds) every score is the share of good rows,
or 0.5; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Workspace, arrow_map

MAX_LABELLED = 400_000
FEATURES = 384  # random Fourier features
FOLDS = 5
RIDGE = 1e-3  # per row
BINS = 2000
STEP = 1024  # rows whose features a worker holds at once
PARTS = 16  # partitions in which the labelled rows are summed
LIMIT = 0.3

STATISTICS = (
    "log_words", "log_bytes", "word_bytes", "capitals", "digits", "symbols", "bars", "exclamations", "stops", "beyond_ascii", "lines", "distinct_words",
    "distinct_pairs", "top_word", "byte_entropy", "distinct_lines", "line_words", "quotes", "distinct_bytes",
)
SYMBOLS = np.frombuffer(b"#*$%&<>@^~=_\\{}[]", np.uint8)


def describe(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x and not x.isspace()]
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n, size = max(1, len(words)), max(1, len(raw))
    small, large = h[97:123].sum(), h[65:91].sum()
    p = h[h > 0] / size
    return [
        math.log1p(len(words)), math.log1p(len(raw)), min(30.0, len(raw) / n), large / max(1.0, small + large), h[48:58].sum() / size, min(3.0, h[SYMBOLS].sum() / n), min(3.0, h[124] / n),
        min(3.0, h[33] / n), min(3.0, (h[46] + h[44]) / n), h[128:].sum() / size, min(3.0, h[10] / n), len(set(words)) / n,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1), (Counter(words).most_common(1)[0][1] if words else 0) / n, float(-(p * np.log2(p)).sum()),
        len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))), min(3.0, (h[34] + h[39]) / n), float((h > 0).sum()) / 64,
    ]


def statistics(df: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every text."""

    def run(batch: pa.RecordBatch):
        for start in range(0, len(batch), 2000):
            part = batch.slice(start, 2000)
            x = [describe(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return arrow_map(df.select("doc_id", F.col("text").cast("string").alias("text")), run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, x array<double>")


class Fourier:
    """Standardisation, and cosines of random projections of it."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, size: int = FEATURES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        width = math.sqrt(len(mean)) * 0.7
        self.w, self.b = rng.normal(size=(len(mean), size)) / width, rng.uniform(0, 2 * math.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([math.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def pooled(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to good / total, by weight (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for n, g in zip(total, good):
        blocks.append([n, g, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, g2, c2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + g2, blocks[-1][2] + c2]
    return np.repeat([g / n for n, g, _ in blocks], [c for _, _, c in blocks])


class Model:
    def __init__(self, fourier: Fourier | None, weights: np.ndarray | None, knots: np.ndarray, values: np.ndarray):
        self.fourier, self.weights, self.knots, self.values = fourier, weights, knots, values

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.values[0])
        raw = np.concatenate([self.fourier(x[at : at + STEP]) @ self.weights for at in range(0, max(1, len(x)), STEP)])
        raw = np.clip(raw, -0.5, 1.5)
        # A little of the raw score keeps documents of one calibrated step in order.
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * (raw + 0.5) / 2, 0, 1)


def _listed(a: np.ndarray) -> list[float]:
    return a.ravel().tolist()


def fit(rows: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """From (doc_id, x, y), y 0 or 1."""
    rows = rows.where("y is not null and x is not null")
    n = rows.count()
    if n > limit:  # the lowest hashes; a bound on what is fitted to, not on what is scored
        rows = rows.where(F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(1_000_000)) < int(1e6 * limit / n))
    rows = rows.select("doc_id", "x", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    d = len(STATISTICS)
    sums = rows.agg(F.avg("y").alias("y"), *[f(F.get("x", i)).alias(f"{f.__name__}{i}") for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    if sums.y is None or sums.y in (0.0, 1.0):
        share = 0.5 if sums.y is None else sums.y
        return Model(None, None, np.zeros(1), np.array([share]))
    fourier = Fourier(np.array([sums[f"avg{i}"] for i in range(d)]), np.array([sums[f"stddev_pop{i}"] for i in range(d)]))
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def part_sums(batches):
        gram, moment, count = np.zeros((FOLDS, size, size)), np.zeros((FOLDS, size)), np.zeros(FOLDS, np.int64)
        for batch in batches:
            x, y, fold = np.array(batch.column(0).to_pylist(), float).reshape(-1, d), np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for at in range(0, len(y), STEP):
                z = fourier(x[at : at + STEP])
                for f in range(FOLDS):
                    own = fold[at : at + STEP] == f
                    mine = z[own]
                    gram[f] += mine.T @ mine
                    moment[f] += mine.T @ y[at : at + STEP][own]
                    count[f] += own.sum()
        for f in range(FOLDS):
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([int(count[f])], pa.int64()), pa.array([gram[f][upper].tobytes()], pa.binary()), pa.array([moment[f].tobytes()], pa.binary())], ["fold", "n", "gram", "moment"])

    def add(key, part: pd.DataFrame) -> pd.DataFrame:  # as many rows as partitions: PARTS
        total = lambda c: np.sum([np.frombuffer(b) for b in part[c]], axis=0).tobytes()
        return pd.DataFrame({"fold": [key[0]], "n": [part["n"].sum()], "gram": [total("gram")], "moment": [total("moment")]})

    kind = "fold int, n long, gram binary, moment binary"
    # Few partitions and no shuffle of rows: each gives FOLDS matrices, of which the upper half is moved.
    dealt = rows.select("x", "y", "fold").coalesce(PARTS)
    folds = dealt.mapInArrow(part_sums, kind).groupBy("fold").applyInPandas(add, kind).orderBy("fold").collect()
    gram = {}
    for r in folds:
        half = np.zeros((size, size))
        half[upper] = np.frombuffer(r.gram)
        gram[r.fold] = half + np.triu(half, 1).T
    moment, count = {r.fold: np.frombuffer(r.moment) for r in folds}, {r.fold: r.n for r in folds}

    def solve(used: list[int]) -> np.ndarray:
        n = max(1, sum(count[f] for f in used))
        a = sum(gram[f] for f in used) + RIDGE * n / size * np.eye(size)
        return np.linalg.solve(a, sum(moment[f] for f in used))

    held = {f: solve([g for g in gram if g != f] or [f]) for f in gram}

    def binned(batch: pa.RecordBatch):
        x, fold = np.array(batch.column(0).to_pylist(), float).reshape(-1, d), np.asarray(batch.column(2))
        raw = np.zeros(len(x))
        for f in held:
            own = np.flatnonzero(fold == f)
            for at in range(0, len(own), STEP):
                part = own[at : at + STEP]
                raw[part] = fourier(x[part]) @ held[f]
        bins = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), batch.column(1)], ["bin", "y"])

    steps = arrow_map(rows.select("x", "y", "fold"), binned, "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).orderBy("bin").collect()  # at most BINS rows
    at = np.array([(r.bin + 0.5) / BINS * 2 - 0.5 for r in steps])
    # One good and one bad row, spread over all, keep scores off 0 and 1.
    total, good = np.array([float(r.n) for r in steps]), np.array([r.good for r in steps])
    share = good.sum() / total.sum()
    return Model(fourier, solve(list(gram)), at, pooled(total + 1e-2, good + 1e-2 * share))


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def known(labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, y) of the labels that may be learnt from, one row per document."""
    return labels.select("doc_id", F.col(target).alias("y")).where("y in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))


def keep_good(df: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """The rows of ``df`` whose score reaches LIMIT, as they are.  Each row is judged by its own text."""
    space = Workspace(df.sparkSession, "quality")
    taught = space.keep(known(labels, target), "labels")
    few = taught.limit(MAX_LABELLED + 1).count() <= MAX_LABELLED
    described = statistics(df.join(F.broadcast(taught.select("doc_id")) if few else taught, "doc_id", "left_semi"))
    model = fit(space.keep(described.join(taught, "doc_id").select("doc_id", "x", "y"), "statistics"))

    def run(batch: pa.RecordBatch):
        at = batch.schema.names.index("text")
        for start in range(0, len(batch), STEP):
            part = batch.slice(start, STEP)
            x = np.array([describe(t) for t in part.column(at).to_pylist()], float).reshape(-1, len(STATISTICS))
            yield part.filter(pa.array(model.score(x) >= LIMIT))

    return arrow_map(df, run, df.schema)


def score(df: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; rows without doc_id are scored and count as held out."""
    space = Workspace(df.sparkSession, "quality")
    described = space.keep(statistics(df), "statistics")
    model = fit(described.join(known(labels, target), "doc_id").select("doc_id", "x", "y"))

    def run(batch: pa.RecordBatch):
        x = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    scored = arrow_map(described, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(True)).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
