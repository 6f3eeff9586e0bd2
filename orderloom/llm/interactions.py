"""Filter interaction audit: what each filter removes, in every order of the filters, from one pass over the texts.

A document is reduced to the mask of the filters it fails.  A mask stands for one wide integer whose fields, WIDTH bits
each, hold the outcomes of all steps of all orders (1 where the step keeps, removes, ... the document).  The integers of
a part, times how many documents have them, are added; no field can run over into the next one, since it is at most the
number of documents.  The sum is unpacked into the rows of the part.

Filters: A under 200 words; B 100 * distinct words < 50 * words; C 100 * [A-Z] > 2 * code points; D any of [#$%&*|];
E the text of a row with a smaller doc_id.  Null texts are empty ones; texts are read whole; a null part is the empty
string.  Rows that share doc_id and text are counted one by one, and none of them is a copy of another.  A row without
doc_id is neither a copy nor a model of one, and has no label.  Several labels of a doc_id count if any does.  An empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Workspace, arrow_map, whole_text

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
WIDTH = 64  # bits of a field: more documents than a long can count would be needed to fill it
CELLS = (len(ORDERS), len(FILTERS), len(OUTCOMES))
UPPER, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"


def failures(raw: bytes, chars: int) -> int:
    """The bits of A to D."""
    words = raw.split()  # bytes are split at the six ASCII white space characters
    capitals = len(raw) - len(raw.translate(None, UPPER))
    marks = len(raw) != len(raw.translate(None, MARKS))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 2 * chars) << 2 | marks << 3


def masks(documents: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, mask, digest) of every row; ``mask`` has the filters that look at one text only."""
    text = whole_text()
    df = documents.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.cast("binary").alias("raw"), F.length(text).alias("chars"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        mask, digest = [], []
        for raw, chars in zip(batch.column(2), batch.column(3).to_pylist()):  # one text at a time
            raw = raw.as_py()
            mask.append(failures(raw, chars))
            digest.append(hashlib.blake2b(raw, digest_size=16).digest())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())], ["doc_id", "part", "mask", "digest"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return arrow_map(df, run, f"doc_id {kind}, part string, mask int, digest binary")


def counted(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail exactly the filters of ``mask``."""
    space = Workspace(documents.sparkSession, "interactions")
    rows = space.keep(masks(documents, part), "masks")
    # Repeated rows become one with a count; rows without doc_id need neither join.
    known = rows.where("doc_id is not null").groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    nameless = rows.where("doc_id is null").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    # The first row of a text is found by (digest, doc_id), so that the copies of one text are spread over all tasks.
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(True).alias("first"))
    marked = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    copy = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    joined = known.join(first, ["digest", "doc_id"], "left").join(marked.where("doc_id is not null and (good or toxic)"), "doc_id", "left")
    joined = joined.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    both = joined.unionByName(nameless.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n"))
    return both.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@cache
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The outcomes of a document with this mask at all steps of all orders, a field each."""
    cells = np.zeros(CELLS, "<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            fails = bool(mask & bit)
            lost = fails and not gone
            cells[o, s] = (not gone and not fails, lost, fails and gone, mask == bit, lost and good, lost and toxic)
            gone |= fails
    return int.from_bytes(cells.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(WIDTH // 8 * int(np.prod(CELLS)), "little"), "<u8").reshape(CELLS)


def steps(counts: DataFrame) -> DataFrame:
    """A row for each part, order and step from ``counted`` rows, of which a part has at most 128."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(int(n) * packed(int(m), bool(g), bool(t)) for m, g, t, n in zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]))
        cells = unpacked(total).astype(np.int64)
        letter = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])
        share = np.zeros(len(FILTERS), np.int64)
        np.add.at(share, letter.ravel(), cells[:, :, OUTCOMES.index("removed")].ravel())
        out = {"part": key[0], "filter_order": np.repeat(ORDERS, len(FILTERS)), "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))}
        out |= {name: cells[:, :, i].ravel() for i, name in enumerate(OUTCOMES)}
        return pd.DataFrame(out | {"shapley": share[letter].ravel()})

    kind = "part string, filter_order string, step int, " + ", ".join(f"{x} long" for x in (*OUTCOMES, "shapley"))
    return counts.groupBy("part").applyInPandas(add, kind)


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    return steps(counted(documents, labels, part))


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
marked AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM worded LEFT JOIN marked USING (doc_id)),
counts AS (SELECT part, fails, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
places AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS f, substr(filter_order, 1, k - 1) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS k)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS own, translate(earlier, fails, '') <> earlier AS gone FROM counts, places),
summed AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN own AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN own AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""
