"""Document fingerprints by a threshold-scaled sketch.

A fingerprint holds every shingle hash below a fixed fraction of the hash range, so its size follows the document's,
fingerprints of parts merge by union, and containment can be estimated between very unequal documents.  A text with
shingles of which none falls below the fraction keeps its lowest hash, so that only texts without words have none.

Shingles are five words (runs of anything but ASCII white space, lower case); fewer words make one shingle.  Null and
empty texts have an empty fingerprint, which is like another empty one (1) and unlike any other (0).  All SQL functions.
Columns named like a result are replaced; equal rows give equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text, without

WORDS = 5
SCALE = 4  # one hash of so many is retained
POSITIVE = (1 << 63) - 1


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), "")


def shingle_hashes(tokens: Column) -> Column:
    """Non-negative hashes of all shingles of an array of words."""
    n = F.size(tokens)
    hashed = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(WORDS)]).bitwiseAND(F.lit(POSITIVE)))
    return F.when(n >= WORDS, hashed).when(n > 0, F.array(F.xxhash64(F.array_join(tokens, " ")).bitwiseAND(F.lit(POSITIVE)))).otherwise(F.array().cast("array<bigint>"))


def retain(hashes: Column, scale: int = SCALE) -> Column:
    """Of an array of hashes, in ascending order and once each, those below the fraction, or else the lowest."""
    low = F.filter(hashes, lambda h: h < F.lit(POSITIVE // scale))
    return F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)


def sketch(df: DataFrame, text: Column, name: str, scale: int = SCALE) -> DataFrame:
    """``df`` with the sketch of ``text``, array<bigint>, as ``name``."""
    df = without(df, name, "_w", "_h")
    keep = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*keep, words(text).alias("_w"))
    df = df.select(*keep, shingle_hashes(F.col("_w")).alias("_h"))
    return df.select(*keep, retain(F.col("_h"), scale).alias(name))


def merge(*sketches: Column, scale: int = SCALE) -> Column:
    """The sketch of the union of the shingle sets; a lowest hash that stood in for an empty sketch stays only if the union is empty too."""
    return retain(reduce(F.array_union, sketches), scale)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of two documents; 1 for two empty sketches."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.hex(h)), ".")


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``: first among every so many, then among those between."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    every = F.array(*[F.lit(int(b)) for b in bounds])
    coarse = F.array(*[F.lit(int(b)) for b in bounds[step - 1 :: step]])
    whole = F.size(F.filter(coarse, lambda b: b <= key)) * step
    return whole + F.size(F.filter(F.slice(every, whole + 1, F.lit(step)), lambda b: b <= key))


def with_next(df: DataFrame, key: str, carry, parts: int | None = None) -> DataFrame:
    """``df`` with, as ``next_<name>``, the columns that ``carry(df)`` names of the row that follows in descending ``key``; the first row follows the last.

    Rows are dealt to ranges of the key by quantiles, with a copy of the row that follows each range, so texts are
    shuffled once and no task holds more than a range.  Null keys come last; equal keys are ordered by their text.
    ``carry`` gets the dealt rows and returns (rows, names); it may add columns there.
    """
    spark = df.sparkSession
    parts = parts or 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cuts = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 20 * parts).alias("q")).first().q if parts > 1 else []
    # -1: rows without a key.
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(_bucket(F.col(key), sorted(set(cuts or []))))
    top = df.select(bucket.alias("b"), key).groupBy("b").agg(F.max(key).alias("top")).orderBy("b").collect()  # a row for each range
    if not top:
        followed = F.array().cast("array<int>")
    else:
        # The first row of a range follows the last row of the range above; that of the highest follows the very last row.
        above = {r.b: top[(i + 1) % len(top)].b for i, r in enumerate(top)}
        pick = F.create_map(*[F.lit(x) for r in top for x in (r.b, r.top)]) if any(r.top is not None for r in top) else F.create_map(F.lit(-2), F.lit(0))
        onto = F.create_map(*[F.lit(x) for pair in above.items() for x in pair])
        followed = F.when(F.col(key).eqNullSafe(F.try_element_at(pick, F.col("_b"))), F.array(F.try_element_at(onto, F.col("_b")))).otherwise(F.array().cast("array<int>"))
    places = F.concat(F.array(F.struct(F.col("_b").alias("b"), F.lit(0).alias("copy"))), F.transform(followed, lambda b: F.struct(b.alias("b"), F.lit(1).alias("copy"))))
    dealt = df.withColumn("_b", bucket).withColumn("_p", F.explode(places)).withColumn("_b", F.col("_p.b")).withColumn("_copy", F.col("_p.copy")).drop("_p")
    rows, names = carry(dealt.repartition(parts, "_b"))
    order = Window.partitionBy("_b").orderBy("_copy", F.col(key).desc_nulls_last(), *[F.col(n) for n in names[:1]])
    return rows.select("*", *[F.lead(n).over(order).alias(f"next_{n}") for n in names]).where("_copy = 0").drop("_b", "_copy")


def compare(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness; also the likeness to the next document.

    The edited text has the last half of the code points replaced by as many (or all) of the next document's first.
    """

    def carry(rows):
        return sketch(rows, F.col("text"), "own", scale), ["text", "own"]

    df = with_next(df.select("doc_id", whole_text().alias("text")), "doc_id", carry)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    df = df.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"), "own", "next_own")
    df = sketch(df, F.col("edited"), "changed", scale)
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        containment(F.col("own"), F.col("changed")).alias("contained_in_edited"), containment(F.col("own"), F.col("next_own")).alias("contained_in_next"),
    )
