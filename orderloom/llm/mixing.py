"""Mixing sources to target weights by Poisson replication.

Every source has a target repetition rate: its target share of the whole over its present share.  A document's number of
copies is a Poisson draw with that mean, made by inverting the distribution at a uniform number that a hash of seed and
document gives, so it needs no state and comes out the same wherever and however often it is computed.  Documents are
exploded by their number and sorted by a hash of seed, document and copy.  All SQL functions.

Shares are by characters.  A null source is a source of its own; sources without characters have rate 1; null texts have
no characters; rows with equal doc_id get the same number; an empty table gives an empty table; columns named ``copy``
or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Workspace, whole_text, without

#: Sources of which the table of rates is broadcast; beyond, documents are joined by source and a salt.
BROADCAST_SOURCES = 10_000
SALTS = 32


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash, with 52 bits."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def inverse(rate: Column) -> Column:
    """The distribution function at 0, 1, 2 ..., as far as it matters in double precision."""
    steps = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int"))
    start = F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(s: Column, k: Column) -> Column:
        log_p = s["log_p"] + F.ln(rate) - F.ln(k.cast("double"))
        return F.struct(log_p.alias("log_p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + F.exp(log_p))).alias("cdf"))

    return F.aggregate(steps, start, step, lambda s: s["cdf"])


def rates(df: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, rate) that bring the sources to ``weights``, or else to shares in proportion to size ** ``power``.

    The expected size of the mixture is ``epochs`` times the input's.  Sources that ``weights`` leaves out have rate 0.
    """
    sizes = df.groupBy("source").agg(F.sum(F.length(whole_text()).cast("long")).alias("chars"))
    if weights is None:
        target = F.pow(F.col("chars").cast("double"), F.lit(power))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(target)
    aimed = sizes.withColumn("aim", F.when(F.col("chars") > 0, target).otherwise(F.lit(0.0)))
    whole = aimed.agg(F.sum("aim").alias("aims"), F.sum("chars").alias("total"))
    rate = F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(F.col("aim"), F.col("aims")), F.lit(0.0)) * F.col("total") / F.col("chars") * F.lit(epochs))
    return aimed.join(F.broadcast(whole)).select("source", rate.alias("rate"))  # one row of totals


def mix(df: DataFrame, weights: dict[str, float] | None = None, seed: int = 7, power: float = 0.5, epochs: float = 1.0, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` as often as drawn, with ``copy`` (from 0) and ``shuffle_key``, in the order of the latter."""
    df = without(df, "copy", "shuffle_key", "_cdf", "_salt", "_from")
    table = rates(df, weights, power, epochs).select(F.col("source").alias("_from"), F.when(F.col("rate") > 0, inverse(F.col("rate"))).otherwise(F.array(F.lit(1.0))).alias("_cdf"))
    table = Workspace(df.sparkSession, "mixing").keep(table, "rates")
    same = F.col("source").eqNullSafe(F.col("_from"))
    if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        drawn = df.join(F.broadcast(table), same)
    else:
        salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = df.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("_s") == F.col("_salt"))).drop("_s", "_salt")
    u = uniform(F.lit(seed), F.col(key))
    times = F.size(F.filter("_cdf", lambda c: c <= u))
    copies = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    drawn = drawn.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(copies).alias("copy"))
    return drawn.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("at"), F.col("copy").cast("string")))).orderBy("shuffle_key")


SQL = """
WITH sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM documents GROUP BY source),
aims AS (SELECT source, chars, CASE WHEN chars > 0 THEN power(CAST(chars AS DOUBLE), 0.5) ELSE 0.0 END AS aim FROM sizes),
rate AS (SELECT source, CASE WHEN chars = 0 THEN 1.0 ELSE aim / sum(aim) OVER () * sum(chars) OVER () / chars END AS rate FROM aims),
steps AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM rate),
pmf AS (SELECT source, k, exp(-rate + sum(CASE WHEN k > 0 THEN ln(rate) - ln(k) ELSE 0 END) OVER (PARTITION BY source ORDER BY k)) AS p FROM steps),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
u AS (SELECT *, (CAST(('0x' || substr(md5('7:' || doc_id), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, count(cdf.k) AS times FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= u.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INT) AS copy, md5('7:' || doc_id || ':at:' || copy) AS shuffle_key FROM (SELECT *, unnest(range(0, times)) AS copy FROM n)
"""
