"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import gathered, settle


def _min_neighbour(edges: DataFrame, by: list[str]) -> DataFrame:
    return edges.groupBy(*by, "u").agg(F.min("v").alias("m"))


def _unfinished(edges: DataFrame, by: list[str]) -> tuple[int, bool]:
    """The number of edges, and whether some node still hangs below two others or below one that hangs itself."""
    end = lambda c: F.struct(F.col(c).alias("node"), F.lit(int(c == "u")).alias("below"), F.lit(c == "v").alias("above"))
    ends = edges.select(*by, F.inline(F.array(end("u"), end("v"))))
    nodes = ends.groupBy(*by, "node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    mark = nodes.agg(F.sum("below").alias("n"), F.max((F.col("below") > 1) | ((F.col("below") > 0) & F.col("above"))).alias("open")).first()
    return mark.n or 0, bool(mark.open)


def connected_components(edges: DataFrame, by: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """(by..., node, component) for every node of (by..., a, b); the component is its smallest node.

    Large-star and small-star steps of Kiveris et al. (2014): each round hangs
    nodes below their smallest neighbour, so even a long chain needs a
    logarithmic number of rounds.  Each round is cut off by a checkpoint.
    They end when every edge is that of a node and its smallest, without a
    further round to see that nothing changes.  ``rows``, if known, is a
    bound of the number of edges.
    """
    by = list(by or [])
    current = edges.select(*by, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = settle(current if rows is None else gathered(current, rows))
    loops = current.where("u = v").select(*by, F.col("u").alias("node"))
    current = current.where("u != v")
    while (state := _unfinished(current, by))[1]:
        both = current.unionByName(current.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _min_neighbour(both, by).withColumn("m", F.least("m", "u"))
        large = both.join(lowest, [*by, "u"]).where("v > u").select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v")  # no more rows than edges; what is there twice goes with the distinct below
        down = _min_neighbour(large, by)
        small = large.join(down, [*by, "u"]).select(
            *by, F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        ).select(*by, "e.u", "e.v").where("u != v").distinct()
        current = settle(gathered(small, 2 * state[0]))
    members = current.select(*by, F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(*by, F.col("v").alias("node"), F.col("v").alias("component"))
    alone = loops.select(*by, "node", F.col("node").alias("component"))
    return members.unionByName(roots).unionByName(alone).groupBy(*by, "node").agg(F.min("component").alias("component"))
