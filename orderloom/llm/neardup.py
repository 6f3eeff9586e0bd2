"""Near-duplicate documents by bottom-k sketches of one hash function.

Every distinct shingle is hashed once; the k lowest hashes of a document are its sketch.  Inverted lists are keyed by
runs of three neighbouring retained values (two for sets of four or five), because documents alike at 0.8 keep such a
run in common: among the m lowest hashes of their union at most a fifth are not shared, so with m up to k a run is
certain, and beyond it is missed with a chance of 0.697 ** k (3e-8 for k = 48).  Single common values, which unrelated
documents share by the thousand, make no pairs.  Then

1. equal sets become one node;
2. each list links its members to its lowest node only; a union-sketch estimate drops hopeless pairs, the exact Jaccard
   index of the full sets confirms the others, and connected components are formed;
3. lists whose members are still in different components are looked at again: short ones give their pairs of different
   components; members of long ones are joined by an exact prefix filter (the rarest fifth of their shingles), which a
   passage that many documents share does not enter.  No list gives all its pairs, none is cut.

Words are runs of anything but ASCII white space with A-Z in lower case; null and empty texts have an empty set and are
linked with nothing; with fewer words than a shingle the whole sequence is one.  A node is a set, not a doc_id: rows that
share a doc_id but not their set are linked for themselves, and equal rows go the same way.  Rows without doc_id are linked
with nothing, have a null component and are kept.  An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.ranks import running_total
from orderloom.llm.common import Workspace, arrow_map, plus
from orderloom.operators.components import connected_components
from orderloom.session import gathered

K = 48
#: Lists up to this length give their pairs of different components.
SHORT_LIST = 12
#: Ids that are broadcast to pick the texts to be read again; beyond, they are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Estimates below this are five standard deviations (0.058 for k = 48) under 0.8.
HOPELESS = 0.5

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Ascending 63-bit hashes of the distinct shingles."""
    tokens = (text or "").encode().translate(LOWER).split()
    if not tokens:
        return np.empty(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    n = len(hashed) - size + 1
    mixed = np.full(n, size, np.uint64)
    for j in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * ODD[j % len(ODD)] + hashed[j : j + n] * ODD[(j + 3) % len(ODD)]
    mixed ^= mixed >> np.uint64(32)
    mixed *= ODD[1]
    mixed ^= mixed >> np.uint64(29)
    return np.unique((mixed >> np.uint64(1)).astype(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64()))


def sketches(df: DataFrame, words: int, k: int = K) -> DataFrame:
    """(doc_id, n, set_key, sketch): size and digest of the shingle set, and its k lowest hashes."""

    def run(batch: pa.RecordBatch):
        ids = batch.column(0)
        for start in range(0, len(batch), 1000):
            made = [shingle_set(t, words) for t in batch.column(1).slice(start, 1000).to_pylist()]
            keys = _digest(made)
            yield pa.RecordBatch.from_arrays([ids.slice(start, 1000), pa.array([len(s) for s in made], pa.int64()), pa.array(keys, pa.binary()), _lists([s[:k] for s in made])], ["doc_id", "n", "set_key", "sketch"])

    return arrow_map(df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, n long, set_key binary, sketch array<long>")


def _digest(made: list[np.ndarray]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(s.tobytes()) for s in made]


@dataclass
class Corpus:
    """Documents, the number of each distinct set, and the doc_ids that hold several sets."""

    df: DataFrame
    words: int
    numbers: DataFrame  # set_key, doc (its lowest doc_id), node (rising with doc)
    mixed: DataFrame | None  # doc_id; None if every doc_id holds one set

    def sets(self, nodes: DataFrame, most: int | None = None) -> DataFrame:
        """(node, n, shingles) of the sets ``nodes``, made again from the texts; ``most`` is a known bound of their number."""
        texts = self.df.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
        words = self.words

        def run(batch: pa.RecordBatch):
            at = batch.column(0)
            for start in range(0, len(batch), 500):
                made = [shingle_set(t, words) for t in batch.column(1).slice(start, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([at.slice(start, 500), pa.array(_digest(made), pa.binary()), pa.array([len(s) for s in made], pa.int64()), _lists(made)], ["node", "set_key", "n", "shingles"])

        few = most is not None and most <= BROADCAST_IDS or nodes.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        mark = F.broadcast if few else (lambda x: x)
        schema = "node long, set_key binary, n long, shingles array<long>"
        if self.mixed is None:
            picked = texts.withColumnRenamed("doc", "node").join(mark(nodes), "node", "left_semi")
            return arrow_map(picked.select("node", "text"), run, schema).drop("set_key")
        # Which of its sets a row of such a doc_id holds is known by the digest alone.
        named = nodes.join(self.numbers, "node").select("node", "set_key", "doc")
        picked = texts.join(named.select("doc").distinct(), "doc", "left_semi")
        made = arrow_map(picked.select("doc", "text"), run, schema).drop("node")
        return made.join(mark(named.select("node", "set_key")), "set_key").select("node", "n", "shingles").dropDuplicates(["node"])


def _numbered(rows: DataFrame, space: Workspace) -> tuple[DataFrame, DataFrame | None]:
    """The sets with their numbers, and the doc_ids that hold several sets.

    Where every doc_id holds one set, a set's number is its lowest doc_id.  Else it is its place by doc_id and digest.
    """
    sets = rows.where("doc_id is not null and n > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc"))
    sign = F.xxhash64("set_key")
    mixed = space.keep(rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(sign).alias("x"), F.max(sign).alias("y")).where("x != y").select("doc_id"), "mixed")
    if mixed.isEmpty():
        return sets.withColumn("node", F.col("doc")), None
    places = running_total(sets.withColumn("_one", F.lit(1).cast("long")), [F.col("doc"), F.col("set_key")], {"node": "_one"})
    return space.keep(places.select("set_key", "doc", "node"), "numbers"), mixed


def _runs(sketch: Column, n: Column) -> Column:
    def of(size: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(sketch) - size), lambda i: F.xxhash64(F.lit(size), *[F.get(sketch, i + j) for j in range(size)]))

    none = F.array().cast("array<bigint>")
    return F.concat(F.when(n >= 5, of(3)).otherwise(none), F.when(n.isin(4, 5), of(2)).otherwise(none))


def _promising(pairs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b) whose likeness, estimated from the k lowest hashes of the union, is not hopeless."""
    one = lambda x: nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    both = pairs.join(one("a"), "a").where("na > 0").join(one("b"), "b").where("100 * least(na, nb) >= 80 * greatest(na, nb)")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    estimate = F.size(F.array_intersect(F.array_intersect(union, F.col("sa")), F.col("sb"))) / F.size(union)
    return both.where(estimate >= HOPELESS).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose exact Jaccard index reaches ``percent``."""
    one = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").withColumn("both", F.size(F.array_intersect("sa", "sb")).cast("long"))
    return both.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _check(pairs: DataFrame, nodes: DataFrame, corpus: Corpus, k: int, percent: int, space: Workspace, name: str) -> DataFrame:
    likely = space.keep(_promising(pairs, nodes, k), f"{name}_likely")
    rows = likely.count()
    ids = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return space.keep(gathered(_confirmed(likely, corpus.sets(ids, 2 * rows), percent).distinct(), rows), f"{name}_links")


def _components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    rows = links.count()
    return space.keep(gathered(connected_components(links, rows=rows), 2 * rows), name)


def _joined(labels: DataFrame, more: DataFrame, space: Workspace) -> DataFrame:
    """(node, component) of the graph that has the components ``labels`` once the links ``more`` are added.

    Only the links between components are followed: each stands for its lowest node, as does a node without a label.
    """
    if more.isEmpty():
        return labels
    end = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    between = more.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = _components(space.keep(gathered(between.distinct(), more.count()), "between"), space, "merged")
    moved = labels.join(merged.select(F.col("node").alias("component"), F.col("component").alias("low")), "component", "left")
    moved = moved.select("node", F.coalesce("low", "component").alias("component"))
    return moved.unionByName(merged.join(labels, "node", "left_anti"))


def _rare_prefix_pairs(nodes: DataFrame, corpus: Corpus, labels: DataFrame, percent: int, space: Workspace) -> DataFrame:
    """Pairs (a, b) of ``nodes`` from different components that share one of their rarest shingles.

    With shingles ordered by how many of the nodes have them, sets alike at ``percent`` meet in the first
    n - ceil(percent * n / 100) + 1 of both, and what follows the first one they share must be long enough on both
    sides for the whole overlap.  Shingles of one node only take their place in the order but no rows.
    """
    sets = corpus.sets(nodes).dropDuplicates(["node"])
    tokens = sets.select("node", "n", F.explode("shingles").alias("s"))
    counts = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = tokens.join(counts, "s").groupBy("node").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "s"))).alias("all"))  # as long as the document
    before = F.col("n") - F.size("all")
    room = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - before).cast("int")
    prefix = shared.where(room > 0).select("node", "n", before.alias("before"), F.posexplode(F.slice("all", F.lit(1), room)).alias("i", "x"))
    prefix = prefix.select("node", F.col("x.s").alias("s"), "n", (F.col("n") - F.col("before") - F.col("i")).alias("rest"))
    prefix = space.keep(prefix.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "prefix")
    mixed = prefix.groupBy("s").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("s")
    rows = space.keep(prefix.join(mixed, "s", "left_semi"), "rare")
    space.drop("prefix")
    x, y = (rows.select("s", F.col("node").alias(i), F.col("component").alias(f"c{i}"), F.col("n").alias(f"n{i}"), F.col("rest").alias(f"rest{i}")) for i in ("a", "b"))
    enough = (100 + percent) * F.least("resta", "restb") >= percent * (F.col("na") + F.col("nb"))
    return x.join(y, "s").where((F.col("ca") < F.col("cb")) & enough).select("a", "b").distinct()


def _grouped(df: DataFrame, words: int, percent: int, k: int, space: Workspace) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, n, set_key, component_id, first) of every row, ``first`` for the set that stands for its component; and the doc_ids of several sets."""
    rows = space.keep(sketches(df, words, k), "sketches")
    numbers, mixed = _numbered(rows, space)
    corpus = Corpus(df, words, numbers, mixed)
    sets = rows.where("doc_id is not null and n > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = space.keep(sets.withColumn("node", F.col("doc")) if mixed is None else sets.join(numbers.select("set_key", "node"), "set_key"), "nodes")
    runs = nodes.where("n >= 4").select("node", F.explode(F.array_distinct(_runs(F.col("sketch"), F.col("n")))).alias("run"))
    heads = runs.groupBy("run").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    listed = space.keep(runs.join(heads, "run"), "lists")

    stars = listed.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = _check(stars, nodes, corpus, k, percent, space, "star")
    labels = _components(links, space, "star_components")

    placed = listed.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_lists = placed.groupBy("run").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("run")
    left = space.keep(placed.join(open_lists, "run", "left_semi").select("run", "node", "component", "size"), "open")
    short = left.where(f"size <= {SHORT_LIST}").groupBy("run").agg(F.sort_array(F.collect_list(F.struct("node", "component"))).alias("m"))
    pairs = short.select(F.explode(F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (y["node"] > x["node"]) & (y["component"] != x["component"])), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))).alias("p")).select("p.*")
    long_nodes = space.keep(left.where(f"size > {SHORT_LIST}").select("node").distinct(), "long_nodes")
    pairs = pairs.unionByName(_rare_prefix_pairs(long_nodes, corpus, labels, percent, space).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    more = _check(pairs.distinct(), nodes, corpus, k, percent, space, "cross")
    space.drop("rare")
    labels = _joined(labels, more, space)

    if mixed is None:
        labels = labels.withColumn("component_id", F.col("component"))
    else:  # a set's place rises with its doc_id, so the first set of a component has the lowest
        labels = labels.join(numbers.select(F.col("node").alias("component"), F.col("doc").alias("component_id")), "component")
    named = nodes.select("set_key", "node", "doc").join(labels, "node", "left").select(
        "set_key", F.coalesce("component_id", "doc").alias("component_id"), (F.coalesce("component", "node") == F.col("node")).alias("first")
    )
    # Empty sets are all equal and are linked with nothing, so they stay out of the join.
    known = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    small = rows.select("doc_id", "n", "set_key")
    alone = small.where(~known).select("*", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return small.where(known).join(named, "set_key").select("doc_id", "n", "set_key", "component_id", "first").unionByName(alone), mixed


def groups(df: DataFrame, words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the lowest doc_id that links of at least ``percent`` reach."""
    found, _ = _grouped(df, words, percent, k, Workspace(df.sparkSession, "neardup"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` without those of which a near duplicate stays: that with the lowest doc_id.

    Near duplicates under one doc_id leave one set of them; equal rows of one doc_id all stay.  A row is judged by its own
    text: one that shares the doc_id of a dropped row, but not its text, is not dropped with it.
    """
    space = Workspace(df.sparkSession, "neardup")
    found, mixed = _grouped(df, words, percent, K, space)
    stays = F.col("doc_id").isNull() | (F.col("first") & (F.col("doc_id") == F.col("component_id")))
    gone = space.keep(found.where(~stays).select(F.col("doc_id").alias("_gone"), F.col("set_key").alias("_set")).distinct(), "gone")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    mark = F.broadcast if few else (lambda x: x)
    own = F.col("doc_id").cast("long")
    if mixed is None:
        return df.join(mark(gone.select("_gone")), own == F.col("_gone"), "left_anti")
    several = gone.join(mixed, F.col("_gone") == mixed["doc_id"], "left_semi")
    single = gone.join(mixed, F.col("_gone") == mixed["doc_id"], "left_anti")
    ids = mixed.select(F.col("doc_id").alias("_mixed"))
    rest = df.join(ids, own == F.col("_mixed"), "left_anti").join(mark(single.select("_gone")), own == F.col("_gone"), "left_anti")
    at = df.columns.index("text")

    def run(batch: pa.RecordBatch):
        for start in range(0, len(batch), 500):
            part = batch.slice(start, 500)
            keys = _digest([shingle_set(t, words) for t in part.column(at).cast(pa.string()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], [*part.schema.names, "_key"])

    keyed = arrow_map(df.join(ids, own == F.col("_mixed"), "left_semi"), run, plus(df, _key=T.BinaryType()))
    return rest.unionByName(keyed.join(mark(several), (own == F.col("_gone")) & (F.col("_key") == F.col("_set")), "left_anti").drop("_key"))
