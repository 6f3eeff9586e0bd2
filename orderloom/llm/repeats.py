"""Removal of long passages that stand more than once in a corpus, after prefix-free parsing.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.  As in prefix-free parsing, a rolling
hash cuts the texts into phrases at places that their content alone decides, equal phrases become one dictionary entry,
and what happens inside phrases is worked out once per entry.  The trigger of a string of LENGTH bytes is the lowest
rolling hash in its middle part (the rightmost of equal ones), so equal strings have it in the same place, and all strings
with one trigger are a phrase: a stretch of beginnings, followed by LENGTH bytes.

Whether two strings are equal up to LENGTH bytes is all that the order of suffixes is needed for here.  So in place of a
sorted suffix array, which one machine would have to hold or many to exchange, suffixes are put into classes of equal
prefixes, coarse to fine, each class by an aggregate:

1. phrases whose core (the part in all their strings) stands once in the corpus hold nothing repeated;
2. phrases that are equal as a whole are repeated as a whole, and one of them stands for all in what follows;
3. the others are cut into blocks of 16 beginnings at fixed distances from the trigger: a block whose common part is
   unique holds nothing, one that is equal to another as a whole is repeated;
4. what is left is decided beginning by beginning.

Cores are 64-bit hashes and only select; what is called equal has equal hashes of 96 to 128 bits.  Matches never cross
documents.  Null and empty texts have no bytes; texts of any length are taken whole; rows that are equal repeat each
other; an empty table gives an empty table.  Columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Workspace, arrow_map, plus, whole_text, without

LENGTH = 400
GRAM = 8  # bytes of a rolling hash
MIDDLE = 128  # places among which a string has its trigger; a power of two
MARGIN = (LENGTH - MIDDLE - GRAM) // 2  # from a string's beginning to the first of them
CORE = LENGTH - MIDDLE + 1
BLOCK = 16
#: Keys that are broadcast to pick rows; more of them are joined by a shuffle.
BROADCAST_KEYS = 2_000_000

TABLE = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)

digest = xxhash.xxh3_64_intdigest
SIGN = 1 << 63


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def phrases(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each phrase its trigger, and its first and last beginning of a string of LENGTH bytes."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3
    h = TABLE[np.frombuffer(raw, np.uint8)]
    size, factor = 1, ODD
    while size < GRAM:  # hashes of twice as many bytes
        h = h[:-size] * factor + h[size:]
        size, factor = size * 2, factor * factor
    h = (h ^ (h >> np.uint64(31))) * ODD
    # The hash above, the place below: of equal hashes the rightmost is the lowest.
    low = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
    size = 1
    while size < MIDDLE:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    trigger = (np.uint64(0xFFFFFFFF) - (low[MARGIN : MARGIN + n] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
    return trigger[first], first, np.concatenate([first[1:], [n]]) - 1


def parse(df: DataFrame) -> DataFrame:
    """(uid, core, whole, at, low, high) of every phrase of (uid, text)."""

    def run(batch: pa.RecordBatch):
        uids, texts = batch.column(0), batch.column(1)
        for start in range(0, len(batch), 200):
            out: list[list] = [[], [], [], [], [], []]
            for uid, text in zip(uids.slice(start, 200).to_pylist(), texts.slice(start, 200).to_pylist()):
                raw = text.encode()
                at, low, high = phrases(raw)
                if not len(at):
                    continue
                # The core: what all strings that may have this trigger have in common.
                begin = (at - MARGIN).tolist()
                out[0].append(np.full(len(at), uid))
                out[1] += [digest(raw[b : b + CORE]) for b in begin]
                out[2] += [digest(raw[a : b + LENGTH], seed=b - a) for a, b in zip(low.tolist(), high.tolist())]
                for column, values in zip(out[3:], (at, low, high)):
                    column.append(values)
            if out[0]:
                ints = [pa.array(np.concatenate(c).astype(np.int32)) for c in out[3:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0])), _signed(out[1]), _signed(out[2]), *ints], ["uid", "core", "whole", "at", "low", "high"])

    return arrow_map(df.select("uid", "text"), run, "uid long, core long, whole long, at int, low int, high int")


def blocks(df: DataFrame) -> DataFrame:
    """(uid, edge, place, common, all, first, starts) of every block of the phrases in (uid, text, phrases).

    ``common`` and ``all`` are hashes of what all strings of the block share and of all they cover; ``starts`` has a hash
    for each beginning from ``first`` on.
    """

    def run(batch: pa.RecordBatch):
        for i in range(len(batch)):
            uid, raw = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
            rows: list[list] = [[], [], [], [], [], []]
            for p in batch.column(2)[i].as_py():
                for place in range((p["at"] - MARGIN - p["high"]) // BLOCK, (p["at"] - MARGIN - p["low"]) // BLOCK + 1):
                    top = p["at"] - MARGIN - place * BLOCK  # the last beginning of the block
                    low, high = max(p["low"], top - BLOCK + 1), min(p["high"], top)
                    tag = p["core"] & 0xFFFFFFFF
                    for column, value in zip(rows, (
                        p["edge"], place ^ tag << 8, digest(raw[top : top - BLOCK + 1 + LENGTH], seed=place), digest(raw[low : high + LENGTH], seed=(top - low) * BLOCK + top - high), low,
                        [digest(raw[s : s + LENGTH]) - SIGN for s in range(low, high + 1)],
                    )):
                        column.append(value)
            if rows[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid] * len(rows[0]), pa.int64()), pa.array(rows[0], pa.bool_()), pa.array(rows[1], pa.int64()), _signed(rows[2]), _signed(rows[3]), pa.array(rows[4], pa.int32()), pa.array(rows[5], pa.list_(pa.int64()))],
                    ["uid", "edge", "place", "common", "all", "first", "starts"],
                )

    return arrow_map(df.select("uid", "text", "phrases"), run, "uid long, edge boolean, place long, common long, all long, first int, starts array<long>")


def _picked(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys`` (of distinct rows), by a broadcast if these are few."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")


def _often(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*keys)


def ranges(texts: DataFrame, space: Workspace) -> DataFrame:
    """(uid, low, high): beginnings of repeated strings in (uid, text)."""
    parsed = space.keep(parse(texts), "parsed")
    cores = space.keep(_often(parsed, "core"), "cores")
    close = space.keep(_picked(parsed, cores, ["core"]), "close")  # phrases that may hold something repeated
    space.drop("parsed")
    # The dictionary: one entry for equal phrases.
    entries = close.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("uid", "at", "low", "high")).alias("p"))
    entries = space.keep(entries.select("core", "whole", "c", "p.*"), "entries")
    repeated = entries.where("c > 1").select("core", "whole")
    found = close.join(repeated, ["core", "whole"], "left_semi").select("uid", "low", "high")
    # Entries that stand once, and those that share a core with one.
    lone = entries.where("c = 1").select("core").distinct()
    open_entries = _picked(entries, space.keep(lone, "lone"), ["core"])
    wanted = space.keep(open_entries.groupBy("uid").agg(F.collect_list(F.struct("core", "at", "low", "high", (F.col("c") == 1).alias("edge"))).alias("phrases")), "wanted")  # as long as the document
    cut = space.keep(blocks(_picked(texts, wanted.select("uid"), ["uid"]).join(wanted, "uid")), "blocks")
    alike = _often(cut, "place", "common")
    whole = _often(cut, "place", "all")
    edges = cut.where("edge")
    last = F.col("first") + F.size("starts") - 1
    found = found.unionByName(edges.join(whole, ["place", "all"], "left_semi").select("uid", F.col("first").alias("low"), last.alias("high")))
    # A block is looked into if it shares its common part; whole repeats of it serve as partners only.
    settled = edges.join(whole, ["place", "all"], "left_semi").groupBy("place", "common", "all").agg(F.min(F.struct("uid", "first", "starts")).alias("p")).select("place", "common", F.lit(False).alias("edge"), "p.*")
    unsettled = edges.join(whole, ["place", "all"], "left_anti").select("place", "common", "edge", "uid", "first", "starts")
    partners = cut.where("not edge").select("place", "common", "edge", "uid", "first", "starts")
    need = unsettled.select("place", "common").distinct()
    inner = unsettled.unionByName(settled).unionByName(partners).join(alike, ["place", "common"], "left_semi").join(need, ["place", "common"], "left_semi")
    starts = space.keep(inner.select("uid", "edge", F.shiftright("place", 8).alias("tag"), "first", F.posexplode("starts").alias("i", "start")).select("uid", "edge", "tag", (F.col("first") + F.col("i")).alias("low"), "start"), "starts")
    twice = _often(starts, "tag", "start")
    single = starts.where("edge").join(twice, ["tag", "start"], "left_semi").select("uid", "low", F.col("low").alias("high"))
    return found.unionByName(single)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _cut(raw: bytes, beginnings: list[dict]) -> tuple[list[dict], bytes]:
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, [r["low"] for r in beginnings], 1)
    np.add.at(edge, [r["high"] + LENGTH for r in beginnings], -1)
    gone = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(gone)).tolist()
    kept, at = [], 0
    for a, b in zip(turns[::2], turns[1::2]):
        kept.append(raw[at:a])
        at = b
    return [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])], b"".join([*kept, raw[at:]])


def strip(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``spans``, the maximal removed runs (bytes, end exclusive), and ``kept``, the bytes that remain."""
    df = without(df, "spans", "kept", "uid", "beginnings")
    space = Workspace(df.sparkSession, "repeats")
    rows = df.withColumn("uid", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c == "doc_id"], whole_text(text)))
    marked = space.keep(ranges(rows.select("uid", whole_text(text).alias("text")), space), "ranges")
    lists = marked.distinct().groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("beginnings"))  # as long as the document
    ids = space.keep(marked.select("uid").distinct(), "ids")
    few = ids.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    ids = F.broadcast(ids) if few else ids

    def run(batch: pa.RecordBatch):
        names = batch.schema.names
        for start in range(0, len(batch), 500):
            part = batch.slice(start, 500)
            made = [_cut((t or "").encode(), b) for t, b in zip(part.column(names.index(text)).to_pylist(), part.column(names.index("beginnings")).to_pylist())]
            keep = [i for i, n in enumerate(names) if n not in ("uid", "beginnings")]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in keep], pa.array([s for s, _ in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([k for _, k in made], pa.binary())],
                [*[names[i] for i in keep], "spans", "kept"],
            )

    touched = rows.join(ids, "uid", "left_semi").join(lists, "uid").select(*[F.col(f"`{c}`") for c in df.columns], "beginnings")
    touched = arrow_map(touched, run, plus(df, spans=SPANS, kept=T.BinaryType()))
    clean = rows.join(ids, "uid", "left_anti").drop("uid").withColumn("spans", F.array().cast(SPANS)).withColumn("kept", whole_text(text).cast("binary"))
    return touched.unionByName(clean)


def report(df: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    done = strip(df.select("doc_id", F.col("text").cast("string").alias("text")))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return done.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
