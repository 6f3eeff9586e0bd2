"""Fuzzy search for short licence notices.

A notice may differ from its phrase by a few edits.  With k edits allowed a phrase is cut into k + 1 pieces, of which
at least one must stand unchanged, so exact finds of the pieces locate every candidate.  There the regex library's
bounded-error matching verifies the edits, from word beginning to word end, and the matches are reported as spans.

Texts are read as words: A-Z in lower case, everything but digits, letters and characters beyond ASCII is a gap.
Null and empty texts have no words and no matches; whole texts are searched, whatever their length; equal rows give
equal results; an empty table gives an empty table; input columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import arrow_map, plus, slices, without


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    base: bool = False
    sure: str = ""  # words that carry the meaning and must stand as they are

    @property
    def edits(self) -> int:
        return 1 if len(self.phrase) < 16 else 2 if len(self.phrase) < 26 else 3


BASE = (Notice("mit license", "mit", True, "mit"), Notice("apache license", "apache", True), Notice("general public license", "gpl", True))
NOTICES = BASE + (
    Notice("lesser general public license", "lgpl"),
    Notice("affero general public license", "agpl"),
    Notice("mozilla public license", "mpl"),
    Notice("eclipse public license", "epl"),
    Notice("bsd license", "bsd", sure="bsd"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("permission is hereby granted free of charge", "mit"),
    Notice("licensed under cc by", "cc", sure="cc by"),
    Notice("creative commons attribution", "cc"),
    Notice("released into the public domain", "public-domain"),
)

#: A-Z to lower case; digits, letters and bytes of characters beyond ASCII stay; all else is a gap.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

MATCH = T.StructType([T.StructField(n, k) for n, k in (("label", T.StringType()), ("base", T.BooleanType()), ("first_word", T.LongType()), ("n_words", T.LongType()), ("start", T.LongType()), ("end", T.LongType()), ("edits", T.IntegerType()), ("score", T.DoubleType()))])


@lru_cache(4)
def _search(notices: tuple[Notice, ...]):
    """For each notice its bytes, the pieces with their places, and the pattern that verifies."""
    out = []
    for notice in notices:
        phrase, k = notice.phrase.encode(), notice.edits
        cuts = [round(i * len(phrase) / (k + 1)) for i in range(k + 2)]
        pieces = [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]
        out.append((notice, phrase, pieces, regex.compile(rb"(?b)(?:" + regex.escape(phrase) + rb"){e<=" + str(k).encode() + rb"}(?= )")))
    return out


def _starts(stream: bytes, size: int, pieces: list[tuple[int, bytes]], slack: int) -> list[int]:
    """Beginnings of words at which the phrase may begin, by exact finds of its pieces."""
    found = set()
    for place, piece in pieces:
        at = stream.find(piece)
        while at >= 0:
            low, high = max(0, at - place - slack - 1), at - place + slack
            gap = stream.find(b" ", low, high)
            while gap >= 0:
                found.add(gap + 1)
                gap = stream.find(b" ", gap + 1, high)
            at = stream.find(piece, at + 1)
    return sorted(found)


def find(text: str, notices: tuple[Notice, ...] = NOTICES) -> tuple[int, list[dict]]:
    """(number of words, matches); every exact place is a match, and of overlapping inexact ones the closest."""
    raw = text.encode()
    words = raw.translate(WORD_BYTES).split()
    stream = b" " + b" ".join(words) + b" "
    hits = []
    for notice, phrase, pieces, pattern in _search(notices):
        own = []
        for at in _starts(stream, len(phrase), pieces, notice.edits):
            stop = at + len(phrase)
            if stream.startswith(phrase, at) and stream[stop : stop + 1] == b" ":
                own.append((0, at, stop))
            elif m := pattern.match(stream, at, stop + notice.edits + 1):
                if m.end() > at and (not notice.sure or b" " + notice.sure.encode() + b" " in b" " + m.group() + b" "):
                    own.append((sum(m.fuzzy_counts), at, m.end()))
        taken = []
        for edits, at, stop in sorted(own):
            if not edits or all(stop <= a or at >= b for _, a, b in taken):
                taken.append((edits, at, stop))
        hits += [(at, stop, edits, notice, 1 - edits / len(phrase)) for edits, at, stop in taken]
    if not hits:
        return len(words), []
    # Places of the words in the text, for the spans.
    inside = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    out = []
    for at, stop, edits, notice, score in sorted(hits, key=lambda h: (h[0], h[1], h[3].phrase)):
        first, count = stream.count(b" ", 0, at) - 1, stream[at:stop].count(b" ") + 1
        begin, end = edges[2 * first], edges[2 * (first + count - 1) + 1]
        start = len(raw[:begin].decode(errors="replace"))
        out.append({"label": notice.label, "base": notice.base and not edits, "first_word": first, "n_words": count, "start": start, "end": start + len(raw[begin:end].decode(errors="replace")), "edits": edits, "score": score})
    return len(words), out


def scan(df: DataFrame, text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``df`` with ``n_words`` and ``matches``: label, words, code points from ``start`` to before ``end``, edits, closeness."""
    df = without(df, "n_words", "matches")
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch):
        texts = batch.column(batch.schema.names.index(text)).to_pylist()
        for start, stop in slices([t or "" for t in texts], 4_000_000):
            found = [find(t or "", notices) for t in texts[start:stop]]
            part = batch.slice(start, stop - start)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([n for n, _ in found], pa.int64()), pa.array([m for _, m in found], kind)], [*part.schema.names, "n_words", "matches"])

    return arrow_map(df, run, plus(df, n_words=T.LongType(), matches=T.ArrayType(MATCH)))


def report(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: the exact places of the base phrases, all labels, and the closeness of the best match."""
    found = scan(df.select("doc_id", F.col(text).cast("string").alias("text")))
    base = F.filter("matches", lambda m: m["base"])
    labels = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    words = F.transform(base, lambda m: m["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"), "matches",
    )
