"""Byte-level BPE: encoding with a given rank file, and decoding.

Pre-tokenisation uses no regular expression.  Every code point gets a class from an array, every position a symbol
(the class, and what the next positions hold), and every symbol is a function on the states of a small automaton.
Functions compose associatively and there are few different compositions, so a prefix scan over composition numbers
gives the state before each position, block by block; state and symbol tell whether a piece begins there.  The slices
go through pair merging with a cache.  The start byte of every token is kept, and decoding puts token bytes there.

Null or empty texts have no tokens; texts of any length are taken whole; equal rows give equal results; an empty table
gives an empty table.  Columns named like a result are replaced, all others are passed on.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import arrow_map, plus, slices, without

LETTER, NUMBER, OTHER, BLANK, SPACE, END = range(6)
#: Code points one scan takes at once, unless a single text is longer.
CHUNK = 250_000
BLOCK = 256
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
SHORT = 64
BREAK = 0x110000  # stands between two texts

# States of the automaton: what the piece that is being read may go on with.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, ONE_MORE, TWO_MORE = range(8)
# Symbols of a position.  BLANK_LEADS: a blank before something visible; LAST_SPACE: other white space before something
# visible; MORE_SPACE: white space before white space or the end; QUOTE_n: an apostrophe before a contraction of n letters.
S_LETTER, S_NUMBER, S_OTHER, QUOTE_1, QUOTE_2, BLANK_LEADS, LAST_SPACE, MORE_SPACE, S_END = range(9)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece begins at this position)."""
    if symbol == S_LETTER:
        if state == TWO_MORE:
            return ONE_MORE, False
        if state == ONE_MORE:
            return FRESH, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if symbol in (S_OTHER, QUOTE_1, QUOTE_2):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS, False
        return {S_OTHER: IN_OTHERS, QUOTE_1: ONE_MORE, QUOTE_2: TWO_MORE}[symbol], True
    if symbol == BLANK_LEADS:
        return AFTER_BLANK, True
    if symbol == MORE_SPACE:
        return IN_SPACE, state != IN_SPACE
    return FRESH, True


@lru_cache(1)
def automaton():
    """(first element of each symbol, composition table, state reached from each state, beginnings by state and symbol)."""
    symbols = [tuple(_step(s, x)[0] for s in range(8)) for x in range(9)]
    elements = list(dict.fromkeys(symbols))
    for f in elements:  # grows while it is walked: the closure under composition
        for g in symbols:
            made = tuple(g[f[s]] for s in range(8))
            if made not in elements:
                elements.append(made)
    number = {f: i for i, f in enumerate(elements)}
    compose = np.array([[number[tuple(g[f[s]] for s in range(8))] for g in elements] for f in elements], np.uint8)
    begins = np.array([[_step(s, x)[1] for x in range(9)] for s in range(8)])
    return np.array([number[f] for f in symbols], np.uint8), compose, np.array(elements, np.uint8), begins


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, by the Unicode tables that the tokenizer library itself was built with."""
    import tiktoken

    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}

    def members(pattern: str) -> np.ndarray:
        # Text that the pattern doesn't match is left out of an encoding.
        kept = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(everything)
        return np.frombuffer(bytes(kept).decode().encode("utf-32-le"), np.uint32)

    table = np.full(BREAK + 1, OTHER, np.uint8)
    table[members(r"\p{L}")] = LETTER
    table[members(r"\p{N}")] = NUMBER
    table[members(r"\s")] = SPACE
    table[ord(" ")] = BLANK
    table[BREAK] = END
    return table


def _symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of every position; ``points`` ends with BREAK."""
    kind = classes()[points]
    spacy = (kind == BLANK) | (kind == SPACE)
    ends = kind == END
    closed = np.ones(len(kind), bool)  # white space or an end comes next
    closed[:-1] = spacy[1:] | ends[1:]
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, BLANK_LEADS, LAST_SPACE, S_END], np.uint8)[kind]
    out[spacy & closed] = MORE_SPACE
    quotes = np.flatnonzero(points == ord("'"))
    if quotes.size:
        one = points[np.minimum(quotes + 1, len(points) - 1)]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE_1
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[quotes[pair]] = QUOTE_2
    return out


def _scan(elements: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions, by blocks: inside all blocks at once, then over the blocks' totals."""
    compose = automaton()[1]
    size = compose.shape[1]
    flat = compose.ravel()
    n = len(elements)
    if n <= BLOCK:
        out = elements.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = elements
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    for j in range(1, BLOCK):
        columns[j] = flat[columns[j - 1].astype(np.uint16) * size + columns[j]]
    before = _scan(columns[-1])[:-1]
    columns[:, 1:] = flat[before.astype(np.uint16)[None, :] * size + columns[:, 1:]]
    return np.ascontiguousarray(columns.T).ravel()[:n]


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Positions at which pieces (or a BREAK) begin."""
    first, _, reached, begins = automaton()
    symbols = _symbols(points)
    prefix = _scan(first[symbols])
    state = np.empty(len(points), np.uint8)
    state[0] = FRESH
    state[1:] = reached[:, FRESH][prefix[:-1]]
    return np.flatnonzero(begins.ravel()[state.astype(np.uint16) * begins.shape[1] + symbols])


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``; quadratic in the length, with less to do for a word."""
    get, none = ranks.get, 1 << 62
    cuts = list(range(len(piece) + 1))
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join neighbours, lowest rank first and leftmost among equals, until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n <= SHORT:
        return merge_short(piece, ranks)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))  # where the part that starts here ends; 0: it has been joined to the one before it
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two has changed meanwhile
        end[i], end[j] = stop, 0
        following[i] = k = following[j]
        if k < n:
            previous[k] = i
            if (r := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (h := previous[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        known = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, i in self.ranks.items():
            known[i] = token
        self.lengths = np.array([len(t) for t in known], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.cache: dict[str, list[int]] = {}

    def ids(self, piece: str) -> list[int]:
        found = self.cache.get(piece)
        if found is None:
            found = merge(piece.encode(), self.ranks)
            if len(piece) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[piece] = found
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[breaks] = BREAK
        starts = piece_starts(points)
        bounds = np.searchsorted(starts, breaks)
        places, ids, out, at = starts.tolist(), self.ids, [], 0
        for b in bounds.tolist():
            found = [ids(joined[x:y]) for x, y in zip(places[at:b], places[at + 1 : b + 1])]
            out.append(np.fromiter(chain.from_iterable(found), np.int32))
            at = b + 1
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of tokens that begin at ``offsets``."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        origin = np.repeat(self.starts[ids] - offsets, lengths)
        target = np.repeat(offsets, lengths) + np.arange(len(origin)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = np.empty(len(origin), np.uint8)
        out[target - offsets[0]] = self.bytes[origin + target]
        return out.tobytes()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, kind))


def _with(batch: pa.RecordBatch, start: int, stop: int, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    part = batch.slice(start, stop - start)
    return pa.RecordBatch.from_arrays([*part.columns, *columns], [*batch.schema.names, *names])


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` array<int> and ``offsets`` array<int>, the byte at which each token starts in its text.

    ``path`` names the rank file (base64 token and rank a line), which every worker can read.
    """
    df = without(df, "ids", "offsets")

    def run(batch: pa.RecordBatch):
        words = vocabulary(path)
        texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
        for start, stop in slices(texts, CHUNK):
            ids = words.encode(texts[start:stop])
            offsets = [np.cumsum(words.lengths[i]) - words.lengths[i] for i in ids]
            yield _with(batch, start, stop, ["ids", "offsets"], [_list_array(ids, pa.int32()), _list_array(offsets, pa.int32())])

    return arrow_map(df, run, plus(df, ids=T.ArrayType(T.IntegerType()), offsets=T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``decoded`` binary, the bytes of ``ids`` placed at ``offsets``; null ids decode to no bytes."""
    df = without(df, "decoded")

    def run(batch: pa.RecordBatch):
        words = vocabulary(path)
        ids, offsets = (batch.column(batch.schema.names.index(c)) for c in ("ids", "offsets"))
        for start in range(0, len(batch), 256):
            part = range(start, min(start + 256, len(batch)))
            made = [words.decode(np.asarray(ids[i].values), np.asarray(offsets[i].values).astype(np.int64)) if ids[i].is_valid and len(ids[i]) else b"" for i in part]
            yield _with(batch, start, part.stop, ["decoded"], [pa.array(made, pa.binary())])

    return arrow_map(df, run, plus(df, decoded=T.BinaryType()))


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` and, decoded from them, ``decoded``, in place of ``text``.

    As ``encode`` and then ``decode``, in one pass: one Python worker a task holds the vocabulary, and neither texts nor
    offsets travel back.
    """
    df = without(df, "ids", "decoded")
    kept = df.drop(text)

    def run(batch: pa.RecordBatch):
        words = vocabulary(path)
        at = batch.schema.names.index(text)
        column, rest = batch.column(at), batch.select([n for n in batch.schema.names if n != text])
        for first in range(0, len(batch), 1000):
            texts = [t or "" for t in column.slice(first, 1000).to_pylist()]
            for start, stop in slices(texts, CHUNK):
                ids = words.encode(texts[start:stop])
                decoded = pa.array([words.decode(i, np.cumsum(words.lengths[i]) - words.lengths[i]) for i in ids], pa.binary())
                yield _with(rest, first + start, first + stop, ["ids", "decoded"], [_list_array(ids, pa.int32()), decoded])

    return arrow_map(df, run, plus(kept, ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType()))


def ids_sha256(ids: str = "ids") -> Column:
    """Hexadecimal digest of the decimal ids, joined by one space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256)


def digest(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""
    made = round_trip(df.select("doc_id", F.col(text).alias("text")), path)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_sha256().alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
