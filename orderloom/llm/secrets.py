"""Secret scan: three plain patterns, and strings of high entropy.

The patterns are found whole and leftmost first; their places follow from the lengths of the matches and of what stands
between them.  Beyond them, candidate strings of one character class are read with a sliding window: each step takes
one character into the window's counts and one out of them, and the sum of c * log2(c) changes by these two terms only.
What plain matches cover is cut out of a candidate, and each rest of a window or more is judged by itself.  It counts
where some window's Shannon entropy reaches the limit of its class, unless an allow-list pattern knows it.

All of it is SQL functions.  Places are code points, end exclusive.  Null and empty texts have no spans; texts are read
whole; equal rows give equal results; an empty table gives an empty table; columns named like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text, without

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

WINDOW = 24


@dataclass(frozen=True)
class Alphabet:
    name: str
    pattern: str  # what a whole candidate looks like
    bits: float  # a window's entropy from which a candidate counts


#: The first alphabet that a candidate fits decides.
ALPHABETS = (
    Alphabet("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    Alphabet("base36", r"^(?:[0-9a-z_-]+|[0-9A-Z_-]+)$", 3.8),
    Alphabet("base64", r"^[0-9A-Za-z+/_-]+={0,2}$", 4.0),
)
CANDIDATE = r"[A-Za-z0-9+/_-]{24,}={0,2}"
#: Letters between separators that are of one case, or words of three or more small letters with at most one shorter piece between two.
_WORD, _SHORT = "[A-Z]*+[a-z]{3,}+", "(?:[A-Z]++[a-z]{0,2}+|[a-z]{1,2}+)(?![a-z])"
_WORDS = f"(?:(?:[A-Z]?[a-z]++|[A-Z]++|(?:(?:{_SHORT})?{_WORD})++(?:{_SHORT})?)(?![A-Za-z]))"
#: A candidate that one of these finds is no secret: identifiers, integrity hashes, samples, runs and paths of words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(256|384|512)-",
    r"(?i)example|sample|placeholder|changeme|your_|xxxx|0123456789|abcdefgh",
    rf"^[/_+-]*+{_WORDS}(?:[/_+-]++{_WORDS})*+[/_+-]*+={{0,2}}$",
    rf"^/?(?:{_WORDS}[0-9]?[/_-]++)++(?:{_WORDS})?[0-9]*$",
)

KINDS = ("assign", "access", "hex", "entropy")
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Places of all matches, of which ``keep`` (a function of match and group 2 or null) leaves some."""
    lengths = lambda strings: F.transform(strings, lambda s: F.length(s))
    found = F.arrays_zip(
        F.slice(lengths(F.split(text, pattern, -1)), 1, F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("value")] if pattern is ASSIGN else []),
    )
    start = F.struct(F.lit(0).alias("at"), _none().alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.length(x["match"])
        one = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))).cast(SPAN)
        return F.struct(end.alias("at"), F.when(keep(x), F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(found, start, step, lambda s: s["spans"])


def _windowed(candidate: Column) -> Column:
    """The highest entropy, in bits, of any window of the candidate."""
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    code = lambda i: F.ascii(F.substring(candidate, i, F.lit(1)))
    first, last = 43, 122  # '+' to 'z'
    empty = F.struct(F.array_repeat(F.lit(0), last - first + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(state: Column, i: Column) -> Column:
        into, out = code(i) - first, F.when(i > WINDOW, code(i - WINDOW) - first).otherwise(F.lit(-1))
        a = F.get(state["counts"], into)
        less = F.coalesce(F.get(state["counts"], out), F.lit(0))
        b = less + F.when(into == out, 1).otherwise(0)  # after the new one has come in
        total = state["sum"] + F.get(terms, a + 1) - F.get(terms, a) + F.when(out >= 0, F.get(terms, b - 1) - F.get(terms, b)).otherwise(F.lit(0.0))
        counts = F.transform(state["counts"], lambda c, j: c + F.when(j == into, 1).otherwise(0) - F.when(j == out, 1).otherwise(0))
        bits = F.when(i >= WINDOW, F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(state["best"], bits).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), empty, step, lambda s: s["best"])


def _secretive(candidate: Column, core: Column) -> Column:
    """``core`` is the candidate without the separators at its cuts; it decides on the alphabet and the allow-list."""
    limit = F.lit(None).cast("double")
    for a in reversed(ALPHABETS):
        limit = F.when(core.rlike(a.pattern), F.lit(a.bits)).otherwise(limit)
    known = F.lit(False)
    for pattern in ALLOWED:
        known = known | core.rlike(pattern)
    return F.when(known, F.lit(False)).otherwise(F.coalesce(_windowed(candidate) >= limit, F.lit(False)))


def _rests(candidates: Column, base: Column) -> Column:
    """array<struct<start, end, match, core>>: what ``base``, in order of start, leaves of each of ``_candidates``."""
    kind = "array<struct<start:int,end:int,match:string,core:string>>"

    def cut(c: Column) -> Column:
        def rest(start: Column, end: Column) -> Column:
            match = F.substring(c["match"], start - c["start"] + 1, end - start)
            core = F.when(start > c["start"], F.regexp_replace(match, "^[/_+-]+", "")).otherwise(match)
            core = F.when(end < c["end"], F.regexp_replace(core, "[/_+-]+$", "")).otherwise(core)
            return F.array(F.struct(start.alias("start"), end.alias("end"), match.alias("match"), core.alias("core"))).cast(kind)

        def step(state: Column, b: Column) -> Column:
            free = F.when(b["start"] - state["at"] >= WINDOW, F.concat(state["out"], rest(state["at"], b["start"]))).otherwise(state["out"])
            return F.struct(F.greatest(state["at"], b["end"]).alias("at"), free.alias("out"))

        over = F.filter(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        first = F.struct(c["start"].alias("at"), F.array().cast(kind).alias("out"))
        last = lambda s: F.when(c["end"] - s["at"] >= WINDOW, F.concat(s["out"], rest(s["at"], c["end"]))).otherwise(s["out"])
        return F.aggregate(over, first, step, last)

    return F.flatten(F.transform(candidates, cut))


def _candidates(text: Column) -> Column:
    """array<struct<start, end, match>> of all candidates."""
    places = _spans(text, CANDIDATE, 3, lambda x: F.lit(True))
    both = F.arrays_zip(places.alias("place"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("match"))
    return F.transform(both, lambda x: F.struct(x["place"]["start"].alias("start"), x["place"]["end"].alias("end"), x["match"].alias("match")))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``found`` array<struct<start, kind, end>>, in order of start, then kind; ``kind`` counts in KINDS."""
    df = without(df, "found", "_t", "_base", "_more", "_rests")
    keep = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*keep, whole_text(text).alias("_t"))
    t = F.col("_t")
    assign = F.when(t.rlike(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""), _spans(t, ASSIGN, 0, lambda x: F.length(x["value"]) >= 8)).otherwise(_none())
    access = F.when(t.contains("AKIA"), _spans(t, ACCESS, 1, lambda x: F.length(x["match"]) >= 16)).otherwise(_none())
    # A run of 32 or more is the whole of a leftmost match, so shorter matches need not be made first.
    hexes = F.when(t.rlike("[0-9a-f]{32}"), _spans(t, "[0-9a-f]{32,}", 2, lambda x: F.lit(True))).otherwise(_none())
    more = F.when(t.rlike(CANDIDATE), _candidates(t)).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))
    df = df.select("*", F.sort_array(F.concat(assign, access, hexes)).alias("_base"), more.alias("_more"))
    df = df.select("*", _rests(F.col("_more"), F.col("_base")).alias("_rests"))
    strong = F.filter("_rests", lambda r: _secretive(r["match"], r["core"]))
    alone = F.transform(strong, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end"))).cast(SPAN)
    return df.select(*keep, F.sort_array(F.concat("_base", alone)).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, text: str = "text") -> DataFrame:
    found = scan(df.select("doc_id", F.col(text).alias("text")))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), count(3).alias("n_entropy"),
    )


def redact(df: DataFrame, mask: str = "[SECRET]", text: str = "text") -> DataFrame:
    """``df`` with every found span of the text replaced by ``mask`` (overlapping spans by one); other texts are left as they are."""
    columns = df.columns
    found = scan(df, text)
    body = F.col(f"`{text}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(body, state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"))

    cleaned = F.aggregate("found", start, step, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    masked = F.when(F.size("found") > 0, cleaned).otherwise(body)
    return found.select(*[masked.alias(text) if c == text else F.col(f"`{c}`") for c in columns])
