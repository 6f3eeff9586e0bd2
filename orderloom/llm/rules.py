"""Quality rules as a ledger: every rule is evaluated once per document and leaves one bit and its measurement.

Policies come later and only read the ledger: a policy is a named, versioned mask of rules, and what leaving a rule out
would change is counted from the bits alone.  All of it is built from SQL functions.

Null text counts as the empty text (no words, fails the length rule); white space is ASCII white space; equal rows
give equal results; an empty table gives an empty ledger and ablations of zero rows; columns named like a result are
replaced.  Repetition is found by sorting hashes of three words inside the row, so a text's length has no limit, and
neighbours in that order are compared word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text, without

BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurements


#: The bit of a rule is its place in this list; rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "n_symbols > 0.25 * n_words"),
    Rule("duplicate_lines", "n_dup_lines > 0.3 * n_lines and n_dup_lines > 2"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("capitals", "n_capitals > 0.5 * n_letters"),
    Rule("exclamations", "n_exclamations > 0.25 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, r in enumerate(RULES) if r.name in self.rules)


BASE_POLICY = Policy("base", 1, BASE)
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def _count(text: Column, drop: str) -> Column:
    """How many characters of ``text`` are among ``drop``."""
    return (F.length(text) - F.length(F.translate(text, drop, ""))).cast("long")


def _windows(words: Column, n: Column, bits: Column) -> Column:
    """Keys of all windows of three words: their hash above, their place in the lowest ``bits`` bits."""
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.coalesce(F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("long")), F.lit(0).cast("long")))
    return F.when(n >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>"))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_letters, n_exclamations."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_letters", "n_exclamations"]
    df = without(df, *[n for n in names if n != text], "_t", "_w", "_l", "_b", "_k", "_d")
    keep = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*keep, whole_text(text).alias("_t"))
    df = df.select(
        "*", F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+", -1), "").alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    df = df.select("*", F.size("_w").alias("_n"), F.length(F.bin(F.size("_w").cast("long"))).alias("_b"))
    df = df.select("*", _windows(F.col("_w"), F.col("_n"), F.col("_b")).alias("_k"))
    word = lambda i: F.get("_w", i.cast("int"))
    place = lambda key: key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1)

    def same(x: Column, y: Column) -> Column:
        a, b = place(x), place(y)
        alike = F.call_function("shiftrightunsigned", x, F.col("_b")) == F.call_function("shiftrightunsigned", y, F.col("_b"))
        return alike & (word(a) == word(b)) & (word(a + 1) == word(b + 1)) & (word(a + 2) == word(b + 2))

    repeats = F.filter("_k", lambda x, i: F.coalesce(same(x, F.get("_k", i + 1)), F.lit(False)) | F.coalesce(same(x, F.get("_k", i - 1)), F.lit(False)))
    df = df.select("*", F.sort_array(F.transform(repeats, place)).alias("_d"))
    covered = F.transform("_d", lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_d", i + 1), x + 3) - x))
    letters = F.regexp_replace("_t", r"[^\p{L}]+", "")
    df = df.select("*", letters.alias("_a"))
    return df.select(
        *keep, F.col("_n").cast("long").alias("n_words"), (F.length("_t") - _count(F.col("_t"), " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        _count(F.col("_t"), "#*$%&|<>").alias("n_symbols"), F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"),
        F.length(F.regexp_replace("_a", r"\P{Lu}+", "")).cast("long").alias("n_capitals"), F.length("_a").cast("long").alias("n_letters"),
        _count(F.col("_t"), "!").alias("n_exclamations"),
    )


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements and ``rule_bits``: bit i is set where rule i fails."""
    measured = measure(without(df, "rule_bits"), text)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    return measured.withColumn("rule_bits", sum(bits[1:], bits[0]).cast("long"))


def failed(policy: Policy) -> Column:
    return F.col("rule_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply(entries: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with ``policy`` (name and version) and ``kept``."""
    return entries.withColumn("policy", F.lit(f"{policy.name}-{policy.version}")).withColumn("kept", ~failed(policy))


def ablate(entries: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """(rule, failed, only, dropped): how many documents fail a rule, how many fail it alone among the policy's rules
    (they would come back without it), and how many the policy drops.  One aggregate over distinct bit patterns."""
    own = F.col("rule_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = entries.groupBy(own.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if r.name in policy.rules])
    return (
        patterns.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("dropped"),
        )
    )


def verdicts(df: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """One row per document: the base counts, whether it fails a base rule, and the policy's verdict."""
    entries = apply(ledger(df.select("doc_id", "text")), policy)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed(BASE_POLICY).alias("base_failed"),
        (~failed(BASE_POLICY) & F.col("kept")).alias("kept"), "rule_bits", "policy",
    )
