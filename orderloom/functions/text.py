"""Product-name text: normalisation, tokens, attribute extraction, text statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dictionaries import STOPWORDS, AttributeDictionary

# Characters that survive normalisation, and the shoe-size pattern.
NOT_KEPT = r"[^A-ZĄĆĘŁŃÓŚŹŻ0-9\s\-]"
SIZE_PATTERN = r"(?U)\b(3[5-9]|4[0-9]|50)\b"
SPACE = r"(?U)\s+"

ATTRIBUTES = ["color", "material", "size", "product_type", "brand", "season"]
TEXT_STATS = ["name_length", "name_word_count", "name_has_size", "name_uppercase_ratio", "name_digit_count"]


def normalize(text: Column) -> Column:
    """Upper case; anything but letters, digits, blanks and hyphens becomes one blank."""
    upper = F.upper(F.coalesce(text, F.lit("")))
    return F.trim(F.regexp_replace(F.regexp_replace(upper, NOT_KEPT, " "), SPACE, " "))


def words(text: Column) -> Column:
    """Whitespace split without empty tokens."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda t: t != "")


def tokenize(text: Column, min_length: int = 2) -> Column:
    return F.filter(words(text), lambda t: F.length(t) >= min_length)


def remove_stopwords(tokens: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stopwords)))


def lemmatize(tokens: Column, lemmas: Mapping[str, str]) -> Column:
    """Replace known forms by their lemma; unknown tokens stay."""
    if not lemmas:
        return tokens
    table = F.create_map(*[F.lit(x) for pair in lemmas.items() for x in pair])
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t))


def add_tokens(
    df: DataFrame,
    name: str = "name",
    min_length: int = 2,
    lemmas: Mapping[str, str] | None = None,
    stopwords: Sequence[str] = STOPWORDS,
) -> DataFrame:
    """Add ``name_tokens`` and ``name_clean`` (the tokens joined by blanks)."""
    tokens = lemmatize(remove_stopwords(tokenize(normalize(F.col(name)), min_length), stopwords), lemmas or {})
    return df.withColumn("name_tokens", tokens).withColumn("name_clean", F.concat_ws(" ", "name_tokens"))


def _first_hit(pairs: Mapping[str, str], test) -> Column:
    hits = [F.when(test(form), F.lit(canonical)) for form, canonical in pairs.items()]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def match_tokens(tokens: Column, lookup: Mapping[str, str]) -> Column:
    """First dictionary form found among the tokens; the dictionary decides the order, not the text."""
    return _first_hit(lookup, lambda form: F.array_contains(tokens, form))


def match_size(text: Column) -> Column:
    """The last size-like number of the raw text."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(SIZE_PATTERN), 1), F.lit(-1)).cast("int")


def match_brand(text: Column, sku: Column, prefixes: Mapping[str, str], keywords: Mapping[str, str]) -> Column:
    """Article-number prefix first, then a keyword anywhere in the upper-case name."""
    upper = F.upper(text)
    return F.coalesce(
        _first_hit(prefixes, lambda p: F.startswith(sku, F.lit(p))),
        _first_hit(keywords, lambda k: F.contains(upper, F.lit(k))),
    )


def extract_attributes(
    df: DataFrame, dictionary: AttributeDictionary | None = None, name: str = "name", sku: str = "products_sku"
) -> DataFrame:
    """Six attributes from the raw name; all null where the name is missing or empty."""
    d = dictionary or AttributeDictionary()
    code = F.col(sku) if sku in df.columns else F.lit(None).cast("string")
    text = F.when(F.col(name) != "", F.col(name))
    with_words = df.withColumn("_words", words(F.upper(text)))
    tokens = F.col("_words")
    found = {
        "color": match_tokens(tokens, d.colors),
        "material": match_tokens(tokens, d.materials),
        "size": match_size(text),
        "product_type": match_tokens(tokens, d.product_types),
        "brand": F.when(text.isNotNull(), match_brand(text, code, d.brand_prefixes, d.brand_keywords)),
        "season": match_tokens(tokens, d.seasons),
    }
    return with_words.withColumns(found).drop("_words")


def match_by_join(df: DataFrame, key: str, tokens: str, lookup: DataFrame) -> DataFrame:
    """The dictionary match as a join, for dictionaries too long for an expression."""
    exploded = df.select(key, F.explode(tokens).alias("form"))
    hits = exploded.join(lookup, "form")
    return hits.groupBy(key).agg(F.min_by("canonical", "priority").alias("canonical"))


def lemmatize_by_join(df: DataFrame, key: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``df`` with each token replaced by its lemma in the table (form, canonical), for tables too long for an expression.

    ``key`` tells rows apart.  A token is looked up once for all rows that hold it, so a frequent word moves one row for each
    part of the table, not one for each place; only words that have a lemma are carried back to their rows.
    """
    words_of = df.select(key, F.explode(F.array_distinct(tokens)).alias("form"))
    known = words_of.select("form").distinct().join(lemmas.select("form", "canonical").where("form != canonical"), "form")
    changed = words_of.join(known, "form").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("form", "canonical"))).alias("_lemmas"))  # as long as the row
    found = df.join(changed, key, "left")
    new = F.transform(tokens, lambda t: F.coalesce(F.try_element_at("_lemmas", t), t))
    return found.withColumn(tokens, F.coalesce(new, F.col(tokens))).drop("_lemmas")


def coverage(df: DataFrame, columns: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Percent of rows with a value, per attribute."""
    row = df.agg(*[F.try_divide(100.0 * F.count(c), F.count(F.lit(1))).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("attribute"), F.col(c).alias("coverage_pct")) for c in columns]
    return row.select(F.inline(F.array(*entries)))


def add_text_stats(df: DataFrame, name: str = "name") -> DataFrame:
    text = F.coalesce(F.col(name), F.lit(""))
    return df.withColumns(
        {
            "name_length": F.length(text),
            "name_word_count": F.size(words(text)),
            "name_has_size": text.rlike(SIZE_PATTERN).cast("int"),
            "name_uppercase_ratio": F.regexp_count(text, F.lit(r"\p{Lu}")) / F.greatest(F.length(text), F.lit(1)),
            "name_digit_count": F.regexp_count(text, F.lit(r"\p{Nd}")),
        }
    )

