"""Product text: tokens, attributes, coverage, statistics, TF-IDF, label split."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orderloom.functions import text as ops
from orderloom.functions.dictionaries import AttributeDictionary, form_lookup, lookup_table, read_lookup
from orderloom.operators import categorise, features, tfidf as tfidf_ops
from orderloom.plans.inputs import ITEMS_SQL, item_names, rounded
from orderloom.plans.registry import query
from orderloom.session import shared_folder
from orderloom.sources.tables import read_table, save_parquet

# Dictionaries for the words of the generated part names; two of the eight
# nouns stay unknown so that some rows carry no label.
DICTIONARY = AttributeDictionary(
    colors=form_lookup({"red": ["RED"], "blue": ["BLUE"]}),
    materials=form_lookup({"worn": ["OLD"], "fresh": ["NEW"]}),
    product_types=form_lookup({"fastener": ["BOLT", "ROD"], "widget": ["WIDGET"], "gear": ["GEAR"], "jewel": ["RING"], "heavy": ["ANVIL"]}),
    seasons=form_lookup({"warm": ["HOT"], "cold": ["COLD"]}),
    brand_prefixes={"Brand#1": "North", "Brand#2": "South", "brand#3": "Never"},
    brand_keywords={"PROMO": "House", "ECONOMY": "Basic"},
)


def _case(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN list_contains({column}, '{f}') THEN '{c}'" for f, c in pairs.items())
    return f"CASE {whens} END"


ATTRIBUTES_SQL = ITEMS_SQL + f"""
, tok AS (SELECT *, string_split(name, ' ') AS t, regexp_extract_all(name, '\\b(3[5-9]|4[0-9]|50)\\b') AS sizes FROM names),
attr AS (SELECT p_partkey, name, products_sku, {_case('t', DICTIONARY.colors)} AS color, {_case('t', DICTIONARY.materials)} AS material,
  CAST(sizes[len(sizes)] AS INT) AS size, {_case('t', DICTIONARY.product_types)} AS product_type,
  CASE WHEN products_sku LIKE 'Brand#1%' THEN 'North' WHEN products_sku LIKE 'Brand#2%' THEN 'South'
       WHEN name LIKE '%PROMO%' THEN 'House' WHEN name LIKE '%ECONOMY%' THEN 'Basic' END AS brand,
  {_case('t', DICTIONARY.seasons)} AS season FROM tok)
"""


def attributes(spark, d):
    return ops.extract_attributes(item_names(spark, d), DICTIONARY)


@query(
    "normalize_tokens",
    """
    WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-ZĄĆĘŁŃÓŚŹŻ0-9\\s\\-]', ' ', 'g'), '\\s+', ' ', 'g')) AS x FROM documents),
    t AS (SELECT doc_id, list_filter(string_split(x, ' '), lambda w: length(w) >= 2 AND w NOT IN
      ('NA','W','Z','ZE','DO','ZA','I','DLA','PRZY','OD','PO','BEZ','PRZED','MIĘDZY','PRZEZ','O','POD','ORAZ','A','AN','THE','OF','AND')) AS k FROM n)
    SELECT doc_id, array_to_string(k, ' ') AS name_clean, CAST(len(k) AS INT) AS n_tokens FROM t
    """,
)
def normalize_tokens(spark, d):
    tokens = ops.add_tokens(read_table(spark, d, "documents").select("doc_id", "text"), "text")
    return tokens.select("doc_id", "name_clean", F.size("name_tokens").alias("n_tokens"))


@query(
    "lemmatized_tokens",
    "WITH " + ITEMS_SQL + """SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(name, ' '), lambda w: length(w) >= 2),
      lambda w: CASE w WHEN 'OLD' THEN 'AGED' WHEN 'LARGE' THEN 'BIG' ELSE w END), ' ') AS name_clean FROM names""",
)
def lemmatized_tokens(spark, d):
    return ops.add_tokens(item_names(spark, d), lemmas={"OLD": "AGED", "LARGE": "BIG"}).select("p_partkey", "name_clean")


@query(
    "extract_attributes",
    "WITH " + ATTRIBUTES_SQL + """SELECT l_orderkey, l_linenumber, p_partkey, name, color, material, size, product_type, brand, season
    FROM lineitem JOIN attr ON l_partkey = p_partkey""",
)
def extract_attributes(spark, d):
    """Attributes are computed once per product and then joined to its order lines."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return lines.join(attributes(spark, d), "p_partkey").select(
        "l_orderkey", "l_linenumber", "p_partkey", "name", *ops.ATTRIBUTES
    )


@query(
    "dictionary_join",
    "WITH " + ATTRIBUTES_SQL + "SELECT p_partkey, product_type AS canonical FROM attr WHERE product_type IS NOT NULL",
)
def dictionary_join(spark, d):
    tokens = item_names(spark, d).withColumn("tokens", ops.words(F.upper("name")))
    return ops.match_by_join(tokens, "p_partkey", "tokens", lookup_table(spark, DICTIONARY.product_types))


def _written(spark, table, name):
    """A table saved in the folder all executors share and read back."""
    return spark.read.parquet(save_parquet(table, f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"))


@query(
    "dictionary_table",
    "WITH " + ATTRIBUTES_SQL + "SELECT p_partkey, product_type AS canonical FROM attr WHERE product_type IS NOT NULL",
)
def dictionary_table(spark, d):
    """The dictionary comes from a written table, not from the plan."""
    lookup = read_lookup(_written(spark, lookup_table(spark, DICTIONARY.product_types), "product-types"))
    return ops.match_by_join(item_names(spark, d).withColumn("tokens", ops.words(F.upper("name"))), "p_partkey", "tokens", lookup)


@query(
    "lemmas_from_table",
    """WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w <> '') AS k FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, array_to_string(list_transform(k, lambda w: CASE WHEN length(w) > 3 AND w LIKE '%s' THEN w[:-2] ELSE w END), ' ') AS lemmas FROM t""",
)
def lemmas_from_table(spark, d):
    """The lemma table is made from the corpus itself (words of more than three letters lose a last s), written, and joined."""
    docs = read_table(spark, d, "documents").where("text is not null").select("doc_id", F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "").alias("words"))
    forms = docs.select(F.explode("words").alias("form")).distinct().where("length(form) > 3 and form like '%s'")
    lemmas = _written(spark, forms.select("form", F.expr("substr(form, 1, length(form) - 1)").alias("canonical")), "lemmas")
    return ops.lemmatize_by_join(docs, "doc_id", "words", lemmas).select("doc_id", F.concat_ws(" ", "words").alias("lemmas"))


@query(
    "coverage",
    "WITH " + ATTRIBUTES_SQL + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, round(100.0 * COUNT({a}) / COUNT(*), 6) AS coverage_pct FROM lineitem JOIN attr ON l_partkey = p_partkey"
        for a in ops.ATTRIBUTES),
)
def coverage(spark, d):
    lines = read_table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return rounded(ops.coverage(lines.join(attributes(spark, d), "p_partkey")))


@query(
    "text_stats",
    """SELECT doc_id, CAST(length(text) AS INT) AS name_length,
      CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS INT) AS name_word_count,
      CAST(regexp_matches(text, '(^|[^\\p{L}\\p{N}_])(3[5-9]|4[0-9]|50)([^\\p{L}\\p{N}_]|$)') AS INT) AS name_has_size,
      round(len(regexp_extract_all(text, '\\p{Lu}')) / greatest(length(text), 1), 6) AS name_uppercase_ratio,
      CAST(len(regexp_extract_all(text, '\\p{Nd}')) AS INT) AS name_digit_count FROM documents""",
)
def text_stats(spark, d):
    stats = ops.add_text_stats(read_table(spark, d, "documents").select("doc_id", "text"), "text")
    return rounded(stats.select("doc_id", *ops.TEXT_STATS))


_VALUES = {
    "color": ["blue", "red", "unknown"],
    "material": ["fresh", "unknown", "worn"],
    "product_type": ["fastener", "gear", "heavy", "jewel", "unknown", "widget"],
    "season": ["cold", "unknown", "warm"],
    "brand": ["Basic", "House", "North", "South", "unknown"],
}


@query(
    "onehot_attributes",
    "WITH " + ATTRIBUTES_SQL + "SELECT p_partkey, " + ", ".join(
        f"CAST(COALESCE({c}, 'unknown') = '{v}' AS INT)::DOUBLE AS {c}_{v}" for c, vs in _VALUES.items() for v in vs
    ) + " FROM attr",
)
def onehot_attributes(spark, d):
    encoded = features.encode_attributes(attributes(spark, d).select("p_partkey", *_VALUES), list(_VALUES))
    return rounded(encoded)


def _tfidf_sql(source: str, key: str, token_list: str, max_features: int) -> str:
    return f"""
    w AS (SELECT {key}, {token_list} AS t FROM {source}),
    g AS (SELECT {key}, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms FROM w),
    c AS (SELECT {key}, term, COUNT(*) AS tf FROM (SELECT {key}, UNNEST(terms) AS term FROM g) GROUP BY 1, 2),
    nd AS (SELECT COUNT(*) AS n FROM w),
    v AS (SELECT term, ln((1.0 + (SELECT n FROM nd)) / (1.0 + COUNT(*))) + 1 AS idf FROM c GROUP BY term HAVING COUNT(*) >= 2
          ORDER BY SUM(tf) DESC, term LIMIT {max_features}),
    x AS (SELECT {key}, term, tf * idf AS w FROM c JOIN v USING (term)),
    tfidf AS (SELECT {key}, term, w / sqrt(SUM(w * w) OVER (PARTITION BY {key})) AS weight FROM x)
    """


_PART_TOKENS = "regexp_extract_all(lower(name), '[\\p{L}\\p{N}_]{2,}')"


@query("tfidf", "WITH " + ITEMS_SQL + "," + _tfidf_sql("names", "p_partkey", _PART_TOKENS, 500)
       + "SELECT p_partkey, term, round(weight, 6) AS weight FROM tfidf")
def tfidf(spark, d):
    return rounded(tfidf_ops.tfidf(item_names(spark, d), "p_partkey", "name", max_features=500))


@query("tfidf_documents", "WITH " + _tfidf_sql("documents", "doc_id", "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')", 500)
       + "SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def tfidf_documents(spark, d):
    return rounded(tfidf_ops.tfidf(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text"))


_FM_DENSE = ["name_length", "name_word_count", "name_has_size", "name_uppercase_ratio", "name_digit_count"]
_FM_HOT = [f"{c}_{v}" for c, vs in _VALUES.items() for v in vs]


@query(
    "feature_matrix_long",
    "WITH " + ATTRIBUTES_SQL + "," + _tfidf_sql("names", "p_partkey", _PART_TOKENS, 500) + """
    , st AS (SELECT p_partkey, length(name)::DOUBLE AS name_length, len(t)::DOUBLE AS name_word_count, (len(sizes) > 0)::INT::DOUBLE AS name_has_size,
       len(regexp_extract_all(name, '[A-Z]')) / length(name) AS name_uppercase_ratio, len(regexp_extract_all(name, '[0-9]'))::DOUBLE AS name_digit_count FROM tok)
    SELECT p_partkey, 'tfidf_' || term AS feature, round(weight, 6) AS value FROM tfidf """
    + "".join(f" UNION ALL SELECT p_partkey, '{c}', round({c}, 6) FROM st WHERE {c} <> 0" for c in _FM_DENSE)
    + "".join(f" UNION ALL SELECT p_partkey, '{c}_{v}', 1.0 FROM attr WHERE COALESCE({c}, 'unknown') = '{v}'" for c, vs in _VALUES.items() for v in vs),
)
def feature_matrix_long(spark, d):
    rows = ops.add_text_stats(attributes(spark, d))
    encoded = features.encode_attributes(rows.select("p_partkey", "name", *_FM_DENSE, *_VALUES), list(_VALUES))
    weights = tfidf_ops.tfidf(item_names(spark, d), "p_partkey", "name", max_features=500)
    return rounded(tfidf_ops.feature_matrix(encoded, "p_partkey", weights, _FM_DENSE, _FM_HOT))


@query(
    "label_split",
    "WITH " + ATTRIBUTES_SQL + """
    , c AS (SELECT product_type, COUNT(*) AS n FROM attr WHERE product_type IS NOT NULL GROUP BY 1)
    SELECT p_partkey, attr.product_type, CAST(COALESCE(n >= 250, FALSE) AS INT) AS is_labeled FROM attr LEFT JOIN c USING (product_type)""",
)
def label_split(spark, d):
    rows = attributes(spark, d).select("p_partkey", "product_type")
    return rounded(categorise.mark_labeled(rows, "product_type", 250))


@query(
    "confusion_f1",
    "WITH " + ATTRIBUTES_SQL + """
    , p AS (SELECT product_type AS truth, CASE WHEN p_partkey % 7 = 0 THEN 'widget' ELSE product_type END AS predicted FROM attr WHERE product_type IS NOT NULL),
    k AS (SELECT DISTINCT truth AS label FROM p),
    s AS (SELECT label, (SELECT COUNT(*) FROM p WHERE truth = label) AS support, (SELECT COUNT(*) FROM p WHERE predicted = label) AS given,
       (SELECT COUNT(*) FROM p WHERE truth = label AND predicted = label) AS hit FROM k)
    SELECT label, support, round(hit / given, 6) AS precision, round(hit / support, 6) AS recall, round(2 * hit / (support + given), 6) AS f1 FROM s""",
)
def confusion_f1(spark, d):
    from orderloom.operators import evaluation

    return rounded(evaluation.class_f1(evaluation.confusion(_spoiled(spark, d), "truth", "predicted")).drop("hit"))


def _spoiled(spark, d):
    """True types with every seventh prediction wrong."""
    return attributes(spark, d).where("product_type is not null").select(
        F.col("product_type").alias("truth"),
        F.when(F.col("p_partkey") % 7 == 0, "widget").otherwise(F.col("product_type")).alias("predicted"),
    )


@query(
    "confusion_matrix",
    "WITH " + ATTRIBUTES_SQL + """
    , p AS (SELECT product_type AS truth, CASE WHEN p_partkey % 7 = 0 THEN 'widget' ELSE product_type END AS predicted FROM attr WHERE product_type IS NOT NULL),
    k AS (SELECT DISTINCT truth AS c FROM p)
    SELECT a.c AS truth, b.c AS predicted, (SELECT COUNT(*) FROM p WHERE truth = a.c AND predicted = b.c) AS n FROM k a CROSS JOIN k b""",
)
def confusion_matrix(spark, d):
    from orderloom.operators import evaluation

    return evaluation.confusion(_spoiled(spark, d), "truth", "predicted")
