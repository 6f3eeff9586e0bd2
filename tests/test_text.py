import math
import re
from collections import Counter

from pyspark.sql import functions as F

from orderloom.functions import text as ops
from orderloom.functions.dictionaries import form_lookup
from orderloom.operators import categorise, evaluation, tfidf


def test_normalise_and_tokens(spark):
    df = spark.createDataFrame([("Półbuty  skórzane, na zimę! (b-1) ż",), (None,), ("",)], "name string")
    rows = ops.add_tokens(df).collect()
    assert rows[0].name_tokens == ["PÓŁBUTY", "SKÓRZANE", "ZIMĘ", "B-1"]
    assert rows[0].name_clean == "PÓŁBUTY SKÓRZANE ZIMĘ B-1"
    assert rows[1].name_clean == "" and rows[1].name_tokens == []
    assert rows[2].name_clean == ""


def test_repeated_tokens_stay(spark):
    df = spark.createDataFrame([("buty buty na buty",)], "name string")
    assert ops.add_tokens(df).first().name_tokens == ["BUTY", "BUTY", "BUTY"]
    assert ops.add_tokens(df, lemmas={"BUTY": "BUT"}).first().name_clean == "BUT BUT BUT"


CASES = [
    ("BOTKI SKÓRZANE CZARNE 38", "OPT123", ("czarny", "skorzany", 38, "botki", "Optimo", None)),
    ("TRAPERY, zamszowe skórzane OCIEPLANE 36 40", None, (None, "skorzany", 40, None, None, "warm")),
    ("MODEL 100 BOTKI 39", "bota1", (None, None, 39, "botki", "Art", None)),
    ("MODEL BOTKI 51 34", "BOTA1", (None, None, None, "botki", None, None)),
    ("Kozaki Sergio Leone LETNIE czarne białe", "x", ("czarny", None, None, "kozaki", "Sergio Leone", "cold")),
    ("", "OPT1", (None,) * 6),
    (None, "OPT1", (None,) * 6),
    ("EKO SKÓRA", None, (None, "skorzany", None, None, None, None)),
]


def test_extraction(spark):
    df = spark.createDataFrame([(i, n, s) for i, (n, s, _) in enumerate(CASES)], "i int, name string, products_sku string")
    rows = ops.extract_attributes(df).orderBy("i").collect()
    for row, (name, _, want) in zip(rows, CASES, strict=True):
        assert tuple(row[a] for a in ops.ATTRIBUTES) == want, name


def test_lookup_keeps_place_of_repeated_form():
    assert list(form_lookup({"a": ["X", "Y"], "b": ["X", "Z"]}).items()) == [("X", "b"), ("Y", "a"), ("Z", "b")]


def test_text_stats(spark):
    df = spark.createDataFrame([("Ab Ż9 38",), (None,)], "name string")
    row, empty = ops.add_text_stats(df).collect()
    assert (row.name_length, row.name_word_count, row.name_has_size, row.name_digit_count) == (8, 3, 1, 3)
    assert row.name_uppercase_ratio == 2 / 8
    assert (empty.name_length, empty.name_word_count, empty.name_uppercase_ratio) == (0, 0, 0.0)


def test_tfidf_against_brute_force(spark):
    texts = ["red boots red-hot", "blue boots", "red boots x", "a b", None, "boots red boots red"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {(r.id, r.term): r.weight for r in tfidf.tfidf(df, "id", "t", max_features=4).collect()}
    docs = []
    for t in texts:
        w = re.findall(r"\w\w+", (t or "").lower())
        docs.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    df_count = Counter(x for doc in docs for x in doc)
    total = Counter()
    for doc in docs:
        total.update(doc)
    vocab = sorted([x for x in total if df_count[x] >= 2], key=lambda x: (-total[x], x))[:4]
    idf = {x: math.log((1 + len(texts)) / (1 + df_count[x])) + 1 for x in vocab}
    want = {}
    for i, doc in enumerate(docs):
        weights = {x: doc[x] * idf[x] for x in vocab if x in doc}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        want.update({(i, x): v / norm for x, v in weights.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def _labelled(spark):
    kinds = {"botki": "BOTKI SKÓRZANE", "kozaki": "KOZAKI ZIMOWE", "klapki": "KLAPKI LETNIE"}
    rows = [(i * 10 + j, f"{text} M{j % 4}", kind) for i, (kind, text) in enumerate(kinds.items()) for j in range(10)]
    return spark.createDataFrame(rows + [(90, "BOTKI NOWE", None), (91, None, None), (92, "GLANY", "glany")], "id int, name_clean string, product_type string")


def test_label_split(spark):
    labelled, rest = categorise.split_labeled(_labelled(spark), min_class_size=3)
    assert labelled.count() == 30 and {r.id for r in rest.collect()} == {90, 91, 92}
    assert categorise.split_labeled(spark.range(2))[0].count() == 0


def test_stratified_folds(spark):
    labelled, _ = categorise.split_labeled(_labelled(spark), min_class_size=3)
    sizes = categorise.stratified_folds(labelled, "id", "product_type", 2).groupBy("product_type", "fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [5] * 6


def test_classifier_predicts_and_reloads(spark, tmp_path):
    from pyspark.ml import PipelineModel

    labelled, rest = categorise.split_labeled(_labelled(spark), min_class_size=3)
    model = categorise.fit_classifier(tfidf.add_terms(labelled, "name_clean"), "random_forest", {"trees": 5})
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    got = {r.id: r.product_type for r in categorise.predict_unlabeled(loaded, rest).collect()}
    assert got[90] == "botki" and set(got) == {90, 91, 92}
    report = categorise.training_report(model, tfidf.add_terms(labelled, "name_clean"))
    assert evaluation.macro_scores(report).first().accuracy == 1.0


def test_equal_counts_are_ordered_by_term(spark):
    rows = [[f"t{i:02d}" for i in range(40)], [f"t{i:02d}" for i in range(39, -1, -1)], ["z", "z", "z", "t05"], ["z", "once", "once", "once", "once"]]
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(r,) for r in rows], "terms array<string>").repartition(parts)
        counter = categorise.fit_text_features(df, max_features=5)[0]
        assert counter.vocabulary == ["z", "t05", "t00", "t01", "t02"]
    try:
        categorise.fit_text_features(df.where("size(terms) = 5"))
    except ValueError as error:
        assert "2 texts" in str(error)
    else:
        raise AssertionError("no error")


def test_unknown_model_type():
    try:
        categorise.build_classifier("perceptron")
    except ValueError as error:
        assert "perceptron" in str(error)
    else:
        raise AssertionError("no error")


def test_macro_scores_with_absent_prediction(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    counts = evaluation.confusion(df, "t", "p")
    assert counts.count() == 9
    per_class = {r.label: r.f1 for r in evaluation.class_f1(counts).collect()}
    assert per_class["c"] == 0.0 and abs(per_class["a"] - 0.5) < 1e-12 and abs(per_class["b"] - 2 / 3) < 1e-12


def test_dictionary_join_equals_expression(spark):
    from orderloom.functions.dictionaries import COLORS, lookup_table

    df = spark.createDataFrame([(1, "BUTY białe CZARNE"), (2, "BUTY"), (3, "red navy")], "id int, name string")
    words = df.withColumn("w", ops.words(F.upper("name")))
    lookup = form_lookup(COLORS)
    by_join = {r.id: r.canonical for r in ops.match_by_join(words, "id", "w", lookup_table(spark, lookup)).collect()}
    by_expression = {r.id: r.c for r in words.select("id", ops.match_tokens(F.col("w"), lookup).alias("c")).collect() if r.c}
    assert by_join == by_expression == {1: "czarny", 3: "czerwony"}


def test_lookup_from_a_table(spark):
    from orderloom.functions.dictionaries import read_lookup

    rows = [("red", "r", 3), ("Red", "rr", 5), ("BLUE", "b", 1), (None, "n", 0)]
    got = sorted(map(tuple, read_lookup(spark.createDataFrame(rows, "form string, canonical string, priority int")).collect()))
    assert got == [("BLUE", "b", 1), ("RED", "rr", 3)]


def test_lemmas_by_join_keep_places(spark):
    df = spark.createDataFrame([(1, ["cats", "and", "cats", "dogs"]), (2, []), (3, None), (4, ["and"])], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("mice", "mouse")], "form string, canonical string")
    got = {r.id: r.tokens for r in ops.lemmatize_by_join(df, "id", "tokens", lemmas).collect()}
    assert got == {1: ["cat", "and", "cat", "dog"], 2: [], 3: None, 4: ["and"]}


def test_one_class_with_most_rows_stays_spread(spark):
    """Nine tenths of the rows in one class: no task of the result holds more than a tenth of them."""
    from orderloom.operators.categorise import mark_labeled
    from orderloom.operators.features import reduce_cardinality

    kind = F.when(F.col("id") % 10 < 9, F.lit("most")).when(F.col("id") % 100 == 9, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") / 40).cast("int")))
    df = spark.range(0, 40_000, 1, 16).withColumn("kind", kind)
    for made in (mark_labeled(df, "kind", 4), reduce_cardinality(df, "kind", 4)):
        parts = made.groupBy(F.spark_partition_id()).count().collect()
        assert sum(p["count"] for p in parts) == 40_000 and max(p["count"] for p in parts) < 4_000
    sizes = {r["kind"]: r["count"] for r in df.groupBy("kind").count().collect()}
    marked = {(r["kind"], r.is_labeled) for r in mark_labeled(df, "kind", 4).select("kind", "is_labeled").distinct().collect()}
    assert marked == {(k, k is not None and n >= 4) for k, n in sizes.items()}


def test_tfidf_counts_no_ngram_that_cannot_matter(spark):
    """Rare words, and n-grams with one, are not counted by text where the vocabulary is full of more frequent words."""
    from orderloom.operators import tfidf

    rows = [(i // 2, " ".join(["aa", "bb", "cc", f"only{i}", "aa", f"two{i // 3}", "bb"][: 3 + i % 5])) for i in range(40)] + [(None, "aa cc dd"), (7, None), (99, "zz " * 50)]
    df = spark.createDataFrame(rows, "id long, text string")
    words = tfidf.frequent_words(df, "id", "text", 3, (1, 2), 2)
    assert set(words) == {"aa", "bb", "cc", "zz"}
    assert {r.term for r in tfidf.frequent_counts(df, "id", "text", words, (1, 2)).collect()} == {"aa", "bb", "cc", "zz", "aa bb", "bb cc", "aa cc", "zz zz"}
    want = tfidf.vocabulary(tfidf.term_counts(df, "id", "text"), F.lit(43), 3, 2)
    got = {(r.id, r.term) for r in tfidf.tfidf(df, "id", "text", 3).collect()}
    assert {t for _, t in got} == {r.term for r in want.collect()}
    assert tfidf.frequent_words(df, "id", "text", 1000, (1, 2), 2) is None
