import hashlib
import random
import re

from pyspark.sql import functions as F

from orderloom.llm import fingerprints as fp


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def rows():
    rng = random.Random(1)
    long = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(rng.randint(0, 900))) for _ in range(60)]
    return [(i * 7, t) for i, t in enumerate(long + [None, "", "é🙂", "two words", long[3], long[3]])]


def check(spark, many, parts):
    df = spark.createDataFrame(many, "doc_id long, text string")

    def carry(d):
        return d, ["text"]

    got = fp.with_next(df.fillna({"text": ""}), "doc_id", carry, parts).collect()
    ordered = sorted(((i, t or "") for i, t in many), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = [(a[0], a[1], b[1]) for a, b in zip(ordered, ordered[1:] + ordered[:1])]
    assert sorted(map(repr, [(r.doc_id, r.text, r.next_text) for r in got])) == sorted(map(repr, want))


def test_next_document(spark):
    many = rows()
    for parts in (1, 2, 7, 300):
        check(spark, many, parts)
    check(spark, [(1, "only")], 5)
    check(spark, [(None, "b"), (None, "a"), (5, "x"), (5, "x"), (2, "z"), (5, "c")], 4)
    check(spark, [(None, "b"), (None, "a")], 4)


def test_compare(spark):
    many = rows()
    got = {r.doc_id: r for r in fp.compare(spark.createDataFrame([(*r, "x") for r in many], "doc_id long, text string, own string")).collect()}
    ids = sorted((i for i, _ in many), reverse=True)
    text = {i: t or "" for i, t in many}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        r, half = got[i], len(text[i]) // 2
        edited = text[i][: len(text[i]) - half] + text[j][:half]
        assert r.n_chars == len(text[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text[i]), shingles(edited)
        if len(a) > 300:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.15
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[3 * 7].fingerprint == got[64 * 7].fingerprint != got[4 * 7].fingerprint and got[65 * 7].near_next == 1


def test_sketches_merge_and_contain(spark):
    words = [f"t{i}" for i in range(4000)]
    df = spark.createDataFrame([(" ".join(words[:300]), " ".join(words))], "a string, b string")
    df = fp.sketch(fp.sketch(df, F.col("a"), "sa"), F.col("b"), "sb")
    r = df.select(fp.containment(F.col("sa"), F.col("sb")).alias("in"), (F.size(fp.merge(F.col("sa"), F.col("sb"))) == F.size("sb")).alias("same"), F.size("sb").alias("n")).first()
    assert r["in"] == 1 and r.same and abs(r.n - 999) < 120


def test_empty_and_native(spark, capsys):
    df = fp.compare(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == []
    df.explain()
    assert "Python" not in capsys.readouterr().out


def test_merge_is_the_sketch_of_the_union(spark):
    top = fp.POSITIVE
    low, high, higher = [5, 9], [top - 3], [top - 2]
    rows = [(low, high, low), (high, higher, high), (high, [], high), ([], [], []), (low, [9, 7], [5, 7, 9])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, want array<bigint>")
    assert all(r.got == r.want for r in df.select("want", fp.merge(F.col("a"), F.col("b")).alias("got")).collect())
