import math

from orderloom.llm import mixing


def table(spark, n=4000):
    # The first source holds a third of the rows.
    return spark.createDataFrame([(i, f"text {i}", "en", "big" if i % 3 == 0 else f"s{i % 7}", 6) for i in range(n)], "doc_id long, text string, lang string, source string, n_chars long")


def test_weights_are_met(spark):
    df = table(spark)
    got = mixing.mix(df, {"big": 0.2, "s1": 0.5, "s2": 0.3}).collect()
    chars = {}
    for r in got:
        chars[r.source] = chars.get(r.source, 0) + len(r.text)
    whole = sum(chars.values())
    assert set(chars) == {"big", "s1", "s2"}
    assert abs(chars["s1"] / whole - 0.5) < 0.05 and abs(chars["big"] / whole - 0.2) < 0.05
    assert abs(whole / sum(len(f"text {i}") for i in range(4000)) - 1) < 0.1


def test_draws_invert_the_distribution(spark):
    """Each document's number of copies is the lowest k whose distribution function is above its uniform number."""
    import hashlib

    df = table(spark, 600)
    rate = {r.source: r.rate for r in mixing.rates(df, {"big": 0.05, "s1": 0.9, "s4": 0.05}).collect()}
    got = mixing.mix(df, {"big": 0.05, "s1": 0.9, "s4": 0.05}).collect()
    copies = {}
    for r in got:
        copies.setdefault(r.doc_id, []).append(r.copy)
    for r in df.collect():
        u = (int(hashlib.md5(f"7:{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p = 0, math.exp(-rate[r.source])
        total = p
        while rate[r.source] and total <= u:
            k += 1
            p *= rate[r.source] / k
            total += p
        assert sorted(copies.get(r.doc_id, [])) == list(range(k))
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "abc", "a"), (2, "", "b"), (3, "long " * 1000, "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, Copy string")
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key"] and got.count() >= 0
    assert mixing.mix(df.limit(0)).collect() == []


def test_large_rate_and_salted_join(spark, monkeypatch):
    rows = [(i, "x" * 100, "big") for i in range(3000)] + [(9999, "y", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(r.doc_id, r.copy) for r in mixing.mix(df, {"tiny": 0.01, "big": 0.99}).collect()}
    n = sum(1 for i, _ in want if i == 9999)
    assert abs(n - 3000) < 300
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert {(r.doc_id, r.copy) for r in mixing.mix(df, {"tiny": 0.01, "big": 0.99}).collect()} == want
