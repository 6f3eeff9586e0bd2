import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import personal

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = [int(c) for c in digits[::-1]]
    return sum(c if i % 2 == 0 else sum(divmod(2 * c, 10)) for i, c in enumerate(odd)) % 10 == 0


def base(text):
    found = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(re.sub("[ -]", "", m[0])) <= 19 and luhn(re.sub("[ -]", "", m[0]))]
    return found + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def texts():
    rng = random.Random(7)
    parts = ["a", "b.c", "@", "@x.y", "@h-1.com", ".", "..", "%", "_", " ", "-", "é🙂", "\n", "+", "+1", "(", ")", "0", "00", "7", "255", "256", "1.2.3.4", "012.7.0.1", "4111111111111111", "4111 1111-1111 1111", "٣", "5" * 12, "+48 123 456 789", "1 2", "x@y"]
    fixed = ["", "a@b.c_d@e.f", "a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "0001.0.0.0255", "+12", "+1 2", "+123", "+1(((((2", "+1 23456789 ()", "1-2-3-4", "1--2", "+1+1 2345678901", "4111111111111111 4111111111111111", "0" * 16]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(500)] + ["1.2.3.4 a@b.cc 4111111111111111 +1 (234) 555-0000, " * 300]


def check(spark, rows, model=None):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in personal.report(df, model).collect()}
    for i, text in rows:
        found = base(text or "")
        want = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in found)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(f[0] == k for f in found) for k in range(4))
        kept = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in personal.KINDS[: personal.PLAIN])
        assert kept == want and (model is not None or r.spans == want)
    return got


def test_plain_spans(spark):
    check(spark, [*enumerate(texts()), (9000, None)])


def test_long_texts_take_linear_time(spark):
    long = ["1" * 300_000, "a" * 300_000, "a@" + "b" * 300_000, "1." * 100_000, "+1" + " " * 200_000, "x.y@" * 20_000, "1 " * 100_000, "a at b " * 20_000, "ab:" * 50_000, "AB12" + "C" * 200_000]
    df = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    got = {r.doc_id: r for r in personal.report(df, personal.Model(((1.0, (0, 0.5, -1.0, -1.0)),), (0.5,) * 5)).collect()}
    # The simple forms take the square of the length, so what they find here is stated.
    assert {i: (r.n_email, r.n_ip, r.n_card, r.n_phone) for i, r in got.items() if r.spans} == {3: (0, 25_000, 0, 0), 5: (10_000, 0, 0, 0)}


def test_places(spark):
    text = "é12 " * 300 + "7"
    got = spark.createDataFrame([(text,)], "t string").select(personal._places(F.col("t"), "[0-9]+", 2).alias("p")).first().p
    assert [(p.start, p.end, p.match) for p in got] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
    assert got[1].before == " é" and got[0].after == " é" and got[-1].after == "" and {p.kind for p in got} == {2}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(120))) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string"), words


@pytest.fixture(scope="module")
def model(corpus):
    return personal.fit(corpus[0])


def test_trees_find_what_the_plain_patterns_miss(spark, corpus, model):
    rng, words = random.Random(3), corpus[1]
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))

    def account():
        body = d(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    private = {
        "local_phone": lambda: (some(9) + " call me at ", f"({d(3)}) {d(3)}-{d(4)}"), "national_id": lambda: (some(9) + " SSN ", f"{d(3)}-{d(2)}-{d(4)}"),
        "iban": lambda: (some(9) + " IBAN: ", account()), "written_email": lambda: (some(9) + " write to ", f"{rng.choice(words)}.{rng.choice(words)} at {rng.choice(words)} dot com"),
    }
    clean = [lambda: f"order {d(9)} of 2021-0{rng.randint(1, 9)}-1{d(1)}", lambda: f"look at {rng.choice(words)}. then", lambda: f"version 1.{d(1)} of {d(16)}", lambda: f"at 1{d(1)}:2{d(1)}:30", lambda: f"pages 1{d(3)}-1{d(3)}"]
    rows, want = [], {}
    for k, make in private.items():
        for _ in range(40):
            before, value = make()
            want[len(rows)] = f"{k}:{len(before)}:{len(before) + len(value)}"
            rows.append((len(rows), f"{before}{value} {some(9)}"))
    first_clean = len(rows)
    rows += [(first_clean + i, f"{some(9)} {rng.choice(clean)()} {some(9)}") for i in range(200)]
    got = check(spark, rows, model)
    for k in private:
        mine = [i for i, s in want.items() if s.startswith(k)]
        assert sum(want[i] in got[i].spans.split(",") for i in mine) >= 0.9 * len(mine), k
    wrong = [rows[i][1] for i in range(first_clean, len(rows)) if got[i].n_more]
    assert len(wrong) <= 4, wrong


def test_plain_spans_stay_beside_the_trees(spark, model):
    check(spark, list(enumerate(texts())), model)


def test_redaction(spark, model):
    rows = [(1, "É mail a@b.cc end", "k"), (2, None, "k"), (3, "clean", "k"), (4, "call me at (555) 123-4567, 4111111111111111", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = personal.redact(df, model)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "É mail [EMAIL] end", 2: None, 3: "clean", 4: "call me at [LOCAL_PHONE], [CARD]"}


def test_the_expression_is_the_model(spark):
    node = (1, 0.5, (0, 2.0, -1.0, 3.0), 7.0)
    m = personal.Model(((1.0, node), (0.5, (0, 0.0, 1.0, 2.0))), ())
    got = spark.createDataFrame([([1.0, 0.0],), ([3.0, 0.5],), ([0.0, 1.0],)], "f array<double>").select(m.margin(F.col("f")).alias("m")).collect()
    assert [r.m for r in got] == [0.0, 4.0, 7.5]


def test_thresholds():
    assert personal._threshold([]) is None and personal._threshold([(10, 5, 1)]) is None
    assert personal._threshold([(10, 10, 1), (60, 10, 8), (70, 10, 10), (80, 1, 0.95)]) == pytest.approx(personal._edge(70))
    assert personal._threshold([(5, 10, 10)]) == 0.0


def test_nothing_to_teach_with(spark, capsys):
    empty = spark.createDataFrame([], "doc_id long, text string, FOUND int")
    assert personal.fit(empty) is None and personal.report(empty, None).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    assert personal.fit(blank) is None and {r.spans for r in personal.report(blank, None).collect()} == {""}
    node = (0, 0.5, -1.0, 1.0)
    personal.scan(empty, personal.Model(((1.0, node),), (0.5,) * 5)).explain()
    assert "Python" not in capsys.readouterr().out


def test_every_text_is_covered_by_its_places(spark):
    rng = random.Random(5)
    length = [3, 119, 240, 241, 900, 1920, 2000, 5000] + [rng.randint(20, 60) for _ in range(2500)]
    texts = ["".join(rng.choice("ab é\n🙂") for _ in range(n)) for n in length]
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:50])], "doc_id long, text string")
    places = [max(personal.PLACES, -(-len(t) // (2 * personal.WINDOW))) for t in texts]
    rows = personal._examples(df, "text").collect()
    assert len(rows) == sum(places)  # of 2,508 texts, copies apart
    hosts = collections.Counter()
    marks = {t[-15:]: i for i, t in enumerate(texts[:8])}
    for r in rows:
        assert 0 < r["from"] < r.until < len(r.planted) and r.planted[r.until] == " "
        for tail, i in marks.items():
            hosts[i] += r.planted.endswith(tail) or tail in r.planted[: r["from"]]
    assert all(hosts[i] for i in range(1, 8))  # the end of each text is in a place of it


def test_splits_are_sought_in_all_rows():
    for rows in (0, 1, 1024, 1025, 10_000, 10_001, 999_999, 1_000_000, 1_000_001):
        assert personal._bins_for(rows) ** 2 >= rows and personal._bins_for(rows) >= 32
    assert personal._bins_for(1_000_000) == 1000 and personal._bins_for(1_000_001) == 1001
