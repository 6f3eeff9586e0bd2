import collections
import random
import re

from orderloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = collections.Counter(zip(words, words[1:], words[2:])), set()
    for k in range(len(words) - 2):
        if seen[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def texts():
    rng = random.Random(9)
    parts = ["a", "b", "the", "été", "🙂", "x#", "$$", "A", "\n", "\n\n", "\x0b", " ", "long"]
    many = [None, "", " \n ", "one", "one two", "a a a a", "a b a b a b", "word " * 3000, "\n".join(["same line"] * 40)]
    return many + [rng.choice([" ", "\n", "\t "]).join(rng.choice(parts) for _ in range(rng.randint(1, 150))) for _ in range(200)]


def test_base_counts(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows + [(None, "x", 1), (4, "one two", 1)], "doc_id long, text string, N_words int")
    got = rules.verdicts(df).collect()
    assert len(got) == len(rows) + 2
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
        assert not (r.base_failed and r.kept)


def test_policies_read_the_ledger_only(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, clean), (2, clean.upper()), (3, clean.replace(" ", "## ")), (4, "few"), (5, None)], "doc_id long, text string")
    ledger = rules.ledger(df)
    kept = {r.doc_id: r.kept for r in rules.apply(ledger).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}
    lax = rules.Policy("lax", 2, ("few_words",))
    assert {r.doc_id for r in rules.apply(ledger, lax).collect() if r.kept} == {1, 2, 3}
    assert rules.apply(ledger, lax).first().policy == "lax-2"
    counts = {r.rule: (r.failed, r.only, r.dropped) for r in rules.ablate(ledger).collect()}
    assert counts["few_words"] == (2, 2, 4) and counts["capitals"] == (1, 1, 4) and counts["symbols"] == (1, 1, 4)


def test_native_and_empty(spark, capsys):
    df = rules.verdicts(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == []
    df.explain()
    assert "Python" not in capsys.readouterr().out
