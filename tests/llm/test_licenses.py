import random
import re

from orderloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base(text):
    words = WORD.findall((text or "").translate(LOW))
    places = [(k, label) for phrase, label in PHRASES.items() for p in [phrase.split()] for k in range(len(words)) if words[k : k + len(p)] == p]
    return len(words), len(places), min([k for k, _ in places], default=None), max([k for k, _ in places], default=None), ",".join(sorted({x for _, x in places}))


def texts():
    rng = random.Random(2)
    parts = ["MIT", "license", "licence", "mit", "Apache", "General", "public", "License", "\n", "-", "é", "a", "the", "mit.", "LICENSE,", "ſ", "GNU"]
    return [None, "", " ", "mit license", "MIT—License", "x mit license mit license", "general public license " * 300] + [
        rng.choice([" ", "  ", "."]).join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300)
    ]


def test_base_places_are_exact(spark):
    many = list(enumerate(texts())) + [(3, "mit license"), (None, "x")]
    got = licenses.report(spark.createDataFrame(many, "doc_id long, text string").withColumnRenamed("x", "y")).collect()
    assert len(got) == len(many)
    by = {r.doc_id: r for r in got}
    for i, text in many[:-2]:
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_edits_and_spans():
    text = "É. Released under the MIT-Licence; see the Apache  Lisense and GNU Genral Public Licens. Permision is herby granted, free of charge"
    n, found = licenses.find(text)
    assert {(m["label"], m["edits"]) for m in found} >= {("mit", 1), ("apache", 1), ("gpl", 2), ("mit", 2)}
    assert {text[m["start"] : m["end"]] for m in found} >= {"MIT-Licence", "Apache  Lisense", "Genral Public Licens"}
    assert not any(m["base"] for m in found)
    assert licenses.find("nothing to see in a public general store; permit licenses apply")[1] == []


def test_short_names_are_not_guessed():
    for text in ("a bad license", "hit license", "it license", "git license", "a mid license", "licensed under cd by nobody"):
        assert licenses.find(text)[1] == [], text
    for text, label in (("MIT licence", "mit"), ("mit lisense", "mit"), ("BSD licence", "bsd"), ("licenced under CC BY", "cc")):
        assert {m["label"] for m in licenses.find(text)[1]} == {label}, text


def test_seeds_lose_no_match():
    """Every word beginning where the pattern matches is among the candidates."""
    import regex

    for text in texts()[1:80]:
        stream = b" " + b" ".join(text.encode().translate(licenses.WORD_BYTES).split()) + b" "
        for notice, phrase, pieces, pattern in licenses._search(licenses.NOTICES):
            starts = licenses._starts(stream, len(phrase), pieces, notice.edits)
            for at in (m.end() for m in regex.finditer(b" ", stream)):
                if pattern.match(stream, at, at + len(phrase) + notice.edits + 1):
                    assert at in starts


def test_empty_table(spark):
    assert licenses.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
