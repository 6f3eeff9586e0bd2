import collections
import hashlib
import random

from orderloom.llm import repeats


def brute(texts):
    """Removed runs of each text, by counting every string of LENGTH bytes."""
    size, raws = repeats.LENGTH, [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + size] for r in raws for i in range(len(r) - size + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("etaoin shrdlué ") for _ in range(n))
    passages = [prose(rng.choice([380, 395, 399, 400, 401, 405, 430, 500, 700, 1500])) for _ in range(14)]
    out = [None, "", "short", prose(399), prose(400), "a" * 399, "b" * 900, "ab" * 700, "x" + "ab" * 300, "line of text\n" * 90]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += [prose(rng.randint(0, 700)), rng.choice(passages)]
        out.append("".join(parts)[rng.randint(0, 300) :])
    for t in list(out[12:30]):  # near copies
        if len(t) > 20:
            i = rng.randrange(len(t))
            out.append(t[:i] + rng.choice(["", "#", "##"]) + t[i + 1 :])
    return out + [out[15], out[15]]


def digest(spark, rows):
    df = repeats.report(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_against_all_strings(spark, monkeypatch):
    for seed in (1, 2):
        many = texts(seed)
        want = sorted(((i, *w) for i, w in enumerate(brute(many))), key=str)
        assert digest(spark, list(enumerate(many))) == want
    monkeypatch.setattr(repeats, "BROADCAST_KEYS", 3)  # the joins by a shuffle
    assert digest(spark, list(enumerate(many))) == want


def test_odd_rows(spark):
    long = "".join(random.Random(3).choice("abcdefgh ") for _ in range(900))
    rows = [(1, long), (1, long), (None, long + "!"), (2, None)]
    assert digest(spark, rows) == sorted(((i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows]))), key=str)
    got = repeats.strip(spark.createDataFrame([(1, long, "x"), (2, "a" + long, "y")], "doc_id long, text string, Kept string"))
    assert got.columns == ["doc_id", "text", "spans", "kept"]
    assert {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept)) for r in got.collect()} == {1: ([(0, 900)], b""), 2: ([(1, 901)], b"a")}
    assert digest(spark, []) == []
