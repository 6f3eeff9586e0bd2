import random
import re

from orderloom.llm import neardup

LOW = str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows, words):
    sets = {i: shingles(t, words) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def families(seed):
    """Copies with edits around the limit, a passage that many share, short texts, a chain of small steps."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    out = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([4, 5, 6, 7, 8, 9, 12, 20, 60, 300]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    passage = [word() for _ in range(120)]
    for _ in range(40):
        own = [word() for _ in range(rng.choice([10, 40, 80, 120]))]
        out += [" ".join(passage + own)] + ([" ".join(passage + own + ["more"])] if rng.random() < 0.3 else [])
    chain = [f"c{i}" for i in range(100)]
    for i in range(30):
        out.append(" ".join(chain[i:] + [f"d{j}" for j in range(i)]))
    out += ["", None, "one", "One", "one two three", "one two three", "a b c d e", "a b c d e f", "a b c d", "b c d e"]
    rng.shuffle(out)
    return list(enumerate(out))


def test_components_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT_LIST", 6)  # so that long lists occur
    for seed, words in ((1, 4), (2, 5)):
        rows = families(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string"), words).collect()}
        assert got == brute(rows, words)


def test_small_sets_meet_in_a_run():
    """Any two sets of up to 12 shingles that are alike share a key: checked on the places of what is not shared."""
    for size in range(5, 13):
        for gone in range(size // 5 + 1):
            import itertools

            for lost in itertools.combinations(range(size), gone):
                for side in range(2**gone):
                    a = [i for i in range(size) if i not in lost or side >> lost.index(i) & 1]
                    b = [i for i in range(size) if i not in lost or not side >> lost.index(i) & 1]

                    def keys(s):
                        own = {tuple(s[i : i + 3]) for i in range(len(s) - 2)} if len(s) >= 5 else set()
                        return own | ({tuple(s[i : i + 2]) for i in range(len(s) - 1)} if len(s) in (4, 5) else set())

                    assert keys(a) & keys(b), (a, b)


def test_odd_rows(spark):
    same = " ".join(f"x{i}" for i in range(30))
    rows = [(5, same, 1), (3, same, 1), (3, same, 1), (None, same, 1), (None, None, 1), (9, "", 1)]
    got = sorted(neardup.groups(spark.createDataFrame(rows, "doc_id long, text string, Node int")).collect(), key=str)
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got] == sorted([(3, 26, 3, True), (3, 26, 3, True), (5, 26, 3, False), (9, 0, 9, True), (None, 0, None, True), (None, 26, None, True)], key=lambda r: f"Row(doc_id={r[0]}, n_shingles={r[1]}")
    assert neardup.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def brute_rows(rows, words):
    """Component of every row where sets, not doc_ids, are linked."""
    sets = sorted({shingles(t, words) for i, t in rows if i is not None and shingles(t, words)}, key=lambda s: sorted(map(str, s)))
    group = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    of = dict(zip(sets, group))
    low = {}
    for i, t in rows:
        if i is not None and shingles(t, words):
            g = of[shingles(t, words)]
            low[g] = min(low.get(g, i), i)
    return [(i, low[of[shingles(t, words)]] if i is not None and shingles(t, words) else i) for i, t in rows]


def test_texts_that_share_a_doc_id(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT_LIST", 6)
    rng = random.Random(4)
    rows = [(rng.choice([None, 7, 7, 7, rng.randint(0, 60)]), t) for _, t in families(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in neardup.groups(df).collect())
    assert got == sorted((str(a), str(b)) for a, b in brute_rows(rows, 5))


def test_no_text_is_lost_with_its_doc_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (6, b, "z"), (8, a + " end", "z"), (8, None, "n"), (None, a, "n"), (9, b, "z"), (9, b, "z")]
    df = spark.createDataFrame(rows, "doc_id int, text string, _KEY2 string")
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, a, "x"), (5, b, "z"), (8, None, "n"), (None, a, "n")], key=str)
    twins = spark.createDataFrame([(4, a), (4, a + " end"), (4, a)], "doc_id long, text string")
    assert {r.text for r in neardup.keep_one(twins).collect()} in ({a}, {a + " end"})


def test_links_added_to_known_components(spark):
    from orderloom.llm.common import Workspace
    from orderloom.operators.components import connected_components

    rng = random.Random(6)
    first = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(90)]
    more = [(rng.randint(0, 260), rng.randint(0, 260)) for _ in range(40)]
    frame = lambda pairs: spark.createDataFrame([(min(p), max(p)) for p in pairs if p[0] != p[1]], "a long, b long")
    rows = lambda df: sorted(map(tuple, df.collect()))
    space = Workspace(spark, "test")
    labels = space.keep(connected_components(frame(first)), "labels")
    whole = rows(connected_components(frame(first + more)))
    assert rows(neardup._joined(labels, frame(more), space)) == whole and len(whole) > len(rows(labels))
    assert rows(neardup._joined(labels, frame([(0, 0)]), space)) == rows(labels)
    assert rows(neardup._joined(labels.limit(0), frame(more), Workspace(spark, "test"))) == rows(connected_components(frame(more)))
