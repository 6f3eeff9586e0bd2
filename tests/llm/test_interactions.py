import random
import re
from collections import Counter
from itertools import permutations

from orderloom.llm import interactions

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """Every order is applied to every document, one filter after the other."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    out, shapley = {}, Counter()
    for doc, text, source in rows:
        t, part = text or "", source or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": doc is not None and any((u or "") == t and d is not None and d < doc for d, u, _ in rows),
        }
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                cell = out.setdefault((part, order, step), Counter())
                lost = fails[f] and not gone
                cell.update(kept=not gone and not fails[f], removed=lost, redundant=fails[f] and gone, unique_fails=fails[f] and sum(fails.values()) == 1, good_lost=lost and doc in good, toxic_lost=lost and doc in toxic)
                shapley[part, f] += lost
                gone |= fails[f]
    return {(*k, *(int(c[x]) for x in interactions.OUTCOMES), shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def table():
    rng = random.Random(2)
    long = lambda pool, n: " ".join(rng.choice(pool) for _ in range(n))
    many = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n\x0b", "a" * 50_000, "é " * 300, long(many, 900), long(many, 250) + " #", long(many, 250).upper(), "x|y", long(many, 100_000)]
    texts += [long(many, rng.choice([150, 250])) + rng.choice(["", "", "$", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3]) for _ in range(12)]
    rows = [(i, t, rng.choice(["s", "s", "t", None, ""])) for i, t in enumerate(texts)]
    rows += [(100 + i, rng.choice(texts), rng.choice(["s", "u"])) for i in range(15)]
    rows += [rows[5], rows[5], (5, "other", "s"), (None, texts[6], "t"), (None, texts[6], None), (3, texts[6], None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(115)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    return rows, labels


def test_every_order_against_brute_force(spark):
    rows, labels = table()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, PART int, mask int")
    got = interactions.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", *interactions.OUTCOMES, "shapley"]
    made = [tuple(r) for r in got.collect()]
    assert len(made) == len(set(made)) and set(made) == brute(rows, labels)


def test_fields_do_not_run_over():
    big = 2**62
    cells = interactions.unpacked(big * interactions.packed(0b00101, True, False) + interactions.packed(0b10000, False, True))
    assert cells[0, 0, 1] == big and cells[0, 0, 4] == big and cells[0, 0, 5] == 0  # order ABCDE, step A
    assert cells[0, 2, 2] == big and cells[0, 4, 1] == 1 and cells[0, 4, 3] == 1 and cells[0, 3, 0] == 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert interactions.audit(docs, spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")).collect() == []
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert interactions.audit(one, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 600
