import random
import zlib

import numpy as np

from orderloom.llm import quality


def corpus(n=1500):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice(['tion', 'ing', 'er', 'an'])}{rng.randint(0, 30)}" for _ in range(rng.randint(60, 300))]
        good = rng.random() < 0.8
        if not good:
            words = rng.choice([lambda w: [x + "###" for x in w], lambda w: [x.upper() + "!!" for x in w], lambda w: w[:2] * (len(w) // 2)])(words)
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = quality.score(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, X string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [(by[i].predicted, q) for i, q in labels if by[i].held_out]
    assert sum(p == q for p, q in unseen) / len(unseen) > 0.95


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(400)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    scores = [{r.doc_id: r.score for r in quality.score(df, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned)]
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-9 for i in scores[0])


def test_pooling():
    total, good = np.array([1.0, 1, 1, 1, 2]), np.array([0.0, 1, 0, 1, 2])
    assert quality.pooled(total, good).tolist() == [0, 0.5, 0.5, 1, 1]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, ""), (3, "word " * 20000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score(df, none).collect()] == [0.5] * 5
    one = spark.createDataFrame([(i, 1) for i in range(1, 4)] + [(None, 1), (1, None)], "doc_id long, quality int")
    assert {r.score for r in quality.score(df, one).collect()} == {1.0}
    assert quality.score(df.limit(0), one).collect() == []
    rows, labels = corpus(400)
    both = spark.createDataFrame(rows + [(9999, None), (9999, None)], "doc_id long, text string")
    assert quality.score(both, spark.createDataFrame(labels, "doc_id long, quality int")).count() == 402
