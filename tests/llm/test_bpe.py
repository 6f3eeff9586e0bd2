import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from orderloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary(PATH).ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    odd = list("ab'stmdrevl  \n\t\r\xa0　\x1c1٣²é漢🙂!?'`\0") + ["'re", "'ll", "'LL", " '", "\n'", "  "]
    made = ["", " ", "  ", "\n", "a", "'", "'s", "''s", "x's's", " 's", "\n's", "1'll'", "don't  stop\n\n now", "a" * 5000, " " * 3000, "<|endoftext|>"]
    return made + ["".join(rng.choice(odd) for _ in range(rng.randint(1, 700))) for _ in range(300)]


def test_as_the_library(library):
    words = bpe.Vocabulary(PATH)
    many = texts()
    for text, ids in zip(many, words.encode(many)):
        assert ids.tolist() == library.encode_ordinary(text), repr(text[:80])
        assert words.decode(ids, np.cumsum(words.lengths[ids]) - words.lengths[ids]) == text.encode()


def test_scan_is_the_sequential_run():
    first, _, reached, _ = bpe.automaton()
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 9, 70_001)
    state, want = 0, []
    for x in symbols:
        state = bpe._step(state, int(x))[0]
        want.append(state)
    assert reached[:, 0][bpe._scan(first[symbols])].tolist() == want


def test_digest(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(texts()[:60])] + [(1000, None, "x"), (None, "no id", "x"), (3, "again", "x"), (3, "again", "x")]
    got = bpe.digest(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids := library.encode_ordinary(t or "")), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())) for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(spark):
    assert bpe.digest(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_one_pass_is_encode_and_decode(spark):
    rows = [(i, t, "clash", "kept") for i, t in enumerate([*texts()[:40], None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string, other string")
    one = bpe.round_trip(df, PATH)
    assert one.columns == ["doc_id", "other", "ids", "decoded"]
    two = bpe.decode(bpe.encode(df, PATH), PATH).select(one.columns)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
