import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from orderloom.llm import bpe

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    root = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    for i in range(500):
        words = [f"{rng.choice('abcdefgh')}{rng.choice(['tion', 'ing', 'er', 'an'])}{rng.randint(0, 300)}" for _ in range(rng.randint(80, 200))]
        bad = i % 7 == 0
        text = " ".join(w + "###" if bad else w for w in words) + (" token=abcdefgh1234" if i % 10 == 1 else "")
        rows.append((i, text, "en", "big" if i % 3 else f"s{i % 4}", len(text)))
        labels += [(i, int(not bad), 0)] * (i % 2)
    rows += [(1000 + i, rows[i][1] + " tail", "en", "copies", rows[i][4] + 5) for i in range(0, 500, 5)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(docs.collect())
    good, single, masked, mixed = seen
    assert {r.doc_id for r in good} == {i for i, t in before.items() if "###" not in t}
    assert {r.doc_id for r in single} == {r.doc_id for r in good if r.doc_id < 1000}
    assert {r.doc_id: r.text for r in masked} == {r.doc_id: r.text.replace("token=abcdefgh1234", "[SECRET]") for r in single}
    assert all(r.n_chars == len(r.text) for r in masked)
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in masked} and 0.7 < len(mixed) / len(masked) < 1.3
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks, special_tokens={})
    text = {r.doc_id: r.text for r in mixed}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in mixed)
    for r in last:
        assert list(r.ids) == library.encode_ordinary(text[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in last)


def test_empty_and_odd_tables(spark, folder):
    empty = spark.createDataFrame([], COLUMNS)
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "x", "en", "a", 1), (2, "", "", "a", 0)], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == [], name
        assert stage(spark, odd, folder).count() >= 0, name


def test_a_batch_is_bounded_by_its_bytes(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from orderloom.llm import common

    rows = spark.range(0, 9000, 1, 1).select("id", F.repeat(F.lit("ab c"), 500).alias("text"))
    sizes = lambda b: pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])
    got = common.arrow_map(rows, sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 9000 and max(r.bytes for r in got) < 1.1 * common.BATCH_BYTES
    long = spark.range(0, 3, 1, 1).select(F.repeat(F.lit("ab c"), common.BATCH_BYTES // 2).alias("text"))
    assert [(r.n, r.bytes > common.BATCH_BYTES) for r in common.arrow_map(long, sizes, "n long, bytes long").collect()] == [(1, True)] * 3


def test_small_tables_of_components_are_few_files(spark):
    import glob

    from orderloom.operators.components import connected_components
    from orderloom.session import shared_folder

    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        shared_folder(spark)
        parts = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*/part-*"
        before = len(glob.glob(parts))
        chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
        got = {tuple(r) for r in connected_components(chain).collect()}
        assert got == {(i, 0) for i in range(61)}
        assert 0 < len(glob.glob(parts)) - before < 2 * 40  # the edges, and a file a round
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_components_end_with_the_round_that_makes_stars(spark):
    import glob

    from orderloom.operators.components import connected_components
    from orderloom.session import shared_folder

    shared_folder(spark)
    folders = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*"

    def rounds(pairs, by=()):
        schema = ", ".join(f"{c} long" for c in (*by, "a", "b"))
        before = set(glob.glob(folders))
        got = {tuple(r) for r in connected_components(spark.createDataFrame(pairs, schema), by=list(by)).collect()}
        return got, len(set(glob.glob(folders)) - before) - 1  # one holds the edges

    stars = [(0, i) for i in range(1, 30)] + [(100, i) for i in range(101, 110)] + [(50, 50)]
    assert rounds(stars) == ({(b, a) for a, b in stars} | {(0, 0), (100, 100)}, 0)  # two rounds before
    assert rounds([]) == (set(), 0)
    got, made = rounds([(i, i + 1) for i in range(40)] + [(5, 39)])
    assert got == {(i, 0) for i in range(41)} and made > 0
    # The same node below different nodes of two keys is no fault of either.
    assert rounds([(1, 0, 5), (2, 3, 5), (2, 3, 0)], ["at"]) == ({(1, 0, 0), (1, 5, 0), (2, 0, 0), (2, 3, 0), (2, 5, 0)}, 1)
