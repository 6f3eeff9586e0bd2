"""From documents to training tokens: quality, near duplicates, secrets, mixture, byte-level BPE.

Each stage takes and returns whole documents (doc_id, text, lang, source, n_chars); its decisions take effect in what it
returns, and the last one returns the tokens.  Null and empty texts, repeated rows and empty tables pass through every
stage as its operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe, mixing, neardup, quality, secrets
from orderloom.llm.common import Workspace, read

VOCABULARY = "byte_bpe_50k.tiktoken"
#: SQL cannot express the classifier, the sketches or the merges; tests compare the stages with brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels``, does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the lowest doc_id, of every group of near duplicates (five words, 0.8)."""
    return neardup.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and n_chars as the text now is."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))) if "n_chars" in docs.columns else masked


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture's Poisson draws say, in random order."""
    return mixing.mix(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256) of every document of the mixture."""
    made = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return made.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", bpe.ids_sha256().alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", distinct_documents),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    space = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = space.keep(docs, f"stage_{i}")
    return docs
