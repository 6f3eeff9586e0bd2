"""The registered queries of the training-data operators."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from orderloom.llm import bpe, fingerprints, interactions, licenses, mixing, neardup, pages, personal, quality, repeats, rules, secrets, whitening
from orderloom.llm.common import read
from orderloom.plans.registry import Query

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = Query(fn, sql)
        return fn

    return register


@query("op1_byte_bpe")
def op1_byte_bpe(spark, d):
    return bpe.digest(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op2_license_scan")
def op2_license_scan(spark, d):
    return licenses.report(read(spark, d, "documents"))


@query("op7_quality_rules")
def op7_quality_rules(spark, d):
    return rules.verdicts(read(spark, d, "documents"))


@query("op5_fingerprints")
def op5_fingerprints(spark, d):
    return fingerprints.compare(read(spark, d, "documents"))


@query("op6_mixing", mixing.SQL)
def op6_mixing(spark, d):
    return mixing.mix(read(spark, d, "documents"))


@query("op9_secret_scan")
def op9_secret_scan(spark, d):
    return secrets.report(read(spark, d, "documents"))


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark, d):
    return neardup.groups(read(spark, d, "documents"), words=4)


@query("op8_quality_classifier")
def op8_quality_classifier(spark, d):
    return quality.score(read(spark, d, "documents"), read(spark, d, "labels"))


@query("op10_html_extraction")
def op10_html_extraction(spark, d):
    table = read(spark, d, "pages")
    return pages.extract(table, pages.fit(table))


@query("op3_repeated_passages")
def op3_repeated_passages(spark, d):
    return repeats.report(read(spark, d, "documents"))


@query("op12_filter_interactions", interactions.SQL)
def op12_filter_interactions(spark, d):
    return interactions.audit(read(spark, d, "documents"), read(spark, d, "labels"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, d):
    return whitening.report(read(spark, d, "embeddings"))


@query("op13_personal_data")
def op13_personal_data(spark, d):
    table = read(spark, d, "documents")
    return personal.report(table, personal.fit(table))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
