"""The queries of this package: key -> build function, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from heronlake.llm import (chat, jaccard, langid, lines, lzprint, merkle, mixing, packing, secretscan, spelling,
                           suffixes, topk, toxicity)
from heronlake.session import prepare
from heronlake.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return register


@query("op1_toxicity")
def toxicity_scores(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_lz_fingerprint")
def lz_fingerprints(spark, sf_dir):
    return lzprint.edit_test(table(spark, sf_dir, "documents"))


@query("op3_chat_formatting", chat.SQL)
def chat_formatting(spark, sf_dir):
    return chat.read_back(chat.format_turns(chat.with_probe(spark, table(spark, sf_dir, "conversations"))))


@query("op4_exact_topk", topk.SQL)
def exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


@query("op5_source_mixing", mixing.SQL)
def source_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_line_dedup", lines.SQL)
def line_dedup(spark, sf_dir):
    return lines.dedup(table(spark, sf_dir, "documents"))


@query("op7_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_ngram_jaccard")
def ngram_jaccard(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op10_suffix_dedup")
def suffix_dedup(spark, sf_dir):
    return suffixes.dedup(table(spark, sf_dir, "documents"))


@query("op11_secret_scan", secretscan.SQL)
def secret_scan(spark, sf_dir):
    return secretscan.digest(secretscan.find(table(spark, sf_dir, "documents")))


@query("op12_spelling_variants", spelling.SQL)
def spelling_variants(spark, sf_dir):
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", merkle.SQL)
def merkle_manifest(spark, sf_dir):
    return merkle.prove(table(spark, sf_dir, "documents"))
