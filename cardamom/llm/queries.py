"""Registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.llm import oracle
from cardamom.llm._common import documents, ship
from cardamom.llm.license_scan import license_scan
from cardamom.llm.lm_scoring import lm_score
from cardamom.llm.mixing import mix
from cardamom.llm.packing import pack
from cardamom.llm.pii import KINDS, find_pii, span_text
from cardamom.llm.quality_classifier import classify
from cardamom.llm.quality_rules import quality_rules
from cardamom.llm.simhash import simhash_groups
from cardamom.llm.suffix_dedup import remove_repeats
from cardamom.llm.topk_search import topk_search

QUERIES: dict = {}
ORACLE: dict[str, str] = {
    "op1_quality_rules": oracle.quality_rules(),
    "op3_topk_search": oracle.topk_search(),
    "op4_license_scan": oracle.license_scan(),
}


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


@query
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search(vectors, F.col("vec_id") % 100 == 0)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(documents(spark, sf_dir))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in KINDS], base, span_text(F.concat("base_spans", "added_spans")).alias("spans"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "lang", F.col("quality_perplexity").alias("perplexity"), F.col("quality_threshold").alias("threshold"), F.col("quality_kept").alias("kept"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))
