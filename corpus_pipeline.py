"""The corpus pipeline: from documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of documents, and further ones of the input, whatever their names; run() writes each
stage's rows to the shared folder and reads them again for the next. Null and empty texts are documents without
words: quality keeps them, near_duplicates keeps one of them, and each is packed as an end token. Rows without doc_id
are documents like any other. Unlike texts under one doc_id are different documents; the same row several
times is one. Very long texts are read whole. An empty table gives an empty result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, documents, free, ship, tasks_for
from cardamom.llm.mixing import RESERVED, mix
from cardamom.llm.packing import pack
from cardamom.llm.pii import redact
from cardamom.llm.quality_classifier import classify
from cardamom.llm.simhash import one_of_each

#: No stage can be written in SQL: tests hold each stage, on what its predecessor gave, against a brute-force version.
ORACLE_SQL = None
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; it learns from the labels of the same folder."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    prefix = "_quality_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return classify(docs, labels, prefix=prefix).filter(f"{prefix}kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group whose texts share 0.8 of their five-word shingles."""
    ship(spark)
    return one_of_each(docs).coalesce(tasks_for(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars is counted anew."""
    ship(spark)
    out = redact(docs).coalesce(tasks_for(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    ship(spark)
    others = tuple(c for c in docs.columns if c != "doc_id")
    mixed = mix(docs, carry=others).filter("copies > 0")
    mixed = mixed.withColumn(free(mixed, "_copy"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return mixed.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"c_{c}" if c in RESERVED else c).alias(c) for c in docs.columns]).coalesce(tasks_for(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    ship(spark)
    pieces = pack(docs, public_tokenizers.path(TOKENIZER), memory=200_000)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        held = Staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:  # its rows have been read
            before.drop()
        docs, before = held.read(), held
    return STAGES[-1][1](spark, docs, sf_dir)
