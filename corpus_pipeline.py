"""Corpus pipeline: the stages a crawl goes through before training.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame that is written and read again before the next one. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import bpe, fmindex, linededup, minhash, toxicity
from tablecraft.llm.frames import stored, table
from tablecraft.llm.queries import held_out


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text and its length."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out(F.col("id")))
    return docs.where(toxicity.score("text", model) < 0.7)


def boilerplate_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat and that 2 % or more of their source's distinct pages have go."""
    out = linededup.drop_boilerplate(docs, "source", "text", ratio=0.02, min_pages=2)
    return _with_text(out, F.col("text"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return minhash.survivors(docs)


def benchmark_passages_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten or more words that occur in the benchmark are cut out."""
    found = fmindex.contamination("text", table(spark, sf_dir, "benchmark"), window=10)
    return _with_text(docs, fmindex.without_spans("text", found["spans"]))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the bytes they decode to."""
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = docs.select("doc_id", bpe.round_trip("text", *where).alias("t"))
    return out.select(
        "doc_id",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.col("t.ids").alias("ids"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxic_documents_out),
    ("line_dedup", boilerplate_lines_out),
    ("near_dedup", near_copies_out),
    ("decontamination", benchmark_passages_out),
    ("byte_bpe", token_ids),
]

#: The toxicity stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
