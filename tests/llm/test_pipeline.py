import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from tablecraft.llm import bpe
import public_tokenizers


def test_stages_in_order_and_their_effects(spark, sf, tmp):
    first = docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        if name != "byte_bpe":
            assert docs.columns == first.columns
            assert docs.where("n_chars <> length(text)").isEmpty()
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert set(kept["line_dedup"]) == set(kept["toxicity"])
    assert set(kept["near_dedup"]) < set(kept["line_dedup"])
    assert set(kept["byte_bpe"]) == set(kept["decontamination"]) == set(kept["near_dedup"])
    for r in kept["byte_bpe"].values():
        assert r.decoded_sha256 == hashlib.sha256(kept["decontamination"][r.doc_id].text.encode()).hexdigest()
        assert r.n_tokens == len(r.ids)
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, run.collect())) == sorted(map(str, kept["byte_bpe"].values()))


def test_odd_documents_pass_every_stage(spark, sf, odd_documents):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd_documents.select(*columns)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() <= docs.count()
        docs = out if name != "byte_bpe" else docs
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).collect() == []


def test_stages_keep_other_columns(spark, sf, odd_documents):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_documents, sf).columns == odd_documents.columns, name


def test_decontamination_stage_cuts_passages(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 200").first().text
    docs = spark.createDataFrame([(1, f"Before it. {item} And after.", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.benchmark_passages_out(spark, docs, sf).first()
    assert out.text.startswith("Before it.") and out.text.endswith("And after.") and len(out.text) < 40
    assert out.n_chars == len(out.text)


def test_last_stage_ids_decode(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.token_ids(spark, docs, sf).join(docs, "doc_id")
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    assert out.where(bpe.decoded("ids", *where).cast("string") != F.col("text")).isEmpty()
