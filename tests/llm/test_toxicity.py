import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import arrays, toxicity
from tablecraft.llm.queries import QUERIES, held_out

CLEAN = "the of and river stone garden light paper window summer morning table".split()


def texts(rng, n, toxic):
    out = []
    for _ in range(n):
        w = [rng.choice(CLEAN) + rng.choice("abcdef") for _ in range(rng.randint(5, 80))]
        if toxic:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["Scoundrel", "villain"])
        out.append(" ".join(w))
    return out


def test_learns_from_positive_and_unlabelled_texts():
    rng = random.Random(0)
    unlabelled = texts(rng, 90, True) + texts(rng, 810, False)
    model = toxicity.fit(texts(rng, 150, True), unlabelled, 0.1)
    held = [t.encode() for t in texts(rng, 200, True) + texts(rng, 800, False)]
    score = np.concatenate([model.scores(held[i:i + 300]) for i in range(0, 1000, 300)])
    assert (score[:200] >= 0.7).mean() > 0.95 and (score[200:] >= 0.7).mean() < 0.02
    assert ((0 <= score) & (score <= 1)).all()


def test_risk_is_not_pushed_below_zero_by_the_unlabelled_toxic():
    # half of the unlabelled texts are toxic; a plain classifier against them would give up
    rng = random.Random(1)
    model = toxicity.fit(texts(rng, 150, True), texts(rng, 300, True) + texts(rng, 300, False), 0.5)
    assert (model.scores([t.encode() for t in texts(rng, 100, True)]) >= 0.7).mean() > 0.9


def test_grams_stay_inside_words_and_count_once():
    a, count = toxicity.grams([b"stupid stupid", b"", b"ab", "É é".encode()])
    assert count.tolist() == [len(set(a[:count[0]])), 0, 1, 1]
    b, _ = toxicity.grams([b"xx STUPID."])
    assert set(a[:count[0]]) < set(b)
    many = toxicity.grams([b"stupid"] * 9000)
    assert many[1].sum() == len(many[0]) == 9000 * count[0]


@pytest.mark.parametrize("positive, unlabelled, prior", [([], ["a"], 0.1), (["a"], [], 0.1), ([], [], 0.0), ([None, ""], [None], 0.5)])
def test_nothing_to_learn(positive, unlabelled, prior):
    score = toxicity.fit(positive, unlabelled, prior).scores([b"", b"any text"])
    assert score.shape == (2,) and ((0 <= score) & (score <= 1)).all()


def test_odd_documents(spark, odd_documents):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (None, 1), (8, None), (9, 0), (9, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd_documents, labels, held_out(F.col("id")))
    rows = odd_documents.select("text", toxicity.score("text", model).alias("s")).collect()
    assert len(rows) == odd_documents.count()
    by_text = {}
    for r in rows:
        assert 0 <= r.s <= 1
        assert by_text.setdefault(r.text or "", r.s) == r.s  # equal texts, and null like empty
    none = odd_documents.limit(0)
    assert none.select(toxicity.score("text", toxicity.train(none, labels.limit(0), F.lit(False)))).collect() == []


def test_query(spark, sf):
    out = QUERIES["op4_pu_toxicity"](spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.score >= 0.7)
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_held_out_accuracy(spark):
    big = "/root/testdata/sf0.1"
    scored = QUERIES["op4_pu_toxicity"](spark, big).where("held_out").join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id")
    rows = scored.select("toxic", "score").collect()
    toxic = np.array([r.score for r in rows if r.toxic == 1])
    clean = np.array([r.score for r in rows if r.toxic == 0])
    assert (toxic[:, None] > clean[None]).mean() > 0.9  # area under the curve
    assert (toxic >= 0.7).mean() > 0.6 and (clean >= 0.7).mean() < 0.03


def test_slices_do_not_matter():
    rng = random.Random(3)
    model = toxicity.fit(texts(rng, 60, True), texts(rng, 200, False) + texts(rng, 20, True), 0.1)
    sample = texts(rng, 50, True) + ["", None]
    one = model.scores(arrays.text_bytes(sample))
    apart = np.concatenate([model.scores(p) for _, p in arrays.slices(sample, 100)])
    assert np.allclose(one, apart)


def test_copies_are_sampled_in_proportion(spark, monkeypatch):
    samples = []
    monkeypatch.setattr(toxicity, "fit", lambda positive, unlabelled, prior: samples.append(unlabelled) or toxicity.Model(np.zeros(1), 0.0))
    for copied in ("one page", "another page"):
        rows = [(i, copied if i % 3 == 0 else f"text {i}") for i in range(6000)]
        labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
        toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.lit(False), max_unlabelled=600)
        assert len(samples[-1]) == 600
        assert 140 < samples[-1].count(copied) < 260  # 200 and five standard deviations
