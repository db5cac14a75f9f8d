import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import fmindex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(texts, items, window):
    phrases = {}
    for name, text in items:
        w = words(text)
        for k in range(max(len(w) - window + 1, 1 if w else 0)):
            phrases.setdefault(tuple(w[k:k + window]), set()).add(name or "")
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                names = phrases.get(tuple(w[i:i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("seed", range(60))
def test_shard_equals_brute_force(seed):
    rng = random.Random(seed)
    items = [(str(i), " ".join(rng.choice("abcdÉ") for _ in range(rng.randint(0, 7)))) for i in range(rng.randint(0, 6))]
    texts = [" ".join(rng.choice("abCdÉZ.") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 8))]
    window = rng.choice([2, 3, 5])
    got = fmindex.search_shard([t.encode() for t in texts], fmindex.Phrases(items, window))
    assert [(int(a), int(b), sorted(c)) for a, b, c in zip(got.n_words, got.n_hit, got["items"])] == brute_force(texts, items, window)


def test_index_ranks_searches_and_locates():
    rng = np.random.default_rng(4)
    runs = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(20)]
    text = np.concatenate([np.r_[0, r] for r in runs] + [np.zeros(1, np.int64)]).astype(np.int64)
    index = fmindex.FMIndex(text, 3)
    for c in range(1, 4):
        i = np.arange(len(text) + 1)
        assert (index.rank(np.full(len(i), c), i) == np.r_[0, np.cumsum(index.bwt == c)]).all()
    for n in (1, 2, 4):
        phrase = rng.integers(1, 4, (10, n))
        lo, hi = index.search(phrase, np.full(10, n))
        for p, a, b in zip(phrase, lo, hi):
            want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def check(spark, docs, bench, window=10, **options):
    items = [tuple(r) for r in bench.select(F.col("item_id").cast("string"), "text").collect()]
    out = docs.select("doc_id", "text", fmindex.contamination("text", bench, window=window, **options).alias("f"))
    out = out.select("*", fmindex.without_spans("text", "f.spans").alias("rest"))
    rows = out.collect()
    want = brute_force([r.text for r in rows], items, window)
    assert [(r.f.n_words, r.f.n_hit, sorted(r.f["items"])) for r in rows] == want
    for r in rows:
        assert len(words(r.rest)) <= r.f.n_words and (r.rest is None) == (r.text is None)
        if not r.f.n_hit:
            assert r.rest == r.text
        elif len(words(r.text)) == r.f.n_hit:
            assert words(r.rest) == []


def test_odd_documents(spark, odd_documents):
    texts = [r.text for r in odd_documents.where("length(text) > 100").select("text").collect()]
    items = [(1, " ".join(words(texts[0])[5:40])), (1, " ".join(words(texts[0])[5:40])), (2, " ".join(words(texts[1])[:10])),
             (None, "one two"), (3, None), (4, "..."), (5, "漢字 É ß"), (6, "not there")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    check(spark, odd_documents, bench)
    check(spark, odd_documents, bench, window=3, block_bytes=200)  # several blocks of items


def test_empty_tables(spark, odd_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    check(spark, odd_documents, none)
    assert odd_documents.limit(0).select(fmindex.contamination("text", none)["n_hit"]).collect() == []
