import math
import random
import re
from collections import Counter

import pytest

from tablecraft.llm import ranked
from tests.llm.conftest import sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(docs, items, k):
    """(item, rank, id, score) by scoring every pair."""
    counts = [(i, Counter(split(t)), len(split(t))) for i, t in docs]
    n_docs, total = sum(1 for *_, n in counts if n), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counts:
            s = 0
            for t in split(text):
                if c[t]:
                    m = 25 + (75 * n * n_docs) // total
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if s:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return out


def check(spark, docs, items, k=10, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in ranked.search(d, i, k, **options).collect()]
    assert sorted(got, key=str) == sorted(brute_force(docs, items, k), key=str)


@pytest.mark.parametrize("shard", [7, 4096])
def test_equals_scoring_of_all_pairs(spark, shard):
    rng = random.Random(shard)
    rare = [f"w{i}" for i in range(400)]
    docs = [(i, sentence(rng, rng.randint(0, 60)) + " " + " ".join(rng.choice(rare) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    docs += [(1000 + i, docs[3][1]) for i in range(20)]  # ties
    items = [(i, sentence(rng, 5) + " " + " ".join(rng.choice(rare) for _ in range(4))) for i in range(25)]
    items += [(90, docs[3][1]), (91, None), (92, ""), (93, "Zz-top unknown"), (93, "the THE the w7")]
    check(spark, docs, items, shard=shard)
    check(spark, docs, items, k=1, shard=shard)


def test_odd_documents(spark, odd_documents):
    docs = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    items = [(1, "one two klm"), (2, "漢字 É ß"), (3, docs[9][1]), (None, "vw xyz"), (1, "one two klm")]
    check(spark, docs, items)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked, "_BLOCK_BYTES", 30)
    rng = random.Random(2)
    check(spark, [(i, sentence(rng, 30)) for i in range(30)], [(i, sentence(rng, 4)) for i in range(9)], k=3)


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(ranked, "_PART", 11)
    text = sentence(random.Random(6), 60) + " " + "x" * 50 + "-É1"
    parts = list(ranked.terms(text))
    assert len(parts) > 10 and [w.decode() for p in parts for w in p] == split(text)


def test_short_rounds(monkeypatch):
    """Scores after any number of rounds are those of all reads."""
    import numpy as np

    rng = np.random.default_rng(8)
    n, n_terms = 300, 12
    has = [np.sort(rng.choice(n_terms, rng.integers(0, n_terms + 1), replace=False)) for _ in range(n)]
    counts, term = np.array([len(x) for x in has]), np.concatenate(has)
    lists = ranked._Lists(rng.integers(12, 90, n), counts, term, rng.integers(1, 5, len(term)), n_terms, n, 40 * n)
    scores = np.zeros(n, np.int64)
    query, factor = np.array([1, 4, 5, 7, 11]), np.array([900, 3, 500, 0, 40])
    for t, w in zip(query, factor):
        np.add.at(scores, lists.doc[lists.cut[t]:lists.cut[t + 1]], w * lists.impact[lists.cut[t]:lists.cut[t + 1]])
    kth = np.sort(scores)[-10]
    for top in (1, 2, 500):
        monkeypatch.setattr(ranked, "_TOP", top)
        for floor in (0, int(kth), int(scores.max()) + 1):
            found, got = lists.search(query, factor, 10, floor)
            want = np.flatnonzero((scores >= max(kth, floor)) & (scores > 0))
            assert found.tolist() == want.tolist() and got.tolist() == scores[want].tolist()


def test_empty_tables(spark):
    some, none = [(1, "one two")], []
    check(spark, none, some)
    check(spark, some, none)
    check(spark, none, none)


def test_sorted_reads_stop_early():
    """A list's tail is not read once the best documents are settled."""
    import numpy as np

    n = 4000
    tf = np.ones(n, np.int64)
    tf[:20] = 50
    lists = ranked._Lists(np.full(n, 100), np.ones(n, np.int64), np.zeros(n, np.int64), tf, 1, n, 100 * n)
    read = []
    whole = ranked.arrays.expand
    ranked.arrays.expand = lambda s, m: read.append(int(m.sum())) or whole(s, m)
    try:
        found, _ = lists.search(np.array([0]), np.array([5]), 10, 0)
    finally:
        ranked.arrays.expand = whole
    assert set(found) == set(range(20)) and sum(read) < 200
