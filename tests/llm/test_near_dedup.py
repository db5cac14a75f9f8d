import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import components, minhash


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1 if w else 0))}


def brute_force(rows, size):
    """{row index: (n_shingles, component)} by all pairs and flooding."""
    sets = [shingles(t, size) for _, t in rows]
    links = {i: [] for i in range(len(rows))}
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            links[i].append(j)
            links[j].append(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (len(sets[i]), min(ids) if ids and sets[i] else rows[i][0])
    return out


def check(spark, df, size=4):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    expected = sorted((str(rows[i][0]), n, str(c), rows[i][0] == c) for i, (n, c) in brute_force(rows, size).items())
    got = minhash.near_duplicates(df, shingle=size).collect()
    assert sorted((str(r.id), r.n_shingles, str(r.component), r.kept) for r in got) == expected


def test_odd_documents(spark, odd_documents):
    check(spark, odd_documents)


def test_chains_of_copies(spark):
    # copies of copies drift away from the first, so components are chains
    rng, rows = random.Random(1), []
    for g in range(4):
        words = [f"w{g}_{rng.randint(0, 500)}" for _ in range(60)]
        for _ in range(30):
            words = list(words)
            words[rng.randrange(len(words))] = f"n{rng.random()}"
            rows.append((rng.randint(0, 10**9), " ".join(words)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_blocks_of_a_large_group_keep_all_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_BLOCK", 300)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(50)] = f"n{rng.random()}"
        rows.append((i, " ".join(words)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).collect() == []
    assert minhash.survivors(df).collect() == []


def test_survivors_keep_columns_and_one_row_of_each_group(spark, odd_documents):
    out = minhash.survivors(odd_documents, shingle=4)
    assert out.columns == odd_documents.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids.count(5) == 1 and 6 not in ids and 7 not in ids and ids.count(12) == 1
    assert ids.count(None) == 1  # the row without id and text is linked with nothing


def test_band_values_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    sig = minhash.min_max(np.concatenate([a, b]), np.array([1000, 1000]), minhash.multipliers(256))
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.08


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: r for x, r in root.items() if x != r}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_query_equals_oracle_columns(spark, sf):
    from tablecraft.llm.queries import QUERIES

    out = QUERIES["op5_minhash_near_dedup"](spark, sf)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert out.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).count() == 0


def test_one_survivor_where_ids_repeat_or_are_missing(spark):
    rng = random.Random(12)
    page, other, *alone = [" ".join(f"{rng.choice('abcdef')}{rng.randint(0, 10 ** 6)}" for _ in range(200)) for _ in range(6)]
    rows = [(1, page), (1, page + " again"), (1, "once " + page), (7, page + " later"),  # a page crawled again under its id
            (None, other), (None, other + " tail"), (None, other + " tail"),  # near copies without any id
            (5, alone[0]), (5, alone[1]), (None, alone[2]), (None, alone[3]),  # no copies, though ids are equal
            (8, ""), (8, "!"), (None, None), (None, "?")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in minhash.survivors(df).collect()]
    pages = [r for r in got if r[1] and page in r[1]]
    assert len(pages) == 1 and pages[0][0] == 1
    assert len([r for r in got if r[1] and other in r[1]]) == 1
    assert sorted(map(str, got)) == sorted(map(str, [*pages, *[r for r in got if r[1] and other in r[1]], *rows[7:]]))
