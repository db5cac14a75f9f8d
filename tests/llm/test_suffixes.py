import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablecraft.llm import queries, suffixes
from tablecraft.llm.frames import KEY, text_key

W = suffixes.WIDTH


def brute_force(texts):
    """(n_removed, n_spans, hash of the rest) per text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(hash(t[i:i + W]) for t in raw for i in range(len(t) - W + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - W + 1):
            if seen[hash(t[i:i + W])] > 1:
                gone[i:i + W] = b"\1" * W
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check(spark, df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    cut = suffixes.removed(df)
    whole = df.select("doc_id", F.coalesce("text", F.lit("")).alias("own"), *text_key("doc_id", "text"))
    got = [(r.doc_id, r.n_removed or 0, r.n_spans or 0, r.kept_sha256 or hashlib.sha256(r.own.encode()).hexdigest())
           for r in whole.join(cut, KEY, "left").collect()]
    want = [(k, *x) for (k, _), x in zip(rows, brute_force([t for _, t in rows]))]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in cut.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed


def letters(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


@pytest.mark.parametrize("seed", range(2))
def test_passages_of_all_lengths(spark, seed):
    rng = random.Random(seed)
    passages = [letters(rng, n) for n in (380, 399, 400, 401, 417, 700, 1500)]
    rows = []
    for i in range(40):
        parts = [letters(rng, rng.randint(0, 500))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a:rng.randint(a, len(p))] if rng.random() < 0.5 else p, letters(rng, rng.randint(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[3][1]) for i in range(3)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_periodic_texts(spark):
    rows = [(1, "a" * 1000), (2, "ab" * 400), (3, "a" * 401), (4, "a" * 400), (5, "abc" * 200 + "x" + "abc" * 200), (6, "b" * 399)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_odd_documents(spark, odd_documents):
    check(spark, odd_documents)


def test_segments_of_a_long_text(spark):
    rng = random.Random(5)
    edge = suffixes._SEGMENT
    long = letters(rng, edge + 40_000)
    raw = long.encode()
    while len(raw[:edge].decode(errors="ignore").encode()) != edge:
        edge += 1
    at = len(raw[:edge].decode())
    rows = [(1, long), (2, long[at - 900:at + 1100]), (3, long[at - 300:at + 90] + "#" + long[at - 20:at + 500])]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_empty_table(spark):
    assert suffixes.removed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_flags_planted_passages_and_no_clean_document(spark, tmp):
    """Passages of over 50 words that documents share are lost from each of them and from
    no other; n_bytes is the length of the text and says nothing of that."""
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(7, 9))) for _ in range(n))

    passages = [words(n) for n in (55, 60, 90)]
    rows = [(i, f"{words(rng.randint(1, 200))}\n{passages[i % 3]}\n{words(rng.randint(1, 200))}") for i in range(30)]
    rows += [(100 + i, words(rng.randint(1, 300))) for i in range(30)] + [(200, None), (201, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: r for r in queries.op1_suffix_dedup(spark, tmp).collect()}
    assert {k: got[k].n_bytes for k in got} == {k: len(t or "") for k, t in rows}
    assert {k for k, r in got.items() if r.n_removed} == set(range(30))
    assert all(got[i].n_removed >= len(passages[i % 3]) and got[i].n_spans == 1 for i in range(30))
    want = {k: x for (k, _), x in zip(rows, brute_force([t for _, t in rows]))}
    assert {k: (r.n_removed, r.n_spans, r.kept_sha256) for k, r in got.items()} == want
