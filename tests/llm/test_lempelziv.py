import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tablecraft.llm import lempelziv as lz

W = lz.WIDTH


def brute_force(texts):
    """(n_words, n_removed, hash of the rest) per text."""
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(t[i:i + W]) for t in words for i in range(len(t) - W + 1))
    out = []
    for t in words:
        gone = bytearray(len(t))
        for i in range(len(t) - W + 1):
            if seen[tuple(t[i:i + W])] > 1:
                gone[i:i + W] = b"\1" * W
        out.append((len(t), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check(spark, df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    out = lz.removed(df).collect()
    want = [(k, *x) for (k, _), x in zip(rows, brute_force([t for _, t in rows]))]
    assert sorted([(r.id, r.n_words, r.n_removed, r.kept_sha256) for r in out], key=str) == sorted(want, key=str)
    assert all(sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed for r in out)


def passages_and_filler(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab cde the of fgh ij Éa x1 klm nop".split()) if rng.random() < 0.7 else f"w{rng.randint(0, 3000)}"
    some = lambda n: [word() for _ in range(n)]
    passages = [some(n) for n in (20, 33, 34, 35, 36, 50, 61, 62, 63, 70, 200)]
    rows = []
    for i in range(60):
        parts = some(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts += (p[a:rng.randint(a, len(p))] if rng.random() < 0.5 else p) + some(rng.randint(0, 8))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    return rows + [(100 + i, rows[3][1]) for i in range(3)]


@pytest.mark.parametrize("split", [2, 256])
def test_passages_of_all_lengths(spark, monkeypatch, split):
    monkeypatch.setattr(lz, "_SPLIT", split)
    check(spark, spark.createDataFrame(passages_and_filler(split), "doc_id long, text string").repartition(4))


def test_blocks_are_cut_between_seeds(monkeypatch):
    """The stream of entries gives the same windows in small blocks as in one."""
    rng = np.random.default_rng(5)
    rows = []
    for seed in range(30):
        base = rng.integers(0, 9, 60) + 100 * seed
        for k in range(int(rng.integers(1, 6))):
            words = base.copy()
            words[rng.integers(0, 60)] = -k - 1
            rows.append((seed, seed, k, 7, words.tolist()))
    names = ["seed", "_k1", "_k2", "lo", "words"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 7]), kinds)], names) for i in range(0, len(rows), 7)]
    got = []
    for size in (1, 500, 1 << 18):
        monkeypatch.setattr(lz, "_BLOCK_WORDS", size)
        out = list(lz._factored(iter(batches)))
        got.append(sorted(tuple(r.values()) for b in out for r in b.to_pylist()))
        assert (len(out) > 5) == (size < 1000)
    assert got[0] == got[1] == got[2] and got[0]


def test_parts_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(lz, "_PART", 50)
    cuts = np.array([0, 10, 45, 300, 300, 335])
    got = []
    for of, at, n in lz._parts(cuts):
        for i, a, k in zip(of, at, n):
            got += [(int(i), int(a) + j) for j in range(k - W + 1)]
    want = [(i, p) for i in range(5) for p in range(cuts[i], cuts[i + 1] - W + 1)]
    assert sorted(got) == want


def test_periodic_texts(spark):
    rows = [(1, "a " * 100), (2, "a b " * 60), (3, "a " * 36), (4, "a " * 35), (5, "a b c " * 30 + "x " + "a b c " * 30), (6, "b " * 34)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_odd_documents(spark, odd_documents):
    check(spark, odd_documents)


def test_greedy_factors_and_boundaries():
    """Repeats found by factors and at their boundaries are those of a plain search."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        base = rng.integers(0, 50, 200)
        parts = []
        for _ in range(12):
            a, n = rng.integers(0, 130), rng.integers(35, 63)
            part = base[a:a + n].copy()
            if rng.random() < 0.7:
                part[rng.integers(0, n)] = 1000 + rng.integers(0, 3)
            parts.append(part)
        length = np.array([len(p) for p in parts])
        ref = lz.Reference(np.concatenate(parts), length)
        seen = collections.Counter(tuple(p[i:i + W]) for p in parts for i in range(len(p) - W + 1))
        want = np.zeros(len(ref.order), bool)
        for b, p in zip(ref.begin, parts):
            for i in range(len(p) - W + 1):
                want[b + i] = seen[tuple(p[i:i + W])] > 1
        assert (ref.repeated() == want).all()


def test_spans_cut_a_text():
    assert lz.without_repeats(" a b\nc  d e", [1, 3]) == "a d e"
    assert lz.without_repeats(None, []) == ""


def test_empty_table(spark):
    assert lz.removed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
