import hashlib
import itertools
import random

import regex
import xxhash
from pyspark.sql import functions as F

from tablecraft.llm import simhash
from tablecraft.llm.queries import QUERIES


def long_hash(value, seed):
    return xxhash.xxh64((value & (1 << 64) - 1).to_bytes(8, "little"), seed=seed).intdigest()


def fingerprint(text):
    """128-bit fingerprint by plain counting."""
    w = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if x]
    second = xxhash.xxh64((1).to_bytes(4, "little"), seed=42).intdigest()
    votes = [0] * 128
    for i in range(max(len(w) - 5, 0) + 1 if w else 0):
        h = 42
        for x in w[i:i + 5]:
            h = long_hash(x, h)
        both = h | long_hash(h, second) << 64
        for b in range(128):
            votes[b] += 1 if both >> b & 1 else -1
    bits = sum(1 << b for b in range(128) if votes[b] > 0)
    return f"{bits & (1 << 64) - 1:016x}{bits >> 64:016x}"


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def check(spark, df):
    rows = [(r.doc_id, r.text or "", r.h) for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    rows.sort(key=lambda r: r[2])
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    want = []
    for i, (k, t, _) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        f, e, n = fingerprint(t), fingerprint(edited), fingerprint(after)
        want.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, likeness(f, e), likeness(f, n)))
    out = simhash.half_edits(df).select(
        "id", "n_chars", "edited_sha256", simhash.as_text("f1", "f2"), simhash.as_text("e1", "e2"),
        simhash.likeness("f1", "f2", "e1", "e2"), simhash.likeness("f1", "f2", "n1", "n2"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)


def test_odd_documents(spark, odd_documents):
    # the order among rows of one id and text hash decides nothing; ties of a null id do not exist here
    check(spark, odd_documents.where("doc_id is not null or text is not null"))


def test_one_and_no_document(spark):
    check(spark, spark.createDataFrame([(3, "a b c d e f g")], "doc_id long, text string"))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.half_edits(none).collect() == []


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    rng = random.Random(0)
    text = " ".join(rng.choice("abcdefgh") for _ in range(400))
    df = spark.createDataFrame([(1, text), (2, "x y z")], "doc_id long, text string")
    want = {r.id: (r.f1, r.f2) for r in simhash.fingerprints(df).collect()}
    monkeypatch.setattr(simhash, "_CHUNK", 7)  # 58 chunks
    assert {r.id: (r.f1, r.f2) for r in simhash.fingerprints(df).collect()} == want


def test_no_lane_overflows(spark):
    # 90,000 equal terms give every set bit the largest count there is
    df = spark.createDataFrame([(1, "same " * 90_004)], "doc_id long, text string")
    r = simhash.fingerprints(df).select(simhash.as_text("f1", "f2").alias("f")).first()
    assert r.f == fingerprint("same " * 5)


def test_radius_search_finds_all(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(6)]
    values = [b ^ sum(1 << i for i in rng.sample(range(128), rng.randint(0, 7))) for b in base for _ in range(30)]
    signed = [tuple((v >> s & (1 << 64) - 1) - (1 << 64 if v >> s + 63 & 1 else 0) for s in (0, 64)) for v in values]
    fps = spark.createDataFrame(signed, "f1 long, f2 long")
    for radius in (0, 3, 5):
        got = {(r.q1, r.q2, r.f1, r.f2, r.distance) for r in simhash.within_radius(fps, fps, radius).collect()}
        want = {(*signed[i], *signed[j], (values[i] ^ values[j]).bit_count()) for i, j in itertools.product(range(len(values)), repeat=2)
                if (values[i] ^ values[j]).bit_count() <= radius}
        assert got == want


def test_main_path_has_no_python(spark, sf):
    plan = QUERIES["op10_simhash"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edited_texts_are_nearer_than_the_next_ones(spark, sf):
    r = QUERIES["op10_simhash"](spark, sf).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert r.e > r.n + 0.1


def shuffled_words(rng, n):
    return [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 10 ** 6)) for _ in range(n)]


def edited_pairs(rng, n_words, n_changes, n):
    """Texts and copies of them with some words changed, far apart: a change takes five terms."""
    for _ in range(n):
        words = shuffled_words(rng, n_words)
        copy = list(words)
        for i in range(n_changes):
            copy[(2 * i + 1) * n_words // (2 * n_changes)] = f"new{rng.randint(0, 10 ** 6)}"
        yield " ".join(words), " ".join(copy)


def test_wide_radius_finds_all(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(128) for _ in range(6)]
    values = [b ^ sum(1 << i for i in rng.sample(range(128), rng.randint(0, 20))) for b in base for _ in range(40)]
    signed = [tuple((v >> s & (1 << 64) - 1) - (1 << 64 if v >> s + 63 & 1 else 0) for s in (0, 64)) for v in values]
    fps = spark.createDataFrame(signed, "f1 long, f2 long")
    for radius in (7, 11, simhash.radius_for(0.8)):
        rows = [(r.q1, r.q2, r.f1, r.f2, r.distance) for r in simhash.within_radius(fps, fps.limit(60), radius).collect()]
        asked = {(r.f1, r.f2) for r in fps.limit(60).collect()}
        want = {(*signed[i], *signed[j], (values[i] ^ values[j]).bit_count()) for i, j in itertools.product(range(len(values)), repeat=2)
                if (values[i] ^ values[j]).bit_count() <= radius and signed[i] in asked}
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_edited_copies_are_counted(spark, tmp):
    # Jaccard 0.97 (1 word of 300) and 0.82 (6 words of 300, 20 of 1,000)
    rng, rows = random.Random(5), []
    for n_words, n_changes in ((300, 1), (300, 6), (1000, 20)):
        for text, copy in edited_pairs(rng, n_words, n_changes, 40):
            k = 100 * (len(rows) // 2 + 1)
            rows += [(k, text), (k + 1, copy)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/edited/documents.parquet")
    got = {r.doc_id: r.n_near for r in QUERIES["op10_simhash"](spark, f"{tmp}/edited").where("n_near is not null").collect()}
    found = [got[k] for k, _ in rows[::2]]
    assert len(found) == 120 and set(found) <= {0, 1}
    assert [sum(found[i:i + 40]) >= 36 for i in (0, 40, 80)] == [True] * 3


def test_rows_that_share_an_id_stay_apart(spark, tmp):
    """One id with two texts, repeated rows and null ids: a row for every row."""
    a, b = "one two three four five six seven", "quite another text with other words in it"
    rows = [(100, a), (100, a), (100, b), (200, a), (7, b), (None, a), (None, b)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/ids/documents.parquet")
    got = [(r.doc_id, r.n_chars, r.n_near) for r in QUERIES["op10_simhash"](spark, f"{tmp}/ids").collect()]
    want = [(100, len(a), 3), (100, len(a), 3), (100, len(b), 2), (200, len(a), 3), (7, len(b), None), (None, len(a), None), (None, len(b), None)]
    assert sorted(got, key=str) == sorted(want, key=str)
