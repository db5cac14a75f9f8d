import hashlib
import random

from pyspark.sql import functions as F

from tablecraft.llm import trie


def brute_force(convs):
    """Node rows of conversations {id: [(role, text), ...]}, by listing all prefixes."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {}
    for k in members:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k],
             hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, m in members.items()]


def rows_of(convs):
    return [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]


def check(spark, convs):
    df = spark.createDataFrame(rows_of(convs), "conv_id long, turn long, role string, text string").repartition(4)
    turns = trie.turns_in_order(df)
    sizes = turns.groupBy("conv").agg(F.max("at").alias("n"))
    got = [tuple(r) for r in trie.prefix_trie(turns, sizes).collect()]
    assert sorted(got, key=str) == sorted(brute_force({c: t for c, t in convs.items() if t}), key=str)


def test_random_conversations(spark):
    rng = random.Random(1)
    convs = {}
    for c in rng.sample(range(-50, 500), 120):
        base = rng.choice(list(convs.values())) if convs and rng.random() < 0.7 else []
        cut = base[:rng.randint(0, len(base))]
        convs[c] = cut + [(rng.choice("ua"), rng.choice(["", "x", "é", "long text"])) for _ in range(rng.randint(0 if cut else 1, 6))]
    convs |= {1000 + i: convs[next(iter(convs))] for i in range(30)}
    check(spark, convs)


def test_long_chains_contract_in_stretches(spark, monkeypatch):
    """Chains much longer than a stretch, with branches at all depths."""
    monkeypatch.setattr(trie, "_STRETCH", 4)
    rng = random.Random(2)
    trunk = [("u", f"t{i}") for i in range(90)]
    convs = {7: trunk}
    for c in range(20, 45):
        at = rng.randint(0, 90)
        convs[c] = trunk[:at] + [("a", f"{c % 3}-{i}") for i in range(rng.randint(0, 30))]
    convs = {c: t for c, t in convs.items() if t}
    check(spark, convs)


def test_rebuilt_conversations(spark):
    turns = {0: "abcd", 1: "efgh", 3: "ij", 7: "klm", 9: "n"}
    df = spark.createDataFrame([(c, i, "u", x) for c, t in turns.items() for i, x in enumerate(t)], "conv_id long, turn long, role string, text string")
    c = F.col("conv")
    out, sizes = trie.rebuilt(trie.turns_in_order(df), base=c - c % 5, shared=F.when(c == 3, 9).when(c == 9, 1).otherwise(3))
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.conv, r.at)):
        got[r.conv] = got.get(r.conv, "") + r.text
        assert r.at == len(got[r.conv])
    # 7 and 9 build on 5, which is absent; 9 has no turn after its first
    assert got == {0: "abcd", 1: "abch", 3: "abcd"}
    assert {r.conv: r.n for r in sizes.collect()} == {0: 4, 1: 4, 3: 4, 7: 0, 9: 0}


def test_odd_turns(spark):
    """Null numbers, roles, texts and ids, equal turns, extra columns."""
    rows = [(1, None, "u", "x"), (1, 2, None, "y"), (1, 2, "a", None), (2, None, "u", "x"), (2, 2, "", "y"), (2, 2, "a", ""),
            (None, 1, "u", "lost"), (3, 5, "u", "x"), (3, 5, "u", "x"), (4, 0, "u", "漢" * 5000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, label int, depth string")
    turns = trie.turns_in_order(df)
    sizes = turns.groupBy("conv").agg(F.max("at").alias("n"))
    same = [("u", "x"), ("", "y"), ("a", "")]
    want = brute_force({1: same, 2: same, 3: [("u", "x")] * 2, 4: [("u", "漢" * 5000)]})
    assert sorted([tuple(r) for r in trie.prefix_trie(turns, sizes).collect()], key=str) == sorted(want, key=str)


def test_ends_of_a_node_come_in_chunks(spark):
    """Ids that end in one node are spread over ranges and batches, yet digested in order."""
    ids = list(range(-20, 3000))
    df = spark.range(len(ids)).select((F.col("id") - 20).alias("conv"), F.lit(-20).cast("long").alias("label"), F.lit(1).cast("long").alias("depth"))
    out = trie.ends_digest(df.repartition(5)).collect()
    assert [r.ends_sha256 for r in out] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]


def test_empty_table(spark):
    turns = trie.turns_in_order(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    sizes = turns.groupBy("conv").agg(F.max("at").alias("n"))
    assert trie.prefix_trie(turns, sizes).collect() == []
