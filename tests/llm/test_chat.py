import random

from tablecraft.llm import chat
from tablecraft.llm.queries import QUERIES


def brute_force(rows):
    """Rows of the maximal conversations: (conv, position, n_turns, role, segment)."""
    key = lambda r: [(x is not None, x if x is not None else 0) for x in r[1:]]
    convs = {}
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append(r[2:])
    kept = {}
    for c, turns in convs.items():
        if not any(len(o) > len(turns) and o[:len(turns)] == turns for o in convs.values()):
            whole = tuple(turns)
            if whole not in kept or c is not None and (kept[whole] is None or c < kept[whole]):
                kept[whole] = c
    return [(c, i + 1, len(w), role, f"<|im_start|>{'unknown' if role is None else role}\n{text or ''}<|im_end|>\n")
            for w, c in kept.items() for i, (role, text) in enumerate(w)]


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, n int, position int").repartition(3)
    got = sorted((tuple(r) for r in chat.maximal_conversations(df).collect()), key=str)
    assert got == sorted(brute_force(rows), key=str)
    return df


def test_snapshots_copies_and_long_conversations(spark):
    rng, rows = random.Random(0), []
    long = [(t, "user" if t % 2 == 0 else "assistant", f"turn {t} {rng.random()}") for t in range(3000)]
    for conv, n in ((1, 3000), (2, 10), (3, 1023), (4, 1024), (5, 1025), (6, 3000), (7, 1)):
        rows += [(conv, *t) for t in long[:n]]
    rows += [(8, *t) for t in long[:5]] + [(8, 5, "user", "another way")]
    rows += [(9, 10 * t, r, x) for t, r, x in long[:4]]  # other turn numbers, same turns
    df = check(spark, rows)
    whole = {r.conv: r.text for r in chat.assembled(chat.maximal_conversations(df)).collect()}
    assert set(whole) == {1, 8} and whole[8].count("<|im_start|>") == 6 and whole[8].endswith("another way<|im_end|>\n")


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, "b"), (1, 0, "user", None), (2, None, "user", "a"), (3, None, "user", "a"),
            (None, 0, "user", "hi"), (None, 0, "user", "hi"), (4, 0, "user", "hi"), (5, 0, "user", ""), (6, 0, "user", None),
            (7, 0, "", None), (8, 0, None, None), (9, 0, "user", "hi"), (9, 0, "user", "hi"), (9, 1, "user", "x")]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.maximal_conversations(df).collect() == []


def test_main_path_has_no_python(spark, sf):
    plan = QUERIES["op3_chat_format"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
