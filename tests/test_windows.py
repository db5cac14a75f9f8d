"""Rankings and ordered windows; the range-split running total equals the plain one."""

from pyspark.sql import functions as F

from tablecraft.operators.windows import (
    lag_delta,
    lag_pct_change,
    moving_average,
    rank_within,
    running_total,
    running_total_ranged,
    top_n_per_group,
)

ROWS = [
    (1, "GOLD", 900.0), (2, "GOLD", 500.0), (3, "GOLD", 500.0), (4, "SILVER", 300.0),
    (5, "SILVER", 700.0), (6, "BRONZE", 50.0),
]


def spend(spark):
    return spark.createDataFrame(ROWS, "customer_id int, tier string, spend double")


def test_rank_resets_per_tier(spark):
    df = rank_within(spend(spark), ["tier"], [F.col("spend").desc()], "rank", "r")
    df = rank_within(df, ["tier"], [F.col("spend").desc()], "dense_rank", "d")
    df = rank_within(df, ["tier"], [F.col("spend").desc(), "customer_id"], "row_number", "n")
    out = {r.customer_id: (r.r, r.d, r.n) for r in df.collect()}
    assert out[1] == (1, 1, 1) and out[2] == (2, 2, 2) and out[3] == (2, 2, 3)
    assert out[5] == (1, 1, 1) and out[6] == (1, 1, 1)


def test_top_n(spark):
    top = top_n_per_group(spend(spark), ["tier"], [F.col("spend").desc()], 1)
    assert sorted(r.customer_id for r in top.collect()) == [1, 5, 6]


def history(spark):
    return spark.createDataFrame(
        [(c, d, float(10 * d + c)) for c in (1, 2) for d in range(1, 8)] + [(3, 1, 5.0)],
        "customer_id int, day int, amount double",
    )


def test_running_total_monotone_and_lag(spark):
    h = history(spark)
    rt = running_total(h, ["customer_id"], ["day"], "amount").filter("customer_id = 1").orderBy("day").collect()
    vals = [r.running_total for r in rt]
    assert vals == sorted(vals) and vals[-1] == sum(10 * d + 1 for d in range(1, 8))
    lag = lag_delta(h, ["customer_id"], ["day"], "amount").filter("day = 1").collect()
    assert all(r.prev_value is None and r.delta is None for r in lag)
    pct = lag_pct_change(h, ["customer_id"], ["day"], "amount").filter("customer_id = 1 and day = 2").first()
    assert pct.pct_change == round((21 - 11) / 11 * 100, 2)


def test_moving_average_window(spark):
    h = history(spark)
    ma = moving_average(h, ["customer_id"], ["day"], "amount", 3, 3, "ma").filter("customer_id = 1").orderBy("day").collect()
    assert ma[0].ma == round(sum(10 * d + 1 for d in range(1, 5)) / 4, 2)
    assert ma[3].ma == round(sum(10 * d + 1 for d in range(1, 8)) / 7, 2)


def test_ranged_running_total_on_hot_key(spark):
    # one customer holds most rows: the range split must give the same totals
    rows = [(1, i, float(i % 7)) for i in range(3000)] + [(c, i, 1.0) for c in range(2, 50) for i in range(5)]
    df = spark.createDataFrame(rows, "customer_id int, seq int, amount double")
    plain = running_total(df, ["customer_id"], ["seq"], "amount")
    ranged = running_total_ranged(df, ["customer_id"], ["seq"], "amount", num_partitions=8)
    assert ranged.exceptAll(plain).count() == 0 and plain.exceptAll(ranged).count() == 0


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def hot_history(spark):
    # customer 1 holds most rows (split across many ranges); others are tiny
    rows = [(1, i, float((i * 37) % 101)) for i in range(2000)]
    rows += [(c, i, float(c + i)) for c in range(2, 60) for i in range(1 + c % 4)]
    return spark.createDataFrame(rows, "customer_id int, seq int, amount double")


def test_ranged_lag_and_moving_average_match_plain(spark):
    from tablecraft.operators.windows import bounded_window_ranged

    df = hot_history(spark)
    for n in (7, 64):  # 64 ranges on little data: tiny segments at range edges
        plain = moving_average(lag_delta(df, ["customer_id"], ["seq"], "amount"), ["customer_id"], ["seq"], "amount")
        ranged = moving_average(
            lag_delta(df, ["customer_id"], ["seq"], "amount", ranged=True),
            ["customer_id"], ["seq"], "amount", ranged=True,
        )
        assert _same(plain, ranged)

        def lead2(w):
            return {"next2": F.lead("amount", 2).over(w), "win": F.sum("amount").over(w.rowsBetween(-2, 2))}

        got = bounded_window_ranged(df, ["customer_id"], ["seq"], lead2, 2, 2, num_partitions=n)
        from pyspark.sql import Window

        w = Window.partitionBy("customer_id").orderBy("seq")
        want = df.withColumns(lead2(w))
        assert _same(got, want)


def test_ranged_ranks_match_plain(spark):
    rows = [("GOLD", i, float(i // 3)) for i in range(3000)] + [("SILVER", i, float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "tier string, customer_id int, spend double")
    for kind in ("rank", "dense_rank"):
        plain = rank_within(df, ["tier"], [F.col("spend").desc()], kind, "r")
        ranged = rank_within(df, ["tier"], [F.col("spend").desc()], kind, "r", ranged=True)
        assert _same(plain, ranged)
    plain = rank_within(df, ["tier"], [F.col("spend").desc(), "customer_id"], "row_number", "r")
    ranged = rank_within(df, ["tier"], [F.col("spend").desc(), "customer_id"], "row_number", "r", ranged=True)
    assert _same(plain, ranged)


def test_ranged_forms_match_plain_on_null_hot_and_tied_keys(spark):
    rows = [(None if i % 4 else i % 7, i // 3, i, float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, tied int, seq int, amount double").repartition(5)
    for kind in ("rank", "dense_rank", "row_number"):
        order = ["tied", "seq"] if kind == "row_number" else ["tied"]
        assert _same(rank_within(df, ["k"], order, kind, "r"), rank_within(df, ["k"], order, kind, "r", ranged=True))
    for f in (lambda **o: running_total(df, ["k"], ["seq"], "amount", **o),
              lambda **o: lag_delta(df, ["k"], ["seq"], "amount", **o),
              lambda **o: moving_average(df, ["k"], ["seq"], "amount", **o)):
        assert _same(f(), f(ranged=True))


def test_three_rankings_from_one_split(spark):
    from tablecraft.operators.windows import rankings_ranged

    df = spark.createDataFrame([(i, None if i % 3 else "T", float(i % 50)) for i in range(2000)], "id int, tier string, spend double")
    by = [F.col("spend").desc()]
    plain = rank_within(df, ["tier"], by, "rank", "a")
    plain = rank_within(plain, ["tier"], by, "dense_rank", "b")
    plain = rank_within(plain, ["tier"], [*by, "id"], "row_number", "c")
    split = rankings_ranged(df, ["tier"], by, {"a": "rank", "b": "dense_rank", "c": "row_number"}, tie_breakers=["id"], num_partitions=7)
    assert _same(plain, split)


def test_range_split_has_one_exchange_and_writes_nothing(spark):
    """A hot key is cut in ranges by an expression of key and order value."""
    from tablecraft.operators.windows import _split

    df = hot_history(spark).repartition(3)
    split, cut = _split(df, ["customer_id"], ["seq"], 8)
    assert cut
    parts = {r.customer_id: r.n for r in split.groupBy("customer_id").agg(F.count_distinct("_range").alias("n")).collect()}
    assert parts[1] >= 6 and all(n == 1 for k, n in parts.items() if k != 1)
    out = running_total_ranged(df, ["customer_id"], ["seq"], "amount", num_partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    main = plan[:plan.index("BroadcastExchange")]
    assert main.count("Exchange hashpartitioning") <= 1 and "ExistingRDD[_range" not in plan


def test_ranges_follow_every_kind_of_order(spark):
    """Dates, times, texts, decimals, flags, falling orders and placed nulls."""
    rows = [(1 if i % 5 else i, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, i int").select(
        "k", "i", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i") % 97).alias("d"),
        F.timestamp_seconds(F.col("i") * 37 % 1013).alias("t"), F.when(F.col("i") % 11 > 0, F.concat(F.lit("é"), (F.col("i") * 7 % 501).cast("string"))).alias("s"),
        (F.col("i") * 13 % 211).cast("decimal(10,2)").alias("m"), (F.col("i") % 2 == 0).alias("b"),
        F.when(F.col("i") % 7 > 0, (F.col("i") % 71).cast("double")).otherwise(F.lit(float("nan"))).alias("x"))
    df = df.withColumn("m", F.when(F.col("i") % 13 > 0, F.col("m")))
    for first in ("d", "t", "s", "m", "b", F.col("d").desc(), F.col("s").desc(), F.col("m").desc_nulls_first(), F.col("m").asc_nulls_last(),
                  F.col("x").desc(), "x"):
        order = [first, "i"]
        for kind in ("rank", "dense_rank"):
            assert _same(rank_within(df, ["k"], [first], kind, "r"), rank_within(df, ["k"], [first], kind, "r", ranged=True))
        assert _same(running_total(df, ["k"], order, "i"), running_total(df, ["k"], order, "i", ranged=True))
    assert _same(lag_delta(df, ["k"], [F.col("t").desc(), "i"], "i"), lag_delta(df, ["k"], [F.col("t").desc(), "i"], "i", ranged=True))


def test_one_window_over_all_rows_is_split(spark):
    df = spark.range(2000).select("id", (F.col("id") * 7 % 300).alias("v"))
    assert _same(running_total(df, [], ["v", "id"], "v"), running_total(df, [], ["v", "id"], "v", ranged=True))


def test_unnamed_order_expressions_are_refused(spark):
    import pytest

    df = spark.createDataFrame([(1, i) for i in range(50)], "k int, i int")
    with pytest.raises(ValueError, match="named columns"):
        rank_within(df, ["k"], [F.col("i") + 1], "rank", "r", ranged=True)


def test_running_total_of_leading_nulls(spark):
    rows = [(1, i, None if i < 900 else 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, i int, amount double")
    assert _same(running_total(df, ["k"], ["i"], "amount"), running_total(df, ["k"], ["i"], "amount", ranged=True))
