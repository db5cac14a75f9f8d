"""Keep-latest dedup, SCD-2 history, point-in-time lookup, temporal join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablecraft.functions.columns import parse_timestamp
from tablecraft.operators.dedup import dedup_any, dedup_latest, scd2_as_of, scd2_build, scd2_current
from tablecraft.operators.joins import temporal_join

DUPES = [
    (1, "PENDING", "15-01-2024 10:00"),
    (1, "COMPLETED", "15-01-2024 11:30"),
    (2, "PENDING", "14-01-2024 09:00"),
    (3, "PENDING", "02-01-2024 08:00"),
    (3, "COMPLETED", "01-02-2024 08:00"),  # text order would put this first (defect D6)
    (4, "CANCELLED", "10-01-2024 12:00"),
    (5, "PENDING", "11-01-2024 12:00"),
]


def test_latest_wins_on_parsed_time(spark):
    df = spark.createDataFrame(DUPES, "order_id int, status string, updated_at string")
    latest = dedup_latest(df, ["order_id"], [parse_timestamp("updated_at", "dd-MM-yyyy HH:mm")])
    out = {r.order_id: r.status for r in latest.collect()}
    assert out[1] == "COMPLETED" and out[3] == "COMPLETED"
    assert latest.count() == 5 == dedup_any(df, ["order_id"]).count()


def test_dedup_latest_ties_are_deterministic(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 4)], "k int, v string, t int")
    assert dedup_latest(df, ["k"], ["t"]).first().v == "b"  # ties broken by the other columns


def scd(spark):
    changes = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "SILVER"), (1, dt.date(2024, 1, 15), "GOLD"), (2, dt.date(2024, 1, 5), "BRONZE")],
        "customer_id int, changed_on date, tier string",
    )
    return scd2_build(changes, ["customer_id"], "changed_on")


def test_scd2_history(spark):
    dim = scd(spark)
    rows = {(r.customer_id, r.tier): r for r in dim.collect()}
    assert rows[(1, "SILVER")].effective_to == dt.date(2024, 1, 14)  # no shared boundary day (D7)
    assert rows[(1, "GOLD")].effective_to is None and rows[(1, "GOLD")].is_current
    assert scd2_current(dim).count() == 2


def test_point_in_time(spark):
    dim = scd(spark)
    assert scd2_as_of(dim, "2024-01-10").filter("customer_id = 1").first().tier == "SILVER"
    assert scd2_as_of(dim, "2024-01-20").filter("customer_id = 1").first().tier == "GOLD"
    assert scd2_as_of(dim, "2024-01-14").filter("customer_id = 1").count() == 1


def test_temporal_join_keeps_fact_rows(spark):
    facts = spark.createDataFrame(
        [(10, 1, dt.date(2024, 1, 3)), (11, 1, dt.date(2024, 1, 20)), (12, 2, dt.date(2024, 1, 1)), (13, 9, dt.date(2024, 1, 9))],
        "order_id int, customer_id int, event_date date",
    )
    out = temporal_join(facts, scd(spark), ["customer_id"], "event_date")
    tiers = {r.order_id: r.tier for r in out.collect()}
    assert out.count() == facts.count()
    assert tiers == {10: "SILVER", 11: "GOLD", 12: None, 13: None}


def test_temporal_join_at_sf(spark, sf):
    from tablecraft.plans import joins

    fact_rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert joins.q_temporal_join(spark, sf).count() == fact_rows


def test_sweep_equals_interval_join_on_hot_key(spark):
    # customer 1: 400 versions and 3000 facts (spread over many ranges); others small
    base = dt.date(2020, 1, 1)
    changes = [(1, base + dt.timedelta(days=3 * i), f"T{i % 7}") for i in range(400)]
    changes += [(c, base + dt.timedelta(days=c), "X") for c in range(2, 40)]
    dim = scd2_build(
        spark.createDataFrame(changes, "customer_id int, changed_on date, tier string"), ["customer_id"], "changed_on"
    )
    facts = [(i, 1, base + dt.timedelta(days=(i * 7) % 1300 - 5)) for i in range(3000)]
    facts += [(10000 + c, c, base + dt.timedelta(days=c + (c % 3) - 1)) for c in range(2, 60)]
    fact = spark.createDataFrame(facts, "order_id int, customer_id int, event_date date")
    sweep = temporal_join(fact, dim, ["customer_id"], "event_date", method="sweep")
    plain = temporal_join(fact, dim, ["customer_id"], "event_date").select(*sweep.columns)
    assert sweep.count() == fact.count()
    assert sweep.exceptAll(plain).count() == 0 and plain.exceptAll(sweep).count() == 0


def test_temporal_join_does_not_depend_on_other_keys(spark):
    day = lambda n: dt.date(2024, 1, n)
    overlapping = [(1, "A", day(1), None), (1, "B", day(2), day(20)), (1, "C", day(3), None)]
    other = [(2, f"V{i}", dt.date(2020, 1, 1) + dt.timedelta(days=i), None) for i in range(70)]
    fact = spark.createDataFrame([(10, 1, day(10))], "order_id int, customer_id int, event_date date")
    schema = "customer_id int, tier string, effective_from date, effective_to date"
    for rows in (overlapping, overlapping + other):
        out = temporal_join(fact, spark.createDataFrame(rows, schema), ["customer_id"], "event_date")
        assert sorted(r.tier for r in out.collect()) == ["A", "B", "C"]


def test_sweep_gives_null_keys_no_version(spark):
    schema = "customer_id int, tier string, effective_from date, effective_to date"
    dim = spark.createDataFrame([(None, "X", dt.date(2020, 1, 1), None), (1, "Y", dt.date(2020, 1, 1), None)], schema)
    fact = spark.createDataFrame([(i, None if i % 2 else 1, dt.date(2024, 1, 1)) for i in range(400)],
                                 "order_id int, customer_id int, event_date date")
    out = temporal_join(fact, dim, ["customer_id"], "event_date", method="sweep")
    assert {(r.customer_id, r.tier) for r in out.collect()} == {(None, None), (1, "Y")} and out.count() == 400


def test_dedup_latest_limits_before_the_shuffle(spark, sf):
    from tablecraft.plans import logical as L

    df = dedup_latest(L.orders_dupes(spark, sf), ["order_id", "line_no"], ["updated_at"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]  # partial limit below the shuffle


@pytest.mark.parametrize("rows, wrong", [
    ([(1, 0, 9), (1, 10, None), (2, 0, None)], False),
    ([(1, 0, 9), (1, 9, None)], True),       # a day in common
    ([(1, 0, None), (1, 10, None)], True),   # an open end before another version
    ([(1, 0, 30), (1, 5, 8), (1, 40, None)], True),
    ([(1, 5, 9), (1, 5, 9)], True),
    ([(None, 0, None), (None, 0, None), (1, 3, 4)], False),
])
def test_overlapping_versions_raise(spark, rows, wrong):
    dim = spark.createDataFrame([(k, f"t{i}", a, b) for i, (k, a, b) in enumerate(rows)], "customer_id int, tier string, effective_from int, effective_to int")
    fact = spark.createDataFrame([(1, 6), (1, 12), (2, 6), (None, 1)], "customer_id int, at int")
    if wrong:
        with pytest.raises(Exception, match="versions overlap"):
            temporal_join(fact, dim, ["customer_id"], "at", method="sweep").collect()
    else:
        out = temporal_join(fact, dim, ["customer_id"], "at", method="sweep")
        plain = temporal_join(fact, dim, ["customer_id"], "at").select(*out.columns)
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_overlap_across_ranges_of_a_hot_key_raises(spark):
    from tablecraft.operators.joins import without_overlap

    rows = [(1, 10 * i, 10 * i + 9) for i in range(800)] + [(k, 0, 5) for k in range(2, 60)]
    schema = "k int, effective_from int, effective_to int"
    assert without_overlap(spark.createDataFrame(rows, schema), ["k"]).count() == len(rows)
    for at in (1, 400, 799):
        bad = [r if r[:2] != (1, 10 * at - 10) else (1, r[1], r[2] + 1) for r in rows]
        with pytest.raises(Exception, match="versions overlap"):
            without_overlap(spark.createDataFrame(bad, schema), ["k"]).count()
