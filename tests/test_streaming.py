"""Structured Streaming jobs: stateless sinks, watermark windows, checkpoint restart,
late data, concurrent queries."""

import os
import shutil

from pyspark.sql import functions as F

from tablecraft.streaming.jobs import (
    flag_large,
    high_value_alerts,
    run_to_files,
    transactions_stream,
    tumbling_totals,
)


def stage_events(spark, src, tmp, name="events.parquet"):
    os.makedirs(tmp, exist_ok=True)
    shutil.copy(f"{src}/events.parquet", f"{tmp}/{name}")
    return tmp


def test_stream_is_streaming_and_filters(spark, sf, tmp):
    src = stage_events(spark, sf, f"{tmp}/in")
    tx = transactions_stream(spark, src)
    assert tx.isStreaming
    q = run_to_files(flag_large(tx, 100.0), f"{tmp}/out", f"{tmp}/chk", fmt="json")
    q.awaitTermination()
    out = spark.read.schema("transaction_id long, status string, amount double, is_large boolean").json(f"{tmp}/out")
    assert out.count() > 0 and out.filter("status <> 'SUCCESS'").count() == 0
    assert out.filter("is_large <> (amount >= 100.0)").count() == 0


def test_checkpoint_restart_processes_nothing_twice(spark, sf, tmp):
    src = stage_events(spark, sf, f"{tmp}/in")
    for _ in range(2):
        q = run_to_files(flag_large(transactions_stream(spark, src), 100.0), f"{tmp}/out", f"{tmp}/chk")
        q.awaitTermination()
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() == out.select("transaction_id").distinct().count()
    # a new file arriving later is picked up by the restarted query
    stage_events(spark, sf, src, "events_2.parquet")
    q = run_to_files(flag_large(transactions_stream(spark, src), 100.0), f"{tmp}/out", f"{tmp}/chk")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/out").count() == 2 * out.count()


def test_late_rows_are_dropped(spark, sf, tmp):
    """Late rows are filtered against the watermark of the previous micro-batch, so
    the early half arriving in the third batch is dropped entirely."""
    src = f"{tmp}/in"
    ev = spark.read.parquet(f"{sf}/events.parquet")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    late_half, early_half = ev.filter(F.col("ts") >= cut), ev.filter(F.col("ts") < cut)
    late_half.coalesce(1).write.parquet(f"{tmp}/a")
    late_half.orderBy(F.col("ts").desc()).limit(1).coalesce(1).write.parquet(f"{tmp}/b")
    early_half.coalesce(1).write.parquet(f"{tmp}/c")
    os.makedirs(src)
    for i, d in enumerate(("a", "b", "c")):
        f = [x for x in os.listdir(f"{tmp}/{d}") if x.endswith(".parquet")][0]
        shutil.copy(f"{tmp}/{d}/{f}", f"{src}/events_{i}.parquet")
        os.utime(f"{src}/events_{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    agg = tumbling_totals(transactions_stream(spark, src, files_per_trigger=1), "5 minutes", "2 minutes")
    q = run_to_files(agg, f"{tmp}/out", f"{tmp}/chk")
    q.awaitTermination()
    inputs = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert inputs == [late_half.count(), 1, early_half.count()]
    out = spark.read.parquet(f"{tmp}/out")
    assert out.count() > 0
    assert out.filter(F.col("window_start") < cut).count() == 0


def test_two_concurrent_queries(spark, sf, tmp):
    src = stage_events(spark, sf, f"{tmp}/in")
    tx = transactions_stream(spark, src)
    q1 = run_to_files(flag_large(tx, 100.0), f"{tmp}/o1", f"{tmp}/c1", available_now=False, interval="1 second")
    q2 = run_to_files(high_value_alerts(tx, 250.0), f"{tmp}/o2", f"{tmp}/c2", available_now=False, interval="1 second")
    try:
        assert {q1.id, q2.id} <= {q.id for q in spark.streams.active}
        q1.processAllAvailable()
        q2.processAllAvailable()
        assert q1.lastProgress is not None and q2.isActive
    finally:
        q1.stop()
        q2.stop()
    assert not q1.isActive and not q2.isActive
    alerts = spark.read.parquet(f"{tmp}/o2")
    assert alerts.filter("amount < 250.0").count() == 0 and alerts.count() > 0


def test_json_stream_parses_event_time(spark, tmp):
    import datetime as dt

    from tablecraft.streaming.jobs import transactions_json_stream

    src = f"{tmp}/json_in"
    os.makedirs(src)
    with open(f"{src}/part-0.json", "w") as f:
        f.write('{"transaction_id": 1, "customer_id": 1, "amount": 75000.0, "status": "SUCCESS", '
                '"event_time": "2024-01-15 10:00:00.000000"}\n')
        f.write('{"transaction_id": 3, "customer_id": 1, "amount": 15000.0, "status": "FAILED", '
                '"event_time": "not a time"}\n')
    q = run_to_files(transactions_json_stream(spark, src), f"{tmp}/out", f"{tmp}/chk")
    q.awaitTermination()
    got = {r.transaction_id: r.event_timestamp for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert got[1] == dt.datetime(2024, 1, 15, 10, 0) and got[3] is None


STREAM_ROWS = [
    (1, 1, 75000.0, "SUCCESS", "2024-01-15 10:00:00.000000"),
    (2, 2, 25000.0, "SUCCESS", "2024-01-15 10:01:00.000000"),
    (3, 1, 15000.0, "FAILED", "2024-01-15 10:02:00.000000"),
    (4, 3, 120000.0, "SUCCESS", "2024-01-15 10:03:00.000000"),
    (5, 2, 8000.0, "SUCCESS", "2024-01-15 10:04:00.000000"),
]


def test_five_row_transaction_stream(spark, tmp):
    from tablecraft.streaming.jobs import TX_JSON_SCHEMA, transactions_json_stream

    src = f"{tmp}/feed"
    spark.createDataFrame(STREAM_ROWS, TX_JSON_SCHEMA).coalesce(1).write.json(src)
    tx = transactions_json_stream(spark, src)
    q1 = run_to_files(flag_large(tx, 50000.0), f"{tmp}/large", f"{tmp}/c1")
    q2 = run_to_files(high_value_alerts(tx, 100000.0), f"{tmp}/alerts", f"{tmp}/c2")
    q1.awaitTermination()
    q2.awaitTermination()
    large = {r.transaction_id: r.is_large for r in spark.read.parquet(f"{tmp}/large").collect()}
    assert 3 not in large and large[1] is True and large[2] is False and len(large) == 4
    alerts = spark.read.parquet(f"{tmp}/alerts").collect()
    assert [a.transaction_id for a in alerts] == [4] and alerts[0].alert_type == "HIGH_VALUE_TRANSACTION"
    assert alerts[0].alert_time is not None


def test_streams_cover_whole_tables_of_any_layout(spark, sf, tmp):
    """One file, several files with rows in random places, a folder of part files: every
    closed window has the batch answer, and an upserted table covers every row."""
    from tablecraft.plans import streams as S

    ev = spark.read.parquet(f"{sf}/events.parquet")
    os.makedirs(f"{tmp}/one")
    shutil.copy(f"{sf}/events.parquet", f"{tmp}/one/events.parquet")
    ev.orderBy(F.xxhash64("event_id")).repartition(3).write.parquet(f"{tmp}/random/events.parquet")
    ev.repartitionByRange(4, F.col("ts").desc()).write.parquet(f"{tmp}/late/events.parquet")
    last = ev.agg(F.max("ts")).first()[0]
    want = {r.window_start: (r.n, r.total, r.max_amount) for r in S.q_tumbling_batch(spark, sf).collect()}
    for d in ("one", "random", "late"):
        windows = S.q_stream_tumbling_agg(spark, f"{tmp}/{d}").collect()
        assert all(want[r.window_start] == (r.n, r.total, r.max_amount) for r in windows)
        assert {r.window_start for r in windows} >= {w for w in want if (last - w).total_seconds() > 7 * 60 + 1}
        assert {r.window_start: (r.n, r.total, r.max_amount) for r in S.q_stream_upsert_agg(spark, f"{tmp}/{d}").collect()} == want
        flagged = S.q_stream_filter_append(spark, f"{tmp}/{d}").count()
        assert flagged == ev.filter("event_type = 'purchase'").count()


def test_memory_sink(spark, sf, tmp):
    src = stage_events(spark, sf, f"{tmp}/in")
    q = (flag_large(transactions_stream(spark, src), 100.0).writeStream.format("memory").queryName("flagged")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("flagged").count() == spark.read.parquet(f"{src}/events.parquet").filter("event_type = 'purchase'").count()
