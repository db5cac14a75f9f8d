"""Streaming queries over the events table read as a file stream.

Every query runs its stream with ``availableNow`` (drain, then stop) and returns what
the sink holds, read back from storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablecraft.plans import logical as L
from tablecraft.sources.readers import read_json, read_parquet
from tablecraft.sources.scratch import scratch_path
from tablecraft.streaming.changes import latest_rows, write_changes
from tablecraft.streaming.jobs import (
    export_transactions_json,
    flag_large,
    high_value_alerts,
    replay_stream,
    run_foreach_batch,
    run_to_files,
    stage_replay,
    to_transactions,
    transactions_json_stream,
    transactions_stream,
    tumbling_totals,
)

LARGE_AMOUNT = 100.0
ALERT_AMOUNT = 250.0
WINDOW = "5 minutes"
LATENESS = "2 minutes"


def q_tumbling_batch(spark, sf):
    """The same tumbling-window aggregate on the table as a batch (no watermark)."""
    tx = to_transactions(L.table(spark, sf, "events"))
    return tumbling_totals(tx, WINDOW, lateness=None)


def q_stream_tumbling_agg(spark, sf):
    """Watermarked tumbling windows, append mode to Parquet: a window is written once,
    when the watermark (max event time - lateness) passes its end. Windows that it has
    not passed when the files are drained stay in the state: unfinished output."""
    out, chk = scratch_path(spark, "stream_windows"), scratch_path(spark, "chk_windows")
    q = run_to_files(tumbling_totals(transactions_stream(spark, f"{sf}/events.parquet"), WINDOW, LATENESS), out, chk)
    q.awaitTermination()
    return read_parquet(spark, out)


def q_stream_upsert_agg(spark, sf):
    """Update mode: the windows that a micro-batch changed are written under its number, and
    the table is the last row per window. A restarted query goes on from the checkpoint and
    the batches on storage; nothing is kept in the driver (see ``streaming/changes.py``)."""
    path, chk = scratch_path(spark, "stream_window_table"), scratch_path(spark, "chk_upsert")
    windows = tumbling_totals(transactions_stream(spark, f"{sf}/events.parquet"), WINDOW, LATENESS)
    q = run_foreach_batch(windows, write_changes(path, ["window_start"]), chk)
    q.awaitTermination()
    return latest_rows(spark, path, ["window_start"], windows.schema)


#: Seconds of event time in a step of the replay: a file, a micro-batch.
STEP = 3 * 86400


def _arrival(ts):
    """The step that an event arrives in: that of its time, or one or two later for the
    events of which delivery is delayed."""
    delay = F.when(F.col("event_id") % 50 == 7, 2).when(F.col("event_id") % 50 == 11, 1).otherwise(0)
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / STEP) + delay


def q_stream_replay_late(spark, sf):
    """The events replayed a step at a time, the watermark moving between the micro-batches:
    per window what was counted in time, and how many rows came too late."""
    feed, chk = scratch_path(spark, "replay"), scratch_path(spark, "chk_replay")
    path = scratch_path(spark, "replay_windows")
    events = L.table(spark, sf, "events")
    stage_replay(events, feed, _arrival(F.col("ts")))
    windows = tumbling_totals(replay_stream(spark, feed), WINDOW, LATENESS)
    q = run_foreach_batch(windows, write_changes(path, ["window_start"], fold_every=4), chk)
    q.awaitTermination()
    counted = latest_rows(spark, path, ["window_start"], windows.schema).select("window_start", "n", "total", "max_amount")
    arrived = tumbling_totals(to_transactions(events), WINDOW, lateness=None).select("window_start", "window_end", F.col("n").alias("arrived"))
    out = arrived.join(counted, "window_start", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("n_late", F.col("arrived") - F.col("n")).drop("arrived")


def _json_feed(spark, sf):
    """The events table exported as JSON-line transaction files (a Spark write)."""
    return export_transactions_json(L.table(spark, sf, "events"), scratch_path(spark, "tx_json"))


def q_stream_filter_append(spark, sf):
    """JSON file stream (text event time parsed) -> stateless
    filter + flag -> JSON file sink."""
    out, chk = scratch_path(spark, "stream_large"), scratch_path(spark, "chk_large")
    src = transactions_json_stream(spark, _json_feed(spark, sf))
    q = run_to_files(flag_large(src, LARGE_AMOUNT), out, chk, fmt="json")
    q.awaitTermination()
    back = read_json(spark, out, "transaction_id long, customer_id long, amount double, status string, is_large boolean")
    return back


def q_stream_threshold_alert(spark, sf):
    """High-value alerts to a JSON sink; the processing-time stamp is not returned."""
    out, chk = scratch_path(spark, "stream_alerts"), scratch_path(spark, "chk_alerts")
    src = transactions_json_stream(spark, _json_feed(spark, sf))
    q = run_to_files(high_value_alerts(src, ALERT_AMOUNT), out, chk, fmt="json")
    q.awaitTermination()
    return read_json(spark, out, "transaction_id long, customer_id long, amount double, alert_type string")


def q_stream_restart(spark, sf):
    """The later half of the events arrives after the query has ended: a new one with the
    same checkpoint takes only what is new, so every transaction is written once."""
    events, feed = L.table(spark, sf, "events"), scratch_path(spark, "restart_feed")
    out, chk = scratch_path(spark, "restarted"), scratch_path(spark, "chk_restart")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(span.a + (span.b - span.a) / 2)
    for half in (events.filter(F.col("ts") < middle), events.filter(F.col("ts").isNull() | (F.col("ts") >= middle))):
        half.write.mode("append").parquet(feed)
        q = run_to_files(flag_large(transactions_stream(spark, feed), LARGE_AMOUNT), out, chk)
        q.awaitTermination()
    return read_parquet(spark, out).drop("event_timestamp")


def q_stream_concurrent(spark, sf):
    """Two queries on one feed at the same time, each with its own sink and checkpoint."""
    feed = transactions_stream(spark, f"{sf}/events.parquet")
    jobs = {"large": flag_large(feed, LARGE_AMOUNT).filter("is_large"), "alert": high_value_alerts(feed, ALERT_AMOUNT)}
    sinks = {name: scratch_path(spark, f"concurrent_{name}") for name in jobs}
    running = [run_to_files(df, sinks[name], scratch_path(spark, f"chk_{name}")) for name, df in jobs.items()]
    for q in running:
        q.awaitTermination()
    parts = [read_parquet(spark, path).select(F.lit(name).alias("job"), "transaction_id", "amount") for name, path in sinks.items()]
    return parts[0].unionByName(parts[1])


def q_stream_complete_memory(spark, sf):
    """Complete mode into the memory sink, for results of a few rows: totals per status."""
    tx, name = transactions_stream(spark, f"{sf}/events.parquet"), f"totals_{uuid.uuid4().hex[:8]}"
    totals = tx.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.max("amount").alias("max_amount"))
    q = totals.writeStream.format("memory").queryName(name).outputMode("complete").option(
        "checkpointLocation", scratch_path(spark, "chk_totals")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


QUERIES = {
    "stream_restart": q_stream_restart,
    "stream_concurrent": q_stream_concurrent,
    "stream_complete_memory": q_stream_complete_memory,
    "tumbling_batch": q_tumbling_batch,
    "stream_tumbling_agg": q_stream_tumbling_agg,
    "stream_upsert_agg": q_stream_upsert_agg,
    "stream_replay_late": q_stream_replay_late,
    "stream_filter_append": q_stream_filter_append,
    "stream_threshold_alert": q_stream_threshold_alert,
}

_WINDOWS = """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS max_amount
FROM events GROUP BY 1, 2"""
_TX = """SELECT event_id AS transaction_id, user_id AS customer_id, value AS amount,
       CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM events"""

ORACLE = {
    "stream_restart": f"""
SELECT transaction_id, customer_id, amount, status, amount >= {LARGE_AMOUNT} AS is_large
FROM ({_TX}) t WHERE status = 'SUCCESS'""",
    "stream_concurrent": f"""
SELECT 'large' AS job, transaction_id, amount FROM ({_TX}) t WHERE amount >= {LARGE_AMOUNT} AND status = 'SUCCESS'
UNION ALL
SELECT 'alert' AS job, transaction_id, amount FROM ({_TX}) t WHERE amount >= {ALERT_AMOUNT} AND status = 'SUCCESS'""",
    "stream_complete_memory": f"SELECT status, COUNT(*) AS n, MAX(amount) AS max_amount FROM ({_TX}) t GROUP BY status",
    "tumbling_batch": _WINDOWS,
    "stream_tumbling_agg": f"""
SELECT * FROM ({_WINDOWS}) w
WHERE w.window_end + INTERVAL 2 MINUTE <= (SELECT MAX(ts) FROM events)""",
    "stream_upsert_agg": _WINDOWS,
    # a micro-batch drops rows by the watermark of the one before it, which rests on the
    # batches before that
    "stream_replay_late": f"""
WITH e AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
         dense_rank() OVER (ORDER BY CAST(floor(epoch(ts) / {STEP}) AS BIGINT)
             + CASE event_id % 50 WHEN 7 THEN 2 WHEN 11 THEN 1 ELSE 0 END) AS step
  FROM events),
s AS (SELECT step, max(ts) AS latest FROM e GROUP BY step),
w AS (SELECT step, date_trunc('millisecond', max(latest) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
             - INTERVAL 2 MINUTE AS watermark FROM s),
m AS (
  SELECT e.*, w.watermark IS NULL OR e.window_start + INTERVAL 5 MINUTE > w.watermark AS counted
  FROM e JOIN w ON w.step = e.step)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, COUNT(*) FILTER (WHERE counted) AS n,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE counted) AS DOUBLE) AS total,
       MAX(value) FILTER (WHERE counted) AS max_amount, COUNT(*) FILTER (WHERE NOT counted) AS n_late
FROM m GROUP BY window_start""",
    "stream_filter_append": f"""
SELECT transaction_id, customer_id, amount, status, amount >= {LARGE_AMOUNT} AS is_large
FROM ({_TX}) t WHERE status = 'SUCCESS'""",
    "stream_threshold_alert": f"""
SELECT transaction_id, customer_id, amount, 'HIGH_VALUE_TRANSACTION' AS alert_type
FROM ({_TX}) t WHERE amount >= {ALERT_AMOUNT} AND status = 'SUCCESS'""",
}
