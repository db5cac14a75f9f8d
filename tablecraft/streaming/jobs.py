"""Structured Streaming jobs on the payment-transaction stream.

Builders turn a streaming DataFrame into a streaming DataFrame; runners start a
query with a checkpoint location (one per query, under the shared scratch folder),
so a restarted query resumes where it stopped and never processes a file twice.

Event time: the driver tables hold ``TIMESTAMP_NTZ``, which ``withWatermark``
rejects; it is cast to ``TIMESTAMP`` in the session time zone (run sessions in UTC)
and cast back for output, which restores the original wall-clock value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from tablecraft.functions.columns import money

EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])
ALERT_TYPE = "HIGH_VALUE_TRANSACTION"
# JSON transaction files: explicit schema (a stream cannot infer one), text event time
TX_JSON_SCHEMA = StructType([
    StructField("transaction_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("amount", DoubleType()),
    StructField("status", StringType()),
    StructField("event_time", StringType()),
])
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _file_stream(spark: SparkSession, schema: StructType, files_per_trigger: int | None):
    """Reader of a file stream. Without ``files_per_trigger`` a micro-batch takes all files
    that are there, so a replay of a backlog sees every row before the watermark moves,
    whatever the order of the files. A limit suits files that arrive in time order within
    the allowed lateness."""
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def transactions_stream(spark: SparkSession, source: str, files_per_trigger: int | None = None) -> DataFrame:
    """Events table at ``source`` (a file, or a folder of part files) as a stream of payment
    transactions."""
    reader = _file_stream(spark, EVENTS_SCHEMA, files_per_trigger)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        # a stream reads folders: take the one file of its folder
        reader, source = reader.option("pathGlobFilter", path.getName()), str(path.getParent())
    return to_transactions(reader.parquet(source))


def stage_replay(events: DataFrame, path: str, step: Column) -> str:
    """Write ``events`` for a replay: a Parquet file per value of ``step``, with modification
    times in the order of the steps, which is the order in which a file stream takes files.
    With ``files_per_trigger=1`` a step is a micro-batch, so choose steps that fit a file.
    The file system must let modification times be set (local ones and HDFS do)."""
    events.withColumn("_step", step).repartition("_step").write.partitionBy("_step").parquet(path)
    spark = events.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = {e.getPath().getName(): e.getPath() for e in fs.listStatus(where) if e.isDirectory()}
    steps = sorted((int(name.partition("=")[2]), at) for name, at in folders.items() if name.startswith("_step="))
    for n, (_, folder) in enumerate(steps):
        (file,) = [e.getPath() for e in fs.listStatus(folder) if e.getPath().getName().startswith("part-")]
        fs.setTimes(file, (n + 1) * 1000, -1)
        if fs.getFileStatus(file).getModificationTime() != (n + 1) * 1000:
            raise RuntimeError(f"{path}: the file system keeps its own modification times")
    return path


def replay_stream(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`stage_replay` wrote as a stream of transactions, one step a micro-batch."""
    reader = _file_stream(spark, EVENTS_SCHEMA, 1).option("recursiveFileLookup", "true")
    return to_transactions(reader.parquet(path))


def export_transactions_json(events: DataFrame, path: str) -> str:
    """Write events as JSON-line transaction files with a text ``event_time`` (the shape a
    payment feed delivers), each a contiguous time range; as many files as shuffle
    partitions."""
    tx = events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "purchase", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.date_format(F.col("ts"), EVENT_TIME_FORMAT).alias("event_time"),
    )
    tx.repartitionByRange("event_time").write.mode("errorifexists").json(path)
    return path


def transactions_json_stream(spark: SparkSession, source_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON transaction files as a stream (explicit schema); the text event time is parsed,
    malformed text gives null."""
    raw = _file_stream(spark, TX_JSON_SCHEMA, files_per_trigger).json(source_dir)
    return raw.select(
        "transaction_id", "customer_id", "amount", "status",
        F.try_to_timestamp(F.col("event_time"), F.lit(EVENT_TIME_FORMAT)).alias("event_timestamp"),
    )


def to_transactions(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "purchase", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


def flag_large(tx: DataFrame, threshold: float) -> DataFrame:
    """Successful transactions with an ``is_large`` flag (stateless)."""
    return tx.filter(F.col("status") == "SUCCESS").withColumn("is_large", F.col("amount") >= F.lit(threshold))


def high_value_alerts(tx: DataFrame, threshold: float) -> DataFrame:
    """Successful transactions at or above ``threshold``, stamped as alerts."""
    return tx.filter((F.col("amount") >= F.lit(threshold)) & (F.col("status") == "SUCCESS")).select(
        "transaction_id", "customer_id", "amount", "event_timestamp",
        F.lit(ALERT_TYPE).alias("alert_type"), F.current_timestamp().alias("alert_time"),
    )


def tumbling_totals(tx: DataFrame, window: str = "5 minutes", lateness: str | None = "2 minutes",
                    time_col: str = "event_timestamp") -> DataFrame:
    """Count / exact sum / max of amounts per tumbling event-time window.

    With ``lateness`` the state of a window is dropped once the watermark passes its
    end, so state stays bounded on an endless stream; rows later than that are dropped.
    """
    src = tx.withWatermark(time_col, lateness) if lateness else tx
    agg = src.groupBy(F.window(time_col, window)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(money("amount")).alias("total"),
        F.max("amount").alias("max_amount"),
    )
    return agg.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "n", F.col("total").cast("double").alias("total"), "max_amount",
    )


def run_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 output_mode: str = "append", available_now: bool = True,
                 interval: str = "5 seconds", name: str | None = None) -> StreamingQuery:
    """File sink with a checkpoint; ``available_now`` drains what exists then stops."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("path", path).option(
        "checkpointLocation", checkpoint
    )
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      output_mode: str = "update", available_now: bool = True,
                      interval: str = "5 seconds") -> StreamingQuery:
    """Each micro-batch handed to ``fn(batch_df, batch_id)`` (e.g. an idempotent upsert)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
