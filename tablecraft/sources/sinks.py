"""Sinks: Parquet (plain / partitioned / verified), CSV, JSON, bucketed tables, quarantine.

Writes go through Spark's commit protocol: a task retried after an executor loss
never leaves partial files in the output, and a job either commits or leaves the
target unchanged.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import StringType, StructField, StructType

from tablecraft.operators.quality import Rules, is_bad, stamp_quarantine
from tablecraft.sources.scratch import scratch_path


class WriteVerificationError(RuntimeError):
    pass


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    dynamic_overwrite: bool = False,
) -> str:
    """Parquet write; ``dynamic_overwrite`` replaces only the partitions present in ``df``.

    Rows are first rebalanced by the partition columns: a task writes few partitions, and
    adaptive execution splits a large one, so there are not tasks x partitions files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def write_verified(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write and check that the files hold exactly the rows written.

    The row count is observed during the write itself (no second pass over the
    source) and compared with a count of the written files.
    """
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    written = obs.get["rows"]
    reread = df.sparkSession.read.parquet(path).count()
    if written != reread:
        raise WriteVerificationError(f"{path}: wrote {written} rows, found {reread}")
    return written


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> str:
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_quarantine(df: DataFrame, path: str, day: dt.date | str | None = None) -> str:
    """Bad rows stamped with the processing date, partitioned by it.

    Only the partition of that day is replaced, so reruns of other days are kept.
    """
    stamped = stamp_quarantine(df, day)
    return write_parquet(stamped, path, "overwrite", ["quarantine_date"], dynamic_overwrite=True)


def route(df: DataFrame, rules: Rules, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write ``df`` once, partitioned by the verdict of the rules, and read both sides back:
    ``(good, bad, counts)`` with the counts raw, good and bad, taken during the write. The
    input is computed once, whatever is done with the sides."""
    spark, obs = df.sparkSession, Observation(f"route_{uuid.uuid4().hex[:8]}")
    bad = is_bad(rules)
    counted = df.observe(obs, F.count(F.lit(1)).alias("raw"), F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    counted.withColumn("verdict", F.when(bad, "bad").otherwise("good")).write.partitionBy("verdict").parquet(path)
    back = spark.read.schema(StructType([*df.schema.fields, StructField("verdict", StringType())])).parquet(path)
    good, bad_rows = (back.filter(F.col("verdict") == v).drop("verdict") for v in ("good", "bad"))
    return good, bad_rows, dict(obs.get)


def write_bucketed(
    df: DataFrame,
    name: str,
    buckets: int,
    key: str | Sequence[str],
    path: str | None = None,
) -> str:
    """Save as a catalog table bucketed and sorted on ``key`` (one column or several);
    returns the table name.

    Two tables bucketed the same way on the join key join without an exchange. The
    table is external (its files live at ``path``, by default under the shared
    scratch folder) so its data outlives the session catalog. The rows are first
    hash-partitioned on ``key`` into ``buckets`` partitions (the same hash as
    bucketing), so each write task holds one bucket and writes one file: ``buckets``
    files instead of tasks x buckets.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:8]}"
    location = path or scratch_path(spark, table)
    keys = [key] if isinstance(key, str) else list(key)
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", location)
        .saveAsTable(table)
    )
    return table
