"""Session settings sized from the input, for runs from a laptop to a large cluster.

Nothing here creates a session: ``scale_settings`` returns a dict for the session
builder (or ``spark-submit --conf``), ``apply_sql_settings`` sets the runtime-modifiable
SQL settings on an existing session.
"""

from __future__ import annotations

import math

MB = 1024 * 1024


def scale_settings(
    input_bytes: int,
    total_cores: int,
    partition_bytes: int = 256 * MB,
) -> dict[str, str]:
    """Settings so that scan splits and shuffle partitions stay near ``partition_bytes``.

    * scan splits: ``spark.sql.files.maxPartitionBytes`` = ``partition_bytes``;
    * shuffle partitions: enough for the input at ``partition_bytes`` each (at least two
      waves of the available cores); AQE then coalesces small partitions to the advisory
      size and splits skewed ones (a partition over 5x the median and 4x the target);
    * broadcasts: the static threshold stays at Spark's 10 MB and AQE may broadcast a side
      it measured below 64 MB at runtime;
    * streaming state: RocksDB state store, which spills to local disk.
    """
    n = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    n = int(math.ceil(n / total_cores) * total_cores)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
    # streaming state (window aggregates) in RocksDB: spills to local disk and checkpoints
    # changes, instead of holding all state on the executor heap
    settings["spark.sql.streaming.stateStore.providerClass"] = (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    return settings


def apply_sql_settings(spark, settings: dict[str, str]) -> None:
    """Set the SQL settings on a running session (all keys above are runtime SQL confs)."""
    for k, v in settings.items():
        spark.conf.set(k, v)


def input_size(paths: list[str], spark=None) -> int:
    """Total bytes under ``paths`` (local paths without a session; any Hadoop URI with one)."""
    if spark is None:
        import os

        total = 0
        for p in paths:
            if os.path.isdir(p):
                for root, _dirs, files in os.walk(p):
                    total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
            elif os.path.exists(p):
                total += os.path.getsize(p)
        return total
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        total += hp.getFileSystem(conf).getContentSummary(hp).getLength()
    return total
