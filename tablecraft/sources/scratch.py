"""Shared scratch locations for operators that materialise data.

Writes (sinks, snapshot versions, stream checkpoints, lineage cuts) go under the
shared folder the cluster names in ``spark.checkpoint.dir``. A session without that
setting gets a private temporary folder only in local mode (a laptop or a unit test),
where all tasks share the machine; on a cluster its absence is an error, as executors
would write to folders that the others cannot see.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only in local mode."""
    root = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tablecraft-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the scratch root."""
    return f"{scratch_root(spark)}/tablecraft/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
