"""Tables kept as numbered Parquet folders, of which the last complete one is the table.

A change writes a whole new folder ``<path>/<prefix>=<n>``. Spark's writers add ``_SUCCESS``
when a job has committed, so a folder without it is the rest of a failed write: readers pass
over it and the next write of that number replaces it. The state before stays readable until
someone drops it, whatever happens to the write, and nothing is renamed (object stores can't).
Paths are any Hadoop URI. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablecraft.operators.versions import upsert
from tablecraft.sources.sinks import write_parquet


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _folder(spark, path)
    return fs.exists(where)


def committed(spark: SparkSession, path: str, prefix: str = "state") -> dict[int, str]:
    """Numbers and folders of the complete states at ``path``, ascending; none if there is
    no such path. One listing of names."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return {}
    out = {}
    for entry in fs.listStatus(where):
        name, _, number = entry.getPath().getName().partition("=")
        if name == prefix and number.isdigit() and exists(spark, f"{path}/{prefix}={number}/_SUCCESS"):
            out[int(number)] = f"{path}/{prefix}={number}"
    return dict(sorted(out.items()))


def read_state(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """One state. ``schema`` stands in for a state without files (an empty table that was
    written partitioned)."""
    fs, where = _folder(spark, folder)
    files = fs.listFiles(where, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return spark.read.parquet(folder)
    if schema is None:
        raise ValueError(f"{folder} has no files to take a schema from")
    return spark.createDataFrame([], schema)


def read_latest(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table at ``path``."""
    states = committed(spark, path)
    if not states:
        raise FileNotFoundError(f"no complete state at {path}")
    return read_state(spark, states[max(states)], schema)


def write_state(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> int:
    """Write ``df`` as the next state of the table at ``path``; its number."""
    n = max(committed(df.sparkSession, path), default=-1) + 1
    write_parquet(df, f"{path}/state={n}", partition_by=partition_by)
    return n


def upsert_or_create(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] | None = None) -> int:
    """Merge ``source`` into the table at ``path`` (update all, insert all), or make the table
    of it if there is none yet. Returns the number of the new state."""
    spark = source.sparkSession
    states = committed(spark, path)
    if not states:
        return write_state(source, path, partition_by)
    before = read_state(spark, states[max(states)], source.schema)
    return write_state(upsert(before, source, keys), path, partition_by)


def drop_states(spark: SparkSession, path: str, keep: int = 1, prefix: str = "state") -> list[int]:
    """Delete all but the last ``keep`` complete states and what failed writes have left
    before them; the numbers of the complete ones that went."""
    if keep < 1:
        raise ValueError("the table itself must be kept")
    states = committed(spark, path, prefix)
    last = sorted(states)[-keep:]
    fs, where = _folder(spark, path)
    if last and fs.exists(where):
        for entry in fs.listStatus(where):
            name, _, number = entry.getPath().getName().partition("=")
            if name == prefix and number.isdigit() and int(number) < last[0]:
                fs.delete(entry.getPath(), True)
    return sorted(n for n in states if n < last[0]) if last else []
