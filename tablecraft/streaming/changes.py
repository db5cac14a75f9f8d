"""Update-mode results kept on storage as the changes of every micro-batch.

In update mode a micro-batch gives the new values of the keys it touched. Each batch is
written once, to the folder ``<path>/batch=<id>`` of its own, and the table is the row of the
last batch per key. Nothing is kept in the driver between batches: a query that was killed
goes on from its checkpoint, finds the batches that are complete (those with ``_SUCCESS``) and
writes only the others, so a batch that runs again changes nothing on storage.

Every ``fold_every`` batches the changes up to then are folded into ``<path>/upto=<id>``, the
table as of that batch, so a reader has a bounded number of folders to merge, and a batch
costs what it changes, not what the table holds. Folders that the fold before last replaced
are removed; one generation stays for readers that have begun.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablecraft.operators.dedup import dedup_latest
from tablecraft.sources.states import committed, drop_states, exists, read_state


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | None = None,
                upto: int | None = None) -> DataFrame:
    """The table as of batch ``upto`` (by default the last): per key the row of its last
    batch. ``schema`` stands in while no batch is complete."""
    folds = {n: f for n, f in committed(spark, path, "upto").items() if upto is None or n <= upto}
    base = max(folds, default=-1)
    batches = {n: f for n, f in committed(spark, path, "batch").items() if n > base and (upto is None or n <= upto)}
    parts = [read_state(spark, folds[base]).withColumn("_batch", F.lit(base).cast("long"))] if folds else []
    if batches:
        rows = spark.read.option("basePath", path).parquet(*batches.values())
        parts.append(rows.withColumnRenamed("batch", "_batch").withColumn("_batch", F.col("_batch").cast("long")))
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"no complete batch at {path}")
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return dedup_latest(rows, list(keys), ["_batch"]).drop("_batch")


def fold(spark: SparkSession, path: str, keys: Sequence[str], batch_id: int) -> None:
    """Write the table as of ``batch_id`` and remove what the fold before it had replaced."""
    before = max((n for n in committed(spark, path, "upto") if n < batch_id), default=None)
    latest_rows(spark, path, keys, upto=batch_id).write.mode("overwrite").parquet(f"{path}/upto={batch_id}")
    drop_states(spark, path, keep=2, prefix="upto")
    if before is not None:
        since = [n for n in committed(spark, path, "batch") if n > before]
        drop_states(spark, path, keep=len(since), prefix="batch")


def write_changes(path: str, keys: Sequence[str], fold_every: int = 16) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the changed rows of every batch at ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}/batch={batch_id}"
        if exists(spark, f"{folder}/_SUCCESS"):
            # killed after the write: the rows are there, but the query's state has yet to take the batch in
            batch.write.format("noop").mode("overwrite").save()
        else:
            batch.write.mode("overwrite").parquet(folder)
        if (batch_id + 1) % fold_every == 0 and not exists(spark, f"{path}/upto={batch_id}/_SUCCESS"):
            fold(spark, path, keys, batch_id)

    return write
