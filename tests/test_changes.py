"""Update mode on storage: restart after a crash, folding, and the replay's late rows."""

import os

import pytest
from pyspark.sql import functions as F

from tablecraft.sources.states import committed
from tablecraft.streaming.changes import latest_rows, write_changes
from tablecraft.streaming.jobs import replay_stream, run_foreach_batch, stage_replay, to_transactions, tumbling_totals

KEYS = ["window_start"]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """The smoke events as five files in time order."""
    path = str(tmp_path_factory.mktemp("feed") / "events")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return stage_replay(ev, path, F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (6 * 86400)))


def windows(spark, feed):
    return tumbling_totals(replay_stream(spark, feed), "5 minutes", "2 minutes")


def batch_answer(spark):
    tx = to_transactions(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    return rows(tumbling_totals(tx, "5 minutes", lateness=None))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def run(spark, feed, path, checkpoint, write):
    """One life of the query; the batches that it began with their input rows."""
    q = run_foreach_batch(windows(spark, feed), write, checkpoint)
    try:
        q.awaitTermination()
    except Exception as e:
        assert "killed" in str(e)
    return {p["batchId"]: p["numInputRows"] for p in q.recentProgress}


@pytest.mark.parametrize("after_write", [False, True])
@pytest.mark.parametrize("fold_every", [2, 16])
def test_restart_after_a_kill(spark, feed, tmp, after_write, fold_every):
    """Killed in batch 2, before or after its rows are complete; a new query with the same
    checkpoint ends with the batch answer, and every batch reads its rows once."""
    path, checkpoint = f"{tmp}/table", f"{tmp}/checkpoint"
    write = write_changes(path, KEYS, fold_every)

    def killed_in_two(batch, batch_id):
        if batch_id == 2 and not after_write:
            os.makedirs(f"{path}/batch=2/_temporary")  # a write that did not end
            raise RuntimeError("killed")
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("killed")

    first = run(spark, feed, path, checkpoint, killed_in_two)
    assert max(first, default=0) < 2 and (2 in committed(spark, path, "batch")) == after_write
    if after_write:
        written = os.stat(f"{path}/batch=2/_SUCCESS").st_mtime_ns
    second = run(spark, feed, path, checkpoint, write_changes(path, KEYS, fold_every))
    assert min(second) == 2
    if after_write and fold_every == 16:  # else folded by now
        assert os.stat(f"{path}/batch=2/_SUCCESS").st_mtime_ns == written  # not written again
    total = spark.read.parquet(feed).count()
    assert sum((first | second).values()) == total  # each batch reads its rows once
    assert rows(latest_rows(spark, path, KEYS)) == batch_answer(spark)


def test_folds_bound_the_folders(spark, feed, tmp):
    path = f"{tmp}/table"
    run(spark, feed, path, f"{tmp}/checkpoint", write_changes(path, KEYS, fold_every=1))
    n = len(os.listdir(feed)) - 1
    assert len(committed(spark, path, "upto")) == 2 and len(committed(spark, path, "batch")) <= 2
    assert max(committed(spark, path, "upto")) >= n - 2
    assert rows(latest_rows(spark, path, KEYS)) == batch_answer(spark)


def test_no_batch_yet(spark, feed, tmp):
    with pytest.raises(FileNotFoundError):
        latest_rows(spark, f"{tmp}/none", KEYS)
    assert latest_rows(spark, f"{tmp}/none", KEYS, windows(spark, feed).schema).collect() == []


def test_replay_takes_a_step_a_batch(spark, feed, tmp):
    seen = []
    run(spark, feed, None, f"{tmp}/checkpoint", lambda batch, i: seen.append((i, batch.count())))
    steps = [d for d in os.listdir(feed) if d.startswith("_step=")]
    assert len(seen) >= len(steps) >= 5
