"""Replay a table as a stream: one parquet file per micro-batch, cut in
arrival order, file modification times increasing, read back with
``maxFilesPerTrigger=1`` and an explicit schema.

A far-future sentinel row can be appended in a last file so event-time
windows still open at the end of the data close (Spark does not flush open
windows at the end of a finite replay); callers filter it out.
"""

from __future__ import annotations

import glob
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_replay(
    df: DataFrame,
    order_cols: list[str],
    out_dir: str,
    batches: int,
    sentinel: DataFrame | None = None,
) -> str:
    """Range-cut ``df`` by ``order_cols`` into ``batches`` files under
    ``out_dir`` (one micro-batch each).  Returns the data directory."""
    data_dir = os.path.join(out_dir, "data")
    staged = os.path.join(out_dir, "staged")
    (
        df.repartitionByRange(batches, *order_cols)
        .sortWithinPartitions(*order_cols)
        .write.mode("overwrite")
        .parquet(staged)
    )
    os.makedirs(data_dir, exist_ok=True)
    parts = sorted(glob.glob(os.path.join(staged, "part-*.parquet")))
    now = time.time() - 10_000
    for i, p in enumerate(parts):
        target = os.path.join(data_dir, f"batch-{i:05d}.parquet")
        os.link(p, target)
        os.utime(target, (now + i, now + i))
    if sentinel is not None:
        sdir = os.path.join(out_dir, "sentinel")
        sentinel.coalesce(1).write.mode("overwrite").parquet(sdir)
        for j, p in enumerate(sorted(glob.glob(os.path.join(sdir, "part-*.parquet")))):
            target = os.path.join(data_dir, f"batch-{len(parts) + j:05d}.parquet")
            os.link(p, target)
            os.utime(target, (now + len(parts) + j, now + len(parts) + j))
    return data_dir


def read_replay(spark: SparkSession, data_dir: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(data_dir)
    )


def to_event_time(df: DataFrame, *cols: str) -> DataFrame:
    """NTZ -> TIMESTAMP (session zone UTC) so ``withWatermark`` accepts it."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def run_to_end(
    stream: DataFrame,
    output_mode: str,
    checkpoint: str,
    timeout_s: int = 300,
    foreach_batch=None,
    query_name: str | None = None,
):
    """Run with ``availableNow`` to the end of the replay; returns the query.

    Without ``foreach_batch`` the rows go to a memory table named
    ``query_name`` (tests only)."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("memory").queryName(query_name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
    return q
