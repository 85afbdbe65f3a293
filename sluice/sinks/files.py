"""K01/K02 row-format text files in hour buckets ``yyyy-MM-dd HH``.

The bucket is a partition column (``bucket=2024-01-01 00/part-...``), the
line the only value column.  A batch write replaces the buckets it has, so a
repeated job does not double them.  Rolling: a batch rolls by rows
(``maxRecordsPerFile``) or bytes; the stream rolls per trigger (time) and by
rows, or by bytes and age with lines held over from batch to batch
(:class:`RollingTextWriter`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.rolling import running_aggregate
from sluice.sinks.idempotent import IdempotentBatchWriter

BUCKET_FORMAT = "yyyy-MM-dd HH"


def bucketed_lines(df: DataFrame, time_col: str, line: Column) -> DataFrame:
    return df.select(F.date_format(F.col(time_col), BUCKET_FORMAT).alias("bucket"), line.alias("value"))


def write_bucketed_text(
    frame: DataFrame, path: str, max_records_per_file: int | None = None, max_bytes_per_file: int | None = None
) -> None:
    """``max_bytes_per_file``: a file is closed by the line that fills it; each
    file of a bucket is then a sub-partition ``roll``."""
    by = ["bucket"]
    if max_bytes_per_file:
        size = F.octet_length("value") + 1
        frame = frame.withColumns({"_size": size.cast("long"), "_at": F.xxhash64("value")})
        frame = running_aggregate(frame, ["bucket"], "_at", [("_sum", "sum", F.col("_size"))])
        frame = frame.withColumn("roll", F.floor((F.col("_sum") - F.col("_size")) / max_bytes_per_file))
        frame, by = frame.select("bucket", "roll", "value").repartition("bucket", "roll"), ["bucket", "roll"]
    w = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format("text")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def write_bucketed_text_stream(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    roll_interval: str | None = "1 minute",
    max_records_per_file: int | None = None,
):
    """Streaming writer: a new file set per trigger (``roll_interval``; None
    runs the available input once, for replays)."""
    w = (
        frame.writeStream.format("text")
        .partitionBy("bucket")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    w = w.trigger(processingTime=roll_interval) if roll_interval else w.trigger(availableNow=True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w


class RollingTextWriter:
    """K02 stream: ``foreachBatch`` writer of ``bucket, value`` lines that rolls
    by bytes and by age across batches.

    A file is published when the line that fills it is there (so it has at most
    ``max_bytes`` and one line) or when its first line has waited for
    ``max_age_s``.  The lines of files that are not full are held, less than
    ``max_bytes`` a bucket, as the state of the batch; the next batch puts them
    before its own.  A batch writes under its id, files and held lines, and is
    cut the same way when it runs again.  ``finish`` publishes what is held.
    """

    def __init__(self, path: str, state_path: str, max_bytes: int = 1 << 20, max_age_s: float = 60.0, now=None):
        import time

        self.path, self.state_path = path, state_path
        self.max_bytes, self.max_age_s, self.now = max_bytes, max_age_s, now or time.time
        self.held = IdempotentBatchWriter(state_path)

    def __call__(self, batch: DataFrame, batch_id: int, all_lines: bool = False) -> None:
        from sluice.session import written
        from sluice.streaming.ops import previous_state

        now = float(self.now())
        new = batch.select("bucket", "value", F.lit(now).alias("since"), F.lit(1).alias("age"))
        old = previous_state(batch.sparkSession, self.state_path, batch_id)
        lines = new if old is None else new.unionByName(old.filter("NOT mark").select("bucket", "value", "since", F.lit(0).alias("age")))
        lines = lines.withColumns({"_size": (F.octet_length("value") + 1).cast("long"), "_at": F.xxhash64("value")})
        # held lines first; equal lines may change places
        lines = running_aggregate(lines, ["bucket"], "age", [("_sum", "sum", F.col("_size")), ("_no", "count", F.lit(1))], tiebreak=["_at"])
        rolls = lines.withColumn("roll", F.floor((F.col("_sum") - F.col("_size")) / self.max_bytes))
        # a file is full when its bytes end at or behind its last byte
        last = rolls.groupBy("bucket", "roll").agg(F.max("_sum").alias("_end"), F.min("since").alias("_since"))
        last = last.withColumn("done", (F.col("_end") >= (F.col("roll") + 1) * self.max_bytes) | (F.col("_since") <= now - self.max_age_s) | F.lit(all_lines))
        last = last.select(F.col("bucket").alias("b"), F.col("roll").alias("r"), "done")
        rolls = rolls.join(last, F.col("bucket").eqNullSafe(F.col("b")) & (F.col("roll") == F.col("r")))
        rolls = written(rolls.select("bucket", "roll", "value", "since", "done"), "rolls")
        done = rolls.filter("done").select("bucket", "roll", "value").repartition("bucket", "roll")
        done.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id", "roll").text(self.path)
        mark = batch.sparkSession.range(1).select(F.lit(None).cast("string").alias("bucket"), F.lit(None).cast("string").alias("value"), F.lit(now).alias("since"), F.lit(True).alias("mark"))
        # a row in every batch, so that a batch without held lines has a state
        self.held(rolls.filter("not done").select("bucket", "value", "since", F.lit(False).alias("mark")).unionByName(mark), batch_id)

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        """Publish the lines held after the last batch as batch ``batch_id``."""
        self(spark.createDataFrame([], "bucket string, value string"), batch_id, all_lines=True)
