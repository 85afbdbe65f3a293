"""K06 exactly-once output on top of an at-least-once replay.

``foreachBatch`` may re-run a micro-batch after a failure.  Each batch is
written to its own ``batch_id=<n>`` partition with dynamic partition
overwrite, so a replay replaces the earlier attempt instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IdempotentBatchWriter:
    """``by``: columns whose values are folders above the batch's."""

    def __init__(self, path: str, fmt: str = "parquet", by: tuple[str, ...] = ()):
        self.path = path
        self.fmt = fmt
        self.by = by

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.by, "batch_id")
            .format(self.fmt)
            .save(self.path)
        )
