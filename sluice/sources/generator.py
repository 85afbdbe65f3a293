"""The number generator ``"Number:" + n``.

Batch: ``spark.range`` (distributed, no driver-side list).  Stream: the
built-in ``rate`` source at a fixed rows/second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "Number:"


def datagen_batch(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions).select(
        F.col("id").alias("n"), F.concat(F.lit(PREFIX), F.col("id").cast("string")).alias("value")
    )


def datagen_stream(spark: SparkSession, rows_per_second: int = 1000, partitions: int = 2) -> DataFrame:
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
        .select(
            F.col("value").alias("n"),
            F.concat(F.lit(PREFIX), F.col("value").cast("string")).alias("value"),
            F.col("timestamp"),
        )
    )
