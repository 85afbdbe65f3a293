"""Physical partitioning.

Each function returns the redistributed frame; ``with_partition_id`` adds the
partition a row landed in, for checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_partition_id(df: DataFrame, name: str = "pid") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def partition_custom(df: DataFrame, key: str, n: int) -> DataFrame:
    """R01 user partitioner ``key % n`` -> exact partition id (``pmod`` so a
    negative key still gets a valid target)."""
    return df.repartitionById(n, F.pmod(F.col(key), F.lit(n)).cast("int"))


def partition_shuffle(df: DataFrame, n: int, seed: int = 17) -> DataFrame:
    """R02 random, even spread (seeded: a retried task sends rows to the same
    targets)."""
    return df.repartition(n, F.rand(seed))


def partition_rebalance(df: DataFrame, n: int) -> DataFrame:
    """R03 round-robin."""
    return df.repartition(n)


def partition_broadcast(df: DataFrame, n: int) -> DataFrame:
    """R04 every downstream partition receives every row: ``n`` copies, copy
    ``i`` placed in partition ``i`` (no join involved)."""
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col("copy"))


def partition_global(df: DataFrame) -> DataFrame:
    """R05 all rows to one task.  Offered for parity only: it serialises the
    whole stream through a single task and is never used by this library's
    operators."""
    return df.coalesce(1)


def key_by(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """R06 hash partitioning by key (what ``groupBy`` does implicitly)."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)
