"""Literal rows with an explicit schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def from_collection(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
