"""Kafka topic values as UTF-8 text.

The connector jar is not part of every deployment; ``kafka_source_options``
holds the reader options and ``kafka_decode`` is the transform applied to the
binary ``key``/``value`` frame the connector produces, so it can be used (and
tested) on any frame of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(servers: str, topic: str, group: str | None = None) -> dict:
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
    }
    if group:
        opts["kafka.group.id"] = group
    return opts


def read_kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    reader = spark.readStream.format("kafka")
    for k, v in kafka_source_options(servers, topic).items():
        reader = reader.option(k, v)
    return kafka_decode(reader.load())


def kafka_decode(df: DataFrame, value_only: bool = True, keep=()) -> DataFrame:
    """binary key/value -> UTF-8 strings (value only, like the reference)."""
    value = F.decode(F.col("value"), "UTF-8").alias("value")
    if value_only:
        return df.select(*keep, value)
    return df.select(*keep, F.decode(F.col("key"), "UTF-8").alias("key"), value)
