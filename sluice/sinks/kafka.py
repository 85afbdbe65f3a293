"""K04/K05 frames in the Kafka sink's shape (``topic``, ``key``, ``value``
binary).  ``kafka_sink_options`` holds the writer options; the connector
itself is deployment-provided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kafka_value_frame(df: DataFrame, line: Column, topic: str, keep=()) -> DataFrame:
    """String value, no key."""
    return df.select(*keep, F.lit(topic).alias("topic"), F.encode(line, "UTF-8").alias("value"))


def kafka_keyed_frame(df: DataFrame, line: Column, topic: str, keep=()) -> DataFrame:
    """key = first comma field, value = the whole line, both UTF-8."""
    return df.select(
        *keep,
        F.lit(topic).alias("topic"),
        F.encode(F.split(line, ",").getItem(0), "UTF-8").alias("key"),
        F.encode(line, "UTF-8").alias("value"),
    )


def kafka_sink_options(servers: str, checkpoint: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "checkpointLocation": checkpoint}
