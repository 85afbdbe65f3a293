"""Record shapes and the derived views every operator works on.

The reference works on one sensor record ``(id, ts seconds, vc)``.  Over the
shared ``events`` table that record is the *sensor* view:

    seq = event_id, id = user_id, et = ts, ts = epoch seconds, vc = floor(value)

``arrival`` models delivery order (disorder for watermark tests):
``arrival = et + ((seq * 7919) % 14400) seconds``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.time import epoch_seconds, shift_seconds

# Fixed values of the model (disorder generator of the arrival column).
ARRIVAL_MULTIPLIER = 7919
ARRIVAL_SPREAD_SECONDS = 14400

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("ts", T.LongType(), True),
        T.StructField("vc", T.IntegerType(), True),
    ]
)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sensor(events: DataFrame) -> DataFrame:
    """events -> (seq, id, et, ts, vc, event_type)."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("id"),
        F.col("ts").alias("et"),
        epoch_seconds("ts").alias("ts"),
        F.floor("value").cast("int").alias("vc"),
        F.col("event_type"),
    )


def with_arrival(df: DataFrame, seq: str = "seq", et: str = "et") -> DataFrame:
    delay = (F.col(seq) * ARRIVAL_MULTIPLIER) % ARRIVAL_SPREAD_SECONDS
    return df.withColumn("arrival", shift_seconds(et, delay))


def sensor_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(table(spark, sf_dir, "events"))


def arrivals_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(sensor_view(spark, sf_dir))


def sensor_lines(events: DataFrame) -> DataFrame:
    """Text form ``id,ts,vc`` of each sensor row (S09 input).

    Rows of type ``error`` carry the raw reading (a decimal such as ``6.55``)
    in the third field, which an integer parser rejects; they form the reject
    path of the parser tests.
    """
    third = F.when(F.col("event_type") == "error", F.col("value").cast("string")).otherwise(
        F.floor("value").cast("int").cast("string")
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            epoch_seconds("ts").cast("string"),
            third,
        ).alias("line"),
    )
