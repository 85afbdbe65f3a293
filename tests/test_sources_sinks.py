import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from sluice import model
from sluice.functions.text import csv_line
from sluice.operators import basic, partition
from sluice.sinks import IdempotentBatchWriter, bucketed_lines, kafka_keyed_frame, write_bucketed_text
from sluice.sources import datagen_batch, from_collection, kafka_decode, parse_int_line, read_text


def test_read_text_file_and_dir(spark, tmp_dir):
    p = os.path.join(tmp_dir, "words.txt")
    with open(p, "w") as f:
        f.write("hello flink\nhello world\nhello java\n")
    assert sorted(r["line"] for r in read_text(spark, p).collect()) == ["hello flink", "hello java", "hello world"]
    assert read_text(spark, tmp_dir).count() == 3


def test_datagen(spark):
    got = datagen_batch(spark, 5, 2)
    assert [r["value"] for r in got.orderBy("n").collect()] == [f"Number:{i}" for i in range(5)]


def test_kafka_round_trip(spark):
    s = model.sensor_view(spark, SF001)
    frame = kafka_keyed_frame(s, csv_line("id", "ts", "vc"), "ws", keep=["seq"])
    back = kafka_decode(frame, value_only=False, keep=["seq"])
    want = s.select("seq", F.col("id").cast("string").alias("key"), csv_line("id", "ts", "vc").alias("value"))
    assert rows(back) == rows(want)


def test_kafka_options():
    from sluice.sinks.kafka import kafka_sink_options
    from sluice.sources.kafka import kafka_source_options

    assert kafka_source_options("h:1", "ws", "g") == {"kafka.bootstrap.servers": "h:1", "subscribe": "ws", "startingOffsets": "latest", "kafka.group.id": "g"}
    assert "kafka.group.id" not in kafka_source_options("h:1", "ws")
    assert kafka_sink_options("h:1", "/ck") == {"kafka.bootstrap.servers": "h:1", "checkpointLocation": "/ck"}


def test_strict_parse_fails(spark):
    df = from_collection(spark, [("6.55",)], "line string")
    assert parse_int_line(df).collect()[0]["n"] is None
    with pytest.raises(Exception):
        parse_int_line(df, strict=True).collect()


def test_bucketed_text_sink(spark, tmp_dir):
    s = model.sensor_view(spark, SF001)
    frame = bucketed_lines(s, "et", csv_line("id", "ts", "vc"))
    out = os.path.join(tmp_dir, "out")
    write_bucketed_text(frame, out, max_records_per_file=50)
    dirs = glob.glob(os.path.join(out, "bucket=*"))
    assert len(dirs) == frame.select("bucket").distinct().count()
    back = spark.read.text(out)
    assert back.count() == s.count()


def test_idempotent_batch_writer(spark, tmp_dir):
    out = os.path.join(tmp_dir, "sink")
    w = IdempotentBatchWriter(out)
    batch = from_collection(spark, [(1,), (2,)], "x int")
    w(batch, 7)
    w(batch, 7)  # replay of the same batch
    w(batch, 8)
    assert spark.read.parquet(out).count() == 4


def test_rich_map_lifecycle(spark):
    df = from_collection(spark, [(i, i) for i in range(10)], "seq long, vc int").repartition(3)
    got = basic.rich_map(df, basic.AddOneMap, "seq long, vc int")
    assert rows(got, "vc") == [(i + 1,) for i in range(10)]


def test_partition_custom_and_broadcast(spark):
    df = from_collection(spark, [(i, k) for i, k in enumerate([-3, -1, 0, 5, 6, 7])], "seq long, k long")
    got = partition.with_partition_id(partition.partition_custom(df, "k", 4))
    assert all(r["pid"] == r["k"] % 4 for r in got.collect())
    b = partition.with_partition_id(partition.partition_broadcast(df.select("seq"), 3))
    assert b.count() == 18 and all(r["pid"] == r["copy"] for r in b.collect())
    assert partition.partition_global(df).rdd.getNumPartitions() == 1
