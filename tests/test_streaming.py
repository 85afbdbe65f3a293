"""Replay tests: the same rows as a stream (one file per micro-batch, in
arrival order) give the batch result; restart from a checkpoint resumes."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from sluice import model
from sluice.operators import joins, windows
from sluice.plans import load_all
from sluice.sources.text import text_lines, tokenize
from sluice.streaming import ops
from sluice.streaming import processors as PR
from replay import read_replay, run_to_end, to_event_time, write_replay

DELAY = "5 hours"  # above the largest arrival disorder (4 h): nothing is dropped
def aggs():
    return [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")]


def _source(spark):
    return model.arrivals_view(spark, SF001).select("seq", "id", "et", "ts", "vc", "event_type", "arrival")


def _sentinel(src):
    far = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    return src.limit(1).select(
        F.lit(-1).cast("long").alias("seq"), F.lit(-1).cast("long").alias("id"), far.alias("et"),
        F.lit(4102444800).cast("long").alias("ts"), F.lit(0).alias("vc"), F.lit("view").alias("event_type"),
        far.alias("arrival"),
    )


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    src = _source(spark)
    d = str(tmp_path_factory.mktemp("replay"))
    data = write_replay(src, ["arrival", "seq"], d, 6, _sentinel(src))
    return src, data


def _stream(spark, src, data):
    return to_event_time(read_replay(spark, data, src.schema), "et", "arrival")


def test_tumbling_window_stream_equals_batch(spark, replay, tmp_dir):
    src, data = replay
    agg = ops.window_aggregate_append(_stream(spark, src, data), ["id"], "et", "1 day", DELAY, aggs())
    run_to_end(agg, "append", os.path.join(tmp_dir, "ck"), query_name="w01_stream")
    got = spark.table("w01_stream").filter("id >= 0")
    want = windows.window_aggregate(src, ["id"], "et", "1 day", aggs())
    assert rows(got) == rows(want)


def test_interval_join_stream_equals_batch(spark, replay, tmp_dir):
    src, data = replay
    s = _stream(spark, src, data)
    l = s.filter(F.col("event_type") == "click")
    r = s.filter(F.col("event_type") == "purchase")
    j = ops.interval_join_stream(l, r, "id", "et", -7200, 7200, DELAY, ["seq"], ["seq"])
    run_to_end(j, "append", os.path.join(tmp_dir, "ck"), query_name="j02_stream")
    want = joins.interval_join(
        src.filter("event_type = 'click'"), src.filter("event_type = 'purchase'"), "id", "et", -7200, 7200, ["seq"], ["seq"]
    )
    assert rows(spark.table("j02_stream")) == rows(want)
    assert len(rows(want)) > 0


def test_topn_foreach_batch_equals_batch(spark, replay, tmp_dir):
    src, data = replay
    counts = ops.window_aggregate_append(
        _stream(spark, src, data), ["vc"], "et", "1 day", DELAY, [F.count(F.lit(1)).alias("cnt")], slide="12 hours"
    ).select("window_end", "vc", "cnt")
    out = os.path.join(tmp_dir, "top")
    run_to_end(counts, "append", os.path.join(tmp_dir, "ck"), foreach_batch=ops.topn_per_batch(out, 2))
    got = spark.read.parquet(out).select("window_end", "vc", "cnt", "rank")
    want = load_all()["tk02_topn_window_incremental"][0](spark, SF001)
    assert rows(got, "window_end", "vc", "cnt", "rank") == rows(want, "window_end", "vc", "cnt", "rank")


def test_word_count_update_mode(spark, tmp_dir):
    lines = text_lines(model.table(spark, SF001, "documents").select("doc_id", "text"))
    data = write_replay(lines, ["doc_id", "line_no"], tmp_dir, 4)
    stream = read_replay(spark, data, lines.schema)
    run_to_end(ops.word_count_update(stream), "update", os.path.join(tmp_dir, "ck"), query_name="a02_stream")
    got = spark.table("a02_stream").groupBy("word").agg(F.max("cnt").alias("cnt"))
    want = tokenize(lines).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    assert rows(got) == rows(want)


def test_running_sum_processor_stream(spark, tmp_dir):
    src = model.sensor_view(spark, SF001).select("seq", "id", "vc")
    data = write_replay(src, ["seq"], tmp_dir, 4)
    s = read_replay(spark, data, src.schema)
    out = PR.apply_processor(s, "id", PR.RunningSum())
    run_to_end(out, "append", os.path.join(tmp_dir, "ck"), query_name="st04_stream")
    want = load_all()["st04_state_reducing_sum"][0](spark, SF001)
    assert rows(spark.table("st04_stream"), "seq", "id", "sum_vc") == rows(want, "seq", "id", "sum_vc")


def test_restart_from_checkpoint(spark, replay, tmp_dir):
    """Stop after part of the input, restart from the checkpoint with
    the rest; the file sink holds each window exactly once."""
    src, data = replay
    files = sorted(glob.glob(os.path.join(data, "*.parquet")))
    live = os.path.join(tmp_dir, "live")
    os.makedirs(live)
    for f in files[:3]:
        shutil.copy2(f, live)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        agg = ops.window_aggregate_append(_stream(spark, src, live), ["id"], "et", "1 day", DELAY, aggs())
        q = (
            agg.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
            .outputMode("append").trigger(availableNow=True).start()
        )
        q.awaitTermination(300)

    run()
    first = spark.read.parquet(out).count()
    for f in files[3:]:
        shutil.copy2(f, live)
    run()
    got = spark.read.parquet(out).filter("id >= 0")
    want = windows.window_aggregate(src, ["id"], "et", "1 day", aggs())
    assert 0 < first < got.count()
    assert rows(got) == rows(want)


def test_late_side_output_stream_equals_batch(spark, replay, tmp_dir):
    """Per-batch routing with the carried watermark equals the batch
    split (1 h windows, 3 h bounded disorder)."""
    from sluice.operators.late import split_late

    src, data = replay
    paths = [os.path.join(tmp_dir, p) for p in ("state", "on", "late")]
    fn = ops.split_late_per_batch(*paths, "et", "arrival", 3 * 3600, window="1 hour")
    stream = read_replay(spark, data, src.schema)  # NTZ kept: the split is ours, not Spark's watermark
    run_to_end(stream, "append", os.path.join(tmp_dir, "ck"), foreach_batch=fn)
    _on, want_late = split_late(src, "et", "arrival", 3 * 3600, "1 hour")
    got_late = spark.read.parquet(paths[2]).filter("id >= 0")
    assert rows(got_late, "seq") == rows(want_late, "seq")
    assert spark.read.parquet(paths[1]).filter("id >= 0").count() + got_late.count() == src.count()
