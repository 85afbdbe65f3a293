"""More replay tests: sessions, window join, keyed processors, timers, TTL,
text-line sources, the file sink, and rule streams."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from sluice import model
from sluice.functions.text import csv_line
from sluice.functions.time import epoch_ms, epoch_us
from sluice.operators import joins, stateful, windows
from sluice.plans import P, load_all
from sluice.sinks import bucketed_lines, write_bucketed_text_stream
from sluice.sources import parse_sensor_csv, read_text_stream
from sluice.streaming import ops
from sluice.streaming import processors as PR
from replay import read_replay, run_to_end, to_event_time, write_replay

DELAY = "5 hours"


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    src = model.arrivals_view(spark, SF001).select("seq", "id", "et", "ts", "vc", "event_type", "arrival")
    far = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    sentinel = src.limit(1).select(
        F.lit(-1).cast("long").alias("seq"), F.lit(-1).cast("long").alias("id"), far.alias("et"),
        F.lit(4102444800).cast("long").alias("ts"), F.lit(0).alias("vc"), F.lit("view").alias("event_type"),
        far.alias("arrival"),
    )
    d = str(tmp_path_factory.mktemp("arr"))
    return src, write_replay(src, ["arrival", "seq"], d, 5, sentinel)


@pytest.fixture(scope="module")
def by_seq(spark, tmp_path_factory):
    src = model.sensor_view(spark, SF001).select("seq", "id", "vc")
    d = str(tmp_path_factory.mktemp("seq"))
    return src, write_replay(src, ["seq"], d, 4)


def test_session_stream_equals_batch(spark, arrivals, tmp_dir):
    src, data = arrivals
    s = to_event_time(read_replay(spark, data, src.schema), "et", "arrival")
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")]
    run_to_end(ops.session_aggregate_append(s, ["id"], "et", "6 hours", DELAY, aggs), "append",
               os.path.join(tmp_dir, "ck"), query_name="w05_stream")
    want = windows.session_windows(src, ["id"], "et", "6 hours", [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")], ["seq"])
    assert rows(spark.table("w05_stream").filter("id >= 0")) == rows(want)


def test_window_join_stream_equals_batch(spark, arrivals, tmp_dir):
    src, data = arrivals
    s = to_event_time(read_replay(spark, data, src.schema), "et", "arrival")
    j = ops.window_join_stream(
        s.filter("event_type = 'click'"), s.filter("event_type = 'purchase'"), "id", "et", "1 day", DELAY, ["seq"], ["seq"]
    ).select("id", "l_seq", "r_seq")
    run_to_end(j, "append", os.path.join(tmp_dir, "ck"), query_name="j01_stream")
    want = joins.window_join(src.filter("event_type = 'click'"), src.filter("event_type = 'purchase'"), "id", "et", "1 day", ["seq"], ["seq"])
    assert rows(spark.table("j01_stream")) == rows(want.select("id", "l_seq", "r_seq"))


@pytest.mark.parametrize(
    "name,make",
    [
        ("st01_state_value_jump", lambda: PR.ValueJump(P.JUMP)),
        ("st02_state_list_top3", lambda: PR.TopK(3)),
        ("st03_state_map_counts", lambda: PR.ValueCounts()),
        ("st05_state_aggregating_avg", lambda: PR.RunningAvg()),
        ("w07_win_count_tumbling", lambda: PR.CountWindow(P.COUNT_SIZE)),
    ],
)
def test_processor_stream_equals_batch(spark, by_seq, tmp_dir, name, make):
    src, data = by_seq
    out = PR.apply_processor(read_replay(spark, data, src.schema), "id", make())
    qn = f"{name}_stream"
    run_to_end(out, "append", os.path.join(tmp_dir, "ck"), query_name=qn)
    want = load_all()[name][0](spark, SF001)
    cols = sorted(want.columns)
    assert rows(spark.table(qn), *cols) == rows(want, *cols)


def test_event_time_timers_stream(spark, arrivals, tmp_dir):
    """ST09: every distinct (key, et + 1 h) timer fires exactly once, after
    the watermark passed it."""
    src, data = arrivals
    s = to_event_time(read_replay(spark, data, src.schema), "et", "arrival")
    s = s.withWatermark("et", DELAY).withColumn("et_ms", F.unix_millis("et")).select("id", "seq", "et", "et_ms")
    out = PR.apply_processor(s, "id", PR.EventTimers(P.TIMER_DELAY_S * 1000), time_mode="EventTime")
    run_to_end(out, "append", os.path.join(tmp_dir, "ck"), query_name="st09_stream")
    got = spark.table("st09_stream").filter("id >= 0")
    assert got.filter("fired_wm_ms < timer_ms").count() == 0
    want = src.select("id", (epoch_ms("et") + P.TIMER_DELAY_S * 1000).alias("timer_ms")).distinct()
    assert rows(got, "id", "timer_ms") == rows(want)


def test_ttl_processor_processing_time(spark):
    """ST06 processor (ProcessingTime mode, one batch pass): with a TTL far
    longer than the run nothing expires, so the old value is the last stored
    reading above the threshold - the batch TTL form with no gap reaching the
    TTL.  (A processing-time stream with availableNow does not stop by
    itself, so the stream form is exercised in batch mode here.)"""
    src = model.sensor_view(spark, SF001).select("seq", "id", "vc")
    got = PR.apply_processor(src, "id", PR.TtlValue(3_600_000, P.SIDE_ALERT), time_mode="ProcessingTime")
    d = src.withColumn("arrival", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("seq")))
    want = stateful.ttl_value(d, "id", "arrival", "vc", 10**9, P.SIDE_ALERT)
    assert rows(got, "seq", "old_value") == rows(want, "seq", "old_value")


def test_text_line_stream_parse(spark, tmp_dir):
    """Text files replayed one per trigger, parsed, rejects kept."""
    lines = model.sensor_lines(model.table(spark, SF001, "events"))
    src = os.path.join(tmp_dir, "lines")
    lines.select("line").repartitionByRange(4, "line").write.text(src)
    stream = read_text_stream(spark, src)
    good, bad = parse_sensor_csv(stream)
    run_to_end(good, "append", os.path.join(tmp_dir, "ck1"), query_name="s09_good_stream")
    run_to_end(bad, "append", os.path.join(tmp_dir, "ck2"), query_name="s09_bad_stream")
    want_good, want_bad = parse_sensor_csv(lines.select("line"))
    assert spark.table("s09_good_stream").count() == want_good.count()
    assert rows(spark.table("s09_bad_stream"), "line") == rows(want_bad, "line")


def test_bucketed_file_sink_stream(spark, by_seq, tmp_dir):
    """K01/K02 stream: hour buckets, files rolled per trigger / record bound."""
    src = model.sensor_view(spark, SF001)
    data = write_replay(src.select("seq", "et", "id", "ts", "vc"), ["seq"], os.path.join(tmp_dir, "r"), 3)
    s = read_replay(spark, data, src.select("seq", "et", "id", "ts", "vc").schema)
    frame = bucketed_lines(s, "et", csv_line("id", "ts", "vc"))
    out = os.path.join(tmp_dir, "out")
    q = write_bucketed_text_stream(frame, out, os.path.join(tmp_dir, "ck"), None, 100).start()
    q.awaitTermination(300)
    assert spark.read.text(out).count() == src.count()
    assert len(glob.glob(os.path.join(out, "bucket=*"))) == src.select(F.date_format("et", "yyyy-MM-dd HH")).distinct().count()


def _rule_input(src):
    return src.select(
        "seq", "id", "vc", "arrival",
        F.when(F.col("event_type") == "signup", 0).otherwise(1).alias("kind"),
        epoch_us("arrival").alias("arr_us"),
    )


def test_broadcast_rule_stream(spark, arrivals, tmp_dir):
    src, data = arrivals
    s = _rule_input(read_replay(spark, data, src.schema)).filter("id >= 0")
    paths = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "out")
    run_to_end(s, "append", os.path.join(tmp_dir, "ck"), foreach_batch=ops.rule_per_batch(*paths, "kind", 0, "vc", "arrival"))
    want = load_all()["j07_broadcast_rule"][0](spark, SF001)
    assert rows(spark.read.parquet(paths[1]), "seq", "threshold") == rows(want, "seq", "threshold")


def test_keyed_rule_processor_stream(spark, arrivals, tmp_dir):
    src, data = arrivals
    s = _rule_input(read_replay(spark, data, src.schema)).filter("id >= 0")
    run_to_end(PR.apply_processor(s, "id", PR.KeyedRule()), "append", os.path.join(tmp_dir, "ck"), query_name="j08_stream")
    want = load_all()["j08_keyed_broadcast_rule"][0](spark, SF001)
    assert rows(spark.table("j08_stream"), "seq", "id", "vc", "threshold") == rows(want, "seq", "id", "vc", "threshold")
