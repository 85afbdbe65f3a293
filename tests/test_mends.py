"""Nulls, short lines, gaps, late registrations, writes on retry, spread of
partitionings, and streams started outside the repository folder."""

import os
import subprocess
import sys
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF001, rows
from replay import read_replay, run_to_end, write_replay
from sluice import model
from sluice.functions import text as T
from sluice.functions.time import from_epoch_seconds
from sluice.operators import aggregate, basic, joins, late, partition, stateful, windows
from sluice.plans import P
from sluice.sinks import bucketed_lines
from sluice.sinks.files import write_bucketed_text
from sluice.sources.parse import parse_number, parse_sensor_csv
from sluice.streaming import ops
from sluice.streaming import processors as PR


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    """Sensor rows of which every fifth has no reading, and all of one key's."""
    src = model.sensor_view(spark, SF001).select("seq", "id", "vc")
    gone = (F.col("seq") % 5 == 0) | (F.col("id") == P.SENSOR_1)
    src = src.withColumn("vc", F.when(~gone, F.col("vc")))
    return src, write_replay(src, ["seq"], str(tmp_path_factory.mktemp("nulls")), 4)


def _stream(spark, nulls, processor, name, tmp_dir):
    src, data = nulls
    d = read_replay(spark, data, src.schema)
    run_to_end(PR.apply_processor(d, "id", processor), "append", os.path.join(tmp_dir, "ck"), query_name=name)
    return spark.table(name)


@pytest.mark.parametrize("form", ["ValueJump", "TopK", "ValueCounts", "RunningSum", "RunningAvg", "CountWindow", "SlidingCountWindow"])
def test_null_readings_in_streams_equal_the_tables(spark, nulls, tmp_dir, form):
    src, _ = nulls
    top = F.array_join(F.transform("top", lambda x: x.cast("string")), ",").alias("top3")
    span = [F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.sum("vc").alias("sum_vc")]
    processor, want = {
        "ValueJump": (PR.ValueJump(50), lambda: stateful.value_jump(src, "id", "seq", "vc", 50).select("seq", "id", "vc", "prev")),
        "TopK": (PR.TopK(3), lambda: stateful.rolling_top_k(src, "id", "seq", "vc", 3).select("seq", "id", top)),
        "ValueCounts": (PR.ValueCounts(), lambda: stateful.running_counts_per_value(src, "id", "seq", "vc").select("seq", "id", "vc", "cnt")),
        "RunningSum": (PR.RunningSum(), lambda: stateful.running_sum(src, "id", "seq", "vc", "sum_vc").select("seq", "id", "sum_vc")),
        "RunningAvg": (PR.RunningAvg(), lambda: stateful.running_avg(src, "id", "seq", "vc", "avg_vc").select("seq", "id", F.round("avg_vc", 6).alias("avg_vc"))),
        "CountWindow": (PR.CountWindow(5), lambda: windows.count_window(src, ["id"], "seq", 5, span)),
        "SlidingCountWindow": (PR.SlidingCountWindow(5, 2), lambda: windows.count_window_sliding(src, ["id"], "seq", 5, 2, span)),
    }[form]
    want = want()
    assert rows(_stream(spark, nulls, processor, f"n_{form}", tmp_dir), *want.columns) == rows(want)


def test_null_readings_in_keyed_rules(spark, nulls, tmp_path_factory, tmp_dir):
    src, _ = nulls
    d = src.withColumn("kind", F.when(F.col("seq") % 7 == 0, 0).otherwise(1)).withColumn("arr_us", F.col("seq") * 1_000_000)
    data = write_replay(d, ["arr_us", "seq"], str(tmp_path_factory.mktemp("rules")), 3)
    run_to_end(PR.apply_processor(read_replay(spark, data, d.schema), "id", PR.KeyedRule()), "append", os.path.join(tmp_dir, "ck"), query_name="n_rules")
    t = d.withColumn("arrival", from_epoch_seconds("seq"))
    r = joins.latest_rule(t.filter("kind = 1").drop("kind", "arr_us"), t.filter("kind = 0").select("seq", "id", "vc", "arrival"), "arrival", "vc", ["id"])
    assert rows(spark.table("n_rules")) == rows(r.filter("vc > threshold").select("seq", "id", "vc", "threshold"), "id", "seq", "threshold", "vc") or rows(
        spark.table("n_rules"), "seq", "id", "vc", "threshold"
    ) == rows(r.filter("vc > threshold"), "seq", "id", "vc", "threshold")


def test_stream_starts_from_another_folder(tmp_path, nulls):
    src, data = nulls
    code = f"""
import sys; sys.path.insert(0, {ROOT!r}); sys.path.insert(0, {os.path.join(ROOT, "tests")!r})
from sluice.session import build_session
from sluice.streaming import processors as PR
from replay import read_replay, run_to_end
s = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {str(tmp_path / "c")!r}}})
d = read_replay(s, {data!r}, "seq long, id long, vc int")
run_to_end(PR.apply_processor(d, "id", PR.RunningSum()), "append", {str(tmp_path / "ck")!r}, query_name="t")
print("ROWS", s.table("t").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert f"ROWS {src.count()}" in done.stdout, done.stderr[-2000:]


def test_a_table_leaves_the_processor_as_it_was(spark, nulls):
    p = PR.RunningSum()
    PR.apply_processor(nulls[0], "id", p)
    assert p.presorted is None


def test_full_window_keeps_null_keys(spark):
    d = spark.createDataFrame([(1, "a", 5), (2, None, 6), (3, None, 7), (4, "a", 8)], "seq long, k string, ts long")
    got = windows.window_process(d.withColumn("et", from_epoch_seconds("ts")), ["k"], "et", "10 seconds")
    assert sorted((r["seq"], r["k"], r["count"]) for r in got.collect()) == [(1, "a", 2), (2, None, 2), (3, None, 2), (4, "a", 2)]


def test_min_by_takes_no_null_reading(spark):
    d = spark.createDataFrame([(1, 1, None), (2, 1, 5), (3, 1, 4), (4, 2, None)], "seq long, id long, vc int")
    got = aggregate.keyed_extreme_row(d, "id", "vc", "seq", "min_by")
    assert sorted((r["id"], r["seq"], r["vc"]) for r in got.collect()) == [(1, 3, 4), (2, 4, None)]


def test_short_line_has_null_fields(spark):
    d = spark.createDataFrame([("a,1",), ("b,2,3",), ("",)], "line string")
    assert [r[0] for r in d.select(T.field("line", 2)).collect()] == [None, "3", None]
    good, bad = parse_sensor_csv(d)
    assert good.count() == 1 and bad.count() == 2


def test_strict_numbers_refuse_blanks(spark):
    d = spark.createDataFrame([("12",), (None,)], "t string")
    assert [r[0] for r in d.select(parse_number(F.col("t"), "int", True)).collect()] == [12, None]
    for text in (" 1 ", "1.5", "", "99999999999"):
        with pytest.raises(Exception, match="not a number"):
            spark.createDataFrame([(text,)], "t string").select(parse_number(F.col("t"), "int", True)).collect()


def test_inactivity_gap_inside_a_batch_alerts(spark, tmp_path, tmp_dir):
    d = spark.createDataFrame([(1, 7, 1000), (2, 7, 101_000), (3, 7, 100_000), (4, 7, 101_100)], "seq long, id long, s long")
    d = d.withColumn("et", from_epoch_seconds("s").cast("timestamp")).withColumn("et_ms", F.col("s") * 1000)
    want = stateful.inactivity_alerts(d.select("seq", "id", F.col("et").cast("timestamp_ntz").alias("et")), "id", "et", 86_400)
    assert [(r["seq"], r["gap_s"]) for r in want.collect()] == [(1, 99_000)]
    data = write_replay(d, ["seq"], str(tmp_path), 1)
    s = read_replay(spark, data, d.schema).withWatermark("et", "0 seconds")
    run_to_end(PR.apply_processor(s, "id", PR.InactivityTimer(86_400_000), "EventTime"), "append", os.path.join(tmp_dir, "ck"), query_name="gap")
    assert [tuple(r) for r in spark.table("gap").collect()] == [(7, 87_400_000)]


def test_timer_registers_anew_after_it_fired(spark):
    # the clock passes 10 s + 5 s at 40 s; the same key and time comes again at 50 s
    d = spark.createDataFrame([(1, 1, 10, 10), (2, 1, 10, 11), (3, 2, 30, 40), (4, 1, 10, 50)], "seq long, id long, e long, a long")
    d = d.withColumn("et", from_epoch_seconds("e")).withColumn("arrival", from_epoch_seconds("a"))
    got = stateful.event_timers(d, "id", "et", "arrival", 0, 5)
    assert sorted((r["id"], r["timer_ms"], r["fired_at_ms"]) for r in got.collect() if r["id"] == 1) == [(1, 15_000, 40_000), (1, 15_000, 50_000)]


def test_unheard_input_holds_the_clock_until_idle(spark):
    d = spark.createDataFrame([(i, 0, t) for i, t in enumerate((0, 100, 3599, 3700, 3701))], "seq long, src int, t long")
    d = d.withColumn("et", from_epoch_seconds("t")).withColumn("arrival", from_epoch_seconds("t"))
    got = late.combined_watermark(d, "src", [0, 1], "et", "arrival", 0, 3600)
    assert [r["wm_before_us"] for r in got.orderBy("seq").collect()] == [None, None, None, 3599_000_000, 3700_000_000]


def test_an_hours_delay_makes_fewer_rows_late(spark):
    a = model.arrivals_view(spark, SF001)
    n = {d: late.split_late(a, "et", "arrival", d)[1].count() for d in (P.WATERMARK_DELAY_S, P.WATERMARK_DELAY_STRESS_S)}
    assert (n[P.WATERMARK_DELAY_S] >= n[P.WATERMARK_DELAY_STRESS_S]) == (P.WATERMARK_DELAY_S <= P.WATERMARK_DELAY_STRESS_S)


def test_lost_state_is_an_error(spark, tmp_dir):
    assert ops.previous_state(spark, os.path.join(tmp_dir, "none"), 0) is None
    with pytest.raises(RuntimeError):
        ops.previous_state(spark, os.path.join(tmp_dir, "none"), 3)


def test_interval_join_far_and_narrow(spark):
    day = 86_400
    a = [(i, i % 3, i * 1000) for i in range(200)]
    b = [(i, i % 3, i * 1000 + 10 * day + i % 4) for i in range(200)]
    df = lambda r: spark.createDataFrame(r, "seq long, id long, ts long").withColumn("et", from_epoch_seconds("ts"))
    got = joins.interval_join(df(a), df(b), "id", "et", 10 * day, 10 * day + 1, ["seq"], ["seq"])
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and 10 * day <= y[2] - x[2] <= 10 * day + 1)
    assert rows(got, "l_seq", "r_seq") == want


def test_interval_join_late_gives_three_whole_frames(spark):
    a = model.arrivals_view(spark, SF001)
    left, right = a.filter("event_type = 'click'"), a.filter("event_type = 'purchase'")
    joined, late_left, late_right = joins.interval_join_late(left, right, "id", "et", "arrival", -3600, 3600, 600, ["seq"], ["seq"])
    assert late_left.columns == left.columns and late_right.columns == right.columns
    gone = {r[0] for r in late_left.select("seq").collect()} | {r[0] for r in late_right.select("seq").collect()}
    used = {x for r in joined.collect() for x in (r["l_seq"], r["r_seq"])}
    assert gone and not gone & used


def test_interval_join_late_stream_equals_table(spark, tmp_path):
    a = model.arrivals_view(spark, SF001).filter("event_type in ('click', 'purchase')")
    a = a.select("seq", "id", "ts", "vc", "et", "arrival", F.when(F.col("event_type") == "click", "l").otherwise("r").alias("side"))
    data = write_replay(a, ["arrival", "seq"], str(tmp_path / "in"), 5)
    out = str(tmp_path / "out")
    run = ops.interval_join_late_per_batch(out, "side", "id", "et", "arrival", -3600, 3600, 600, ["seq"], ["seq"])
    run_to_end(read_replay(spark, data, a.schema), "append", str(tmp_path / "ck"), foreach_batch=run)
    want = joins.interval_join_late(a.filter("side = 'l'"), a.filter("side = 'r'"), "id", "et", "arrival", -3600, 3600, 600, ["seq"], ["seq"])
    for name, w, cols in zip(("joined", "late_left", "late_right"), want, (("id", "l_seq", "r_seq"), ("seq", "id", "vc"), ("seq", "id", "vc"))):
        assert rows(spark.read.parquet(f"{out}/{name}"), *cols) == rows(w, *cols)
        assert w.count()


@pytest.mark.parametrize("mode", ["EventTime", "ProcessingTime"])
def test_clocks_that_a_function_reads(spark, tmp_path, mode):
    d = spark.createDataFrame([(i, i % 3, 1000 + i * 100) for i in range(30)], "seq long, id long, s long").withColumn("et", from_epoch_seconds("s").cast("timestamp"))
    s = read_replay(spark, write_replay(d, ["seq"], str(tmp_path / "in"), 3), d.schema).withWatermark("et", "10 seconds")
    began = time.time() * 1000
    read = PR.apply_processor(s, "id", PR.ClockReader(mode), mode)
    if mode == "EventTime":
        run_to_end(read, "append", str(tmp_path / "ck"), query_name="clock_EventTime")
    else:  # never at its end by itself: processing time goes on
        w = read.writeStream.outputMode("append").format("memory").queryName("clock_ProcessingTime")
        q = w.option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start()
        _wait(lambda: spark.table("clock_ProcessingTime").count() >= 30, q)
    got = spark.table(f"clock_{mode}").orderBy("seq").collect()
    assert len(got) == 30
    if mode == "EventTime":  # the batch before's latest row, less the delay
        assert [r["watermark_ms"] for r in got] == [0] * 10 + [(1900 - 10) * 1000] * 10 + [(2900 - 10) * 1000] * 10
    else:
        assert all(began <= r["processing_ms"] <= time.time() * 1000 for r in got)


@pytest.mark.parametrize("name", ["equals", "event_time", "parsed", "keyed", "labelled"])
def test_one_transform_runs_as_table_and_as_stream(spark, nulls, tmp_dir, name):
    src, data = nulls
    transform = {
        "equals": lambda d: basic.filter_equals(d, "id", P.SENSOR_1),
        "event_time": lambda d: late.assign_event_time(d.withColumn("ts", F.col("seq")), "ts", "t"),
        "parsed": lambda d: parse_sensor_csv(d.select("seq", T.csv_line("id", "seq", F.coalesce("vc", F.lit(0))).alias("line")))[0],
        "keyed": lambda d: d.groupBy("id").agg(F.sum("vc").alias("s"), F.min_by("vc", "seq").alias("f")),
        "labelled": lambda d: joins.union_all(d.filter("vc > 10"), d.filter("vc <= 10")),
    }[name]
    mode = "complete" if name == "keyed" else "append"
    run_to_end(transform(read_replay(spark, data, src.schema)), mode, os.path.join(tmp_dir, "ck"), query_name=f"c01_{name}")
    assert rows(spark.table(f"c01_{name}")) == rows(transform(src))


def test_connected_join_stream_equals_table(spark, tmp_path, tmp_dir):
    o = model.table(spark, SF001, "orders").select("o_custkey", "o_orderkey")
    c = model.table(spark, SF001, "customer").select("c_custkey", "c_name")
    so = read_replay(spark, write_replay(o, ["o_orderkey"], str(tmp_path / "o"), 3), o.schema)
    sc = read_replay(spark, write_replay(c, ["c_custkey"], str(tmp_path / "c"), 2), c.schema)
    args = ("c_custkey", "o_custkey", ["c_custkey", "c_name"], ["o_orderkey"])
    run_to_end(joins.connected_join(sc, so, *args), "append", os.path.join(tmp_dir, "ck"), query_name="j04_stream")
    assert rows(spark.table("j04_stream")) == rows(joins.connected_join(c, o, *args))


def test_rich_map_opens_and_closes_once_a_task(spark, tmp_dir):
    class Counting(basic.RichMap):
        def __init__(self, folder):
            self.folder = folder

        def open(self, partition_id):
            self.name = f"{self.folder}/{partition_id}"
            open(f"{self.name}.opened", "x").close()

        def map(self, batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch

        def close(self):
            open(f"{self.name}.closed", "x").close()

    d = spark.range(1000).repartition(4)
    assert basic.rich_map(d, lambda: Counting(tmp_dir), "id long").count() == 1000
    assert sorted(os.listdir(tmp_dir)) == [f"{i}.{x}" for i in range(4) for x in ("closed", "opened")]


def test_shuffle_and_rebalance_spread_evenly(spark):
    one = spark.range(10_000).coalesce(1)
    for spread, slack in ((partition.partition_shuffle, 0.3), (partition.partition_rebalance, 0.02)):
        sizes = [r["count"] for r in spread(one, 8).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 1250 * (1 + slack) and min(sizes) >= 1250 * (1 - slack)


def test_bucketed_text_has_the_lines_and_no_more_on_retry(spark, tmp_dir):
    s = model.sensor_view(spark, SF001)
    frame = bucketed_lines(s.filter("seq < 40"), "et", T.csv_line("id", "ts", "vc"))
    for _ in range(2):
        write_bucketed_text(frame, os.path.join(tmp_dir, "k01"))
    got = spark.read.text(os.path.join(tmp_dir, "k01")).select(F.col("bucket").cast("string"), "value")
    assert rows(got) == rows(frame.select("bucket", "value"))
    write_bucketed_text(frame, os.path.join(tmp_dir, "k02"), max_bytes_per_file=30)
    got = spark.read.text(os.path.join(tmp_dir, "k02")).select(F.col("bucket").cast("string"), "value")
    assert rows(got) == rows(frame.select("bucket", "value"))
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(tmp_dir, "k02")) for f in fs if f.startswith("part-")]
    assert max(sizes) < 30 + 60 and len(sizes) >= 20


@pytest.mark.parametrize("kind", ["tumbling", "sliding"])
def test_processing_time_windows_on_a_stream(spark, nulls, tmp_dir, kind):
    src, data = nulls
    size, slide = ("1 second", None) if kind == "tumbling" else ("2 seconds", "1 second")
    d = read_replay(spark, data, src.schema, files_per_trigger=10)
    w = ops.processing_time_windows(d, ["id"], [F.count(F.lit(1)).alias("cnt")], size, slide)
    run_to_end(w, "complete", os.path.join(tmp_dir, "ck"), query_name=f"pt_{kind}")
    total = spark.table(f"pt_{kind}").agg(F.sum("cnt")).first()[0]
    assert total == src.count() * (2 if kind == "sliding" else 1)


def test_processing_time_sessions_on_a_stream(spark, nulls, tmp_dir):
    src, _ = nulls
    data = os.path.join(tmp_dir, "in")
    src.coalesce(1).write.parquet(data)
    w = ops.processing_time_windows(read_replay(spark, data, src.schema), ["id"], [F.count(F.lit(1)).alias("cnt")], "1 second", session=True)
    q = w.writeStream.outputMode("append").format("memory").queryName("pt_session").option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(processingTime="1 second").start()

    def done():  # later rows move the clock on and close the first sessions
        if q.lastProgress and q.lastProgress["batchId"] >= 0:
            time.sleep(1.5)
            src.limit(1).write.mode("append").parquet(data)
        return (spark.table("pt_session").filter("cnt > 1").agg(F.sum("cnt")).first()[0] or 0) > 0

    _wait(done, q)
    first = spark.table("pt_session").orderBy("window_start").groupBy("id").agg(F.min_by("cnt", "window_start").alias("cnt"))
    assert rows(first.filter("cnt > 1")) == rows(src.groupBy("id").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"))


def _wait(done, query, seconds=90):
    end = time.time() + seconds
    try:
        while time.time() < end and not done():
            time.sleep(1)
    finally:
        query.stop()


def test_processing_time_timer_fires(spark, nulls, tmp_dir):
    src, data = nulls
    d = PR.apply_processor(read_replay(spark, data, src.schema, 10), "id", PR.InactivityTimer(1000), "ProcessingTime")
    q = d.writeStream.outputMode("append").format("memory").queryName("st10").option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(processingTime="1 second").start()
    keys = src.select("id").distinct().count()
    _wait(lambda: spark.table("st10").count() >= keys, q)
    assert spark.table("st10").select("id").distinct().count() == keys
