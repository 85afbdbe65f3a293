"""Bounded state, two-phase and rolling sinks, the line log, heavy joins, user
code over windows, and state read back."""

import glob
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, rows
from replay import read_replay, run_to_end, write_replay
from sluice import model
from sluice.functions.time import epoch_us, from_epoch_seconds
from sluice.operators import joins, late, user_windows
from sluice.operators.rolling import running_aggregate
from sluice.sinks.files import RollingTextWriter
from sluice.sinks.two_phase import TwoPhaseText, TwoPhaseTextWriter, committed
from sluice.sources.replayable import LineLog, LineLogReader, write_log
from sluice.streaming import ops
from sluice.streaming import processors as PR


def _size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_thousands_of_blocks_need_no_larger_plan(spark):
    d = spark.range(40_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), (F.col("id") % 7).alias("v")).cache()

    def plan(rows_per_block):
        got = running_aggregate(d, ["k"], "seq", [("s", "sum", F.col("v"))], rows_per_block)
        return got, got._jdf.queryExecution().optimizedPlan().toString()

    few, small = plan(5_000)
    many, large = plan(40)  # 1,000 blocks
    assert abs(len(large) - len(small)) < 200
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(d.select("seq", F.sum("v").over(w).alias("s")))
    assert rows(many, "seq", "s") == want and rows(few, "seq", "s") == want


# ------------------------------------------------------------ interval join


def test_interval_state_stays_bounded(spark, tmp_path):
    """Batches of equal size: what is kept does not grow, and the three
    outputs are those of the table form."""
    rnd = random.Random(11)
    data = [(i, rnd.choice("lr"), rnd.randrange(4), 60 * i - rnd.choice([0, 30, 400, 3000]), 60 * i) for i in range(400)]
    df = spark.createDataFrame(data, "seq long, side string, id long, ts long, arr long")
    df = df.withColumn("et", from_epoch_seconds("ts")).withColumn("arrival", from_epoch_seconds("arr")).drop("ts", "arr").coalesce(1).cache()
    out, held = str(tmp_path / "out"), []
    run = ops.interval_join_late_per_batch(out, "side", "id", "et", "arrival", -600, 300, 900, ["seq"], ["seq"])
    for n in range(20):
        batch = df.filter((F.col("seq") >= 20 * n) & (F.col("seq") < 20 * n + 20))
        run(batch, n)
        if n in (7, 14):
            run(batch, n)  # a batch that runs again
        held.append((len(glob.glob(f"{out}/rows/bucket=*")), _size(f"{out}/rows")))
    assert max(h[0] for h in held[14:]) <= max(h[0] for h in held[4:10]) and max(h[1] for h in held[14:]) <= 1.3 * max(h[1] for h in held[4:10])
    want = joins.interval_join_late(df.filter("side = 'l'"), df.filter("side = 'r'"), "id", "et", "arrival", -600, 300, 900, ["seq"], ["seq"])
    for name, w, cols in zip(("joined", "late_left", "late_right"), want, (("id", "l_seq", "r_seq"), ("seq", "id"), ("seq", "id"))):
        assert rows(spark.read.parquet(f"{out}/{name}"), *cols) == rows(w, *cols) and w.count()


# ------------------------------------------------------------ two phases


def test_two_phase_stream(spark, tmp_path):
    spark.dataSource.register(TwoPhaseText)
    src = spark.range(500).select("id", F.concat(F.lit("line "), F.col("id")).alias("value"))
    data = write_replay(src, ["id"], str(tmp_path / "in"), 4)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    s = read_replay(spark, data, src.schema).select("value").repartition(3)
    for _ in range(2):  # the second finds nothing new
        q = s.writeStream.format("two_phase_text").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = committed(spark, out)
    assert rows(got, "value") == rows(src, "value") and got.select("batch_id").distinct().count() == 4


def test_commits_are_whole_and_once(spark, tmp_path):
    import pyarrow as pa

    out = str(tmp_path / "out")
    batch = lambda *lines: iter([pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])])
    w = TwoPhaseTextWriter(out)
    assert committed(spark, out).count() == 0
    w.write(batch("lost task"))  # killed before it could report
    first = [w.write(batch("a", "b")), w.write(iter([]))]
    again = [w.write(batch("a")), w.write(batch("b", None))]
    w.commit(first, 0)
    w.commit(again, 0)  # the batch ran again after its commit
    gone = [w.write(batch("aborted")), None]
    w.abort(gone, 1)
    w.commit([w.write(batch("c"))], 1)
    assert rows(committed(spark, out)) == [("a", 0), ("b", 0), ("c", 1)]
    assert len(glob.glob(f"{out}/data/*")) == 3 and not glob.glob(f"{out}/commits/_*")


# ------------------------------------------------------------ rolled files


def test_files_roll_by_bytes_across_batches(spark, tmp_path):
    rnd, clock = random.Random(3), [0.0]
    lines = [(f"b{i % 2}", f"{i:05d} " + "x" * rnd.randrange(200)) for i in range(900)]
    out = str(tmp_path / "out")
    write = RollingTextWriter(out, str(tmp_path / "state"), max_bytes=5_000, max_age_s=60, now=lambda: clock[0])
    for n in range(9):
        clock[0] += 1
        batch = spark.createDataFrame(lines[100 * n : 100 * n + 100], "bucket string, value string")
        write(batch, n)
        if n == 4:
            write(batch, n)
    full = [os.path.getsize(f) for f in glob.glob(f"{out}/**/*.txt", recursive=True)]
    assert len(full) > 10 and min(full) >= 5_000  # nothing small so far
    clock[0] += 100
    write(spark.createDataFrame([("b0", "late")], "bucket string, value string"), 9)  # old lines wait no longer
    write.finish(spark, 10)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{out}/**/*.txt", recursive=True)]
    assert max(sizes) <= 5_000 + 210 and len(sizes) <= len(full) + 4
    assert sorted(r.value for r in spark.read.text(out).select("value").collect()) == sorted([v for _, v in lines] + ["late"])


# ------------------------------------------------------------ line log


def test_line_log_resumes_at_its_offset(spark, tmp_path):
    spark.dataSource.register(LineLog)
    events = model.arrivals_view(spark, SF001).withColumn("arr", epoch_us("arrival"))
    log, ck = str(tmp_path / "log"), str(tmp_path / "ck")
    total = write_log(events, F.concat_ws(",", "seq", "id", "vc"), "arr", ["seq"], log, 150)
    want = [r.seq for r in events.orderBy("arr", "seq").collect()]
    assert total == len(want)
    s = spark.readStream.format("line_log").option("path", log).option("rowsPerBatch", 200).option("checkpoint", ck).load()
    seen: dict = {}

    def keep(batch, n):
        seen[n] = [(r.offset, int(r.line.split(",")[0])) for r in batch.collect()]

    for stop_at in (3, None):
        q = s.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(processingTime="0 seconds").start()
        for _ in range(600):
            if q.exception() or (len(seen) >= stop_at if stop_at else sum(map(len, seen.values())) >= total):
                break
            q.awaitTermination(0.2)
        q.stop()
        assert q.exception() is None
    got = [r for n in sorted(seen) for r in sorted(seen[n])]
    assert got == list(enumerate(want))
    assert all(len(b) <= 200 for b in seen.values()) and len(seen) == -(-total // 200)


def test_line_log_ranges(spark, tmp_path):
    log = str(tmp_path / "log")
    write_log(spark.range(25), F.col("id").cast("string"), "id", [], log, 10)
    r = LineLogReader(log, None, None)
    assert r.initialOffset() == {"offset": 0} and r.latestOffset() == {"offset": 25}
    parts = r.partitions({"offset": 7}, {"offset": 23})
    assert [(p.start, p.end) for p in parts] == [(7, 10), (10, 20), (20, 23)] and r.partitions({"offset": 5}, {"offset": 5}) == []
    assert [x for p in parts for b in r.read(p) for x in b.column("offset").to_pylist()] == list(range(7, 23))
    with pytest.raises(ValueError):
        LineLogReader(log, 5, None)


# ------------------------------------------------------------ heavy keys


def test_heavy_keys_are_split(spark):
    n = 9_000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 400).cast("long").alias("k"), F.col("id").alias("a"))
    right = spark.range(500).select((F.col("id") % 100).alias("key"), F.col("id").alias("b"))
    right = right.unionByName(spark.range(2_000).select(F.lit(5).cast("long").alias("key"), (F.col("id") + 1_000).alias("b")))
    got = joins.heavy_join(left, right, ["k"], ["key"], ["a"], ["key", "b"], rows_per_part=300)
    want = left.join(right, F.col("k") == F.col("key")).select("a", "key", "b")
    assert rows(got) == rows(want)
    heavy, found = joins.heavy_keys(left, right, ["k"], ["key"], 300)
    assert sorted(map(tuple, heavy.collect())) == [(1, True, 11), (5, False, 7)] and found == 2
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in text
    plain = joins.heavy_join(left, right, ["k"], ["key"], ["a"], ["key", "b"])
    assert rows(plain) == rows(want) and "_part" not in plain._jdf.queryExecution().optimizedPlan().toString()


# ------------------------------------------------------------ user code


@pytest.mark.parametrize("rows_per_block", [50, 1 << 18])
def test_a_users_median_of_each_window(spark, rows_per_block):
    src = model.sensor_view(spark, SF001).select("seq", "id", "et", "vc")
    src = src.withColumn("k", F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id"))).withColumn("vc", F.when(F.col("seq") % 11 > 0, F.col("vc")))
    w = F.window("et", "5 days")
    want = src.groupBy("k", w.alias("w")).agg(F.expr("percentile(vc, 0.5)").alias("median"), F.count("vc").alias("n"))
    want = want.select("k", (F.unix_micros(F.col("w.start").cast("timestamp")) / 1000).cast("long").alias("s"), "median", "n")
    got = user_windows.window_median(src, ["k"], "et", "vc", "5 days", rows_per_block=rows_per_block)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select("k", "window_start", "median", "n_values").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


# ------------------------------------------------------------ late rows, state


def test_late_rows_of_a_stateful_operator(spark, tmp_path):
    """Equal to the table form, also when stopped and started in between."""
    src = model.arrivals_view(spark, SF001).select("seq", (F.col("id") % 4).alias("part"), "et", "arrival")
    flat = src.select("seq", "part", epoch_us("et").alias("et_us"), epoch_us("arrival").alias("arr_us"))
    data = write_replay(flat, ["arr_us", "seq"], str(tmp_path / "in"), 6)
    files = sorted(glob.glob(f"{data}/*.parquet"))
    for window in (None, 3600):
        out, live = str(tmp_path / f"out{window}"), str(tmp_path / f"live{window}")
        os.makedirs(live)
        for some in (files[:3], files[3:]):
            for f in some:
                os.link(f, os.path.join(live, os.path.basename(f)))
            s = PR.apply_processor(read_replay(spark, live, flat.schema), "part", PR.LateRouter("part", 1800, window))
            q = s.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ck").trigger(availableNow=True).start()
            q.awaitTermination(200)
        on, lt = late.split_late(src, "et", "arrival", 1800, window and f"{window} seconds", keys=["part"])
        got = spark.read.parquet(out)
        assert rows(got.filter("late"), "seq") == rows(lt, "seq") and rows(got.filter("not late"), "seq") == rows(on, "seq") and lt.count() > 10


def test_state_is_read_back_and_seeds_another_query(spark, tmp_path):
    src = model.sensor_view(spark, SF001).select("seq", "id", "vc")
    half = src.count() // 2
    want = rows(src.groupBy("id").agg(F.sum("vc").alias("v")))

    def totals(df, name, seed, partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            data = write_replay(df, ["seq"], str(tmp_path / name), 2)
            s = PR.apply_processor(read_replay(spark, data, df.schema), "id", PR.RunningSum(), initial_state=seed)
            run_to_end(s, "append", str(tmp_path / f"{name}-ck"), query_name=name)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        return PR.read_state(spark, str(tmp_path / f"{name}-ck"), "total", "id")

    first = totals(src.filter(F.col("seq") < half), "st_first", None, 3)
    assert rows(first, "id", "v") == rows(src.filter(F.col("seq") < half).groupBy("id").agg(F.sum("vc").alias("v")))
    second = totals(src.filter(F.col("seq") >= half), "st_second", first, 5)
    assert rows(second, "id", "v") == want


def test_a_hot_key_of_a_stream_is_cut(spark, tmp_path):
    """40 % of the rows have one key, a null one."""
    rnd = random.Random(9)
    data = [(i, None if rnd.random() < 0.4 else rnd.randint(0, 30), rnd.choice([None, *range(-20, 50)])) for i in range(1200)]
    src = spark.createDataFrame(data, "seq long, id long, vc long").coalesce(1).cache()
    specs = [("s", "sum", F.col("vc")), ("n", "count", F.col("vc")), ("top", "max", F.col("vc"))]
    out = str(tmp_path / "out")
    run = ops.running_aggregate_per_batch(out, str(tmp_path / "state"), ["id"], "seq", specs, rows_per_block=50)
    for n, (a, z) in enumerate([(0, 500), (500, 501), (600, 600), (501, 1200)]):
        batch = src.filter((F.col("seq") >= a) & (F.col("seq") < z))
        run(batch, n)
        if n == 1:
            run(batch, n)
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = src.select("seq", F.sum("vc").over(w).alias("s"), F.count("vc").over(w).alias("n"), F.max("vc").over(w).alias("top"))
    key = lambda r: r[0]
    got = spark.read.parquet(out).select("seq", "s", "n", "top").collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want.collect()), key=key)
