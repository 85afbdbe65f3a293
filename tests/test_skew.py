"""Skew safety: the block-decomposed operators equal the plain (one task per
key) definitions when one key holds a large share of all rows, with block
widths small enough that every key spans many blocks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from sluice.functions.time import epoch_ms, from_epoch_seconds
from sluice.operators import aggregate as A
from sluice.operators import joins, late, stateful
from sluice.operators.rolling import find_cut, keyed_neighbour, running_aggregate, with_blocks
from sluice.operators.udf import custom_aggregate
from sluice.operators.windows import session_numbers
from sluice.sources import from_collection


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(7)
    data = []
    for seq in range(3000):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 40)
        t = seq * 60 + rnd.randint(0, 50)
        data.append((seq, key, t, rnd.randint(-50, 300), t + rnd.randint(0, 7200)))
    df = from_collection(spark, data, "seq long, id long, ts long, vc int, arr long")
    return (
        df.withColumn("et", from_epoch_seconds("ts"))
        .withColumn("arrival", from_epoch_seconds("arr"))
        .withColumn("t_us", F.col("ts") * 1_000_000)
        .cache()
    )


def test_running_aggregate_matches_window(hot):
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("seq", F.sum("vc").over(w).alias("s"), F.max("vc").over(w).alias("m"), F.count(F.lit(1)).over(w).alias("c"))
    got = running_aggregate(hot, ["id"], "seq", [("s", "sum", F.col("vc")), ("m", "max", F.col("vc")), ("c", "count", F.lit(1))], 37)
    assert rows(got, "seq", "s", "m", "c") == rows(want)


def test_running_aggregate_exclusive_global(hot):
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = hot.select("seq", F.max("vc").over(w).alias("m"))
    got = running_aggregate(hot, [], "seq", [("m", "max", F.col("vc"))], 101, exclusive=True)
    assert rows(got, "seq", "m") == rows(want)


@pytest.mark.parametrize("direction", [-1, 1])
def test_neighbour_matches_lag_lead(hot, direction):
    w = Window.partitionBy("id").orderBy("seq")
    fn = F.lag if direction < 0 else F.lead
    want = hot.select("seq", fn("vc", 1, 0).over(w).alias("nb"))
    got = keyed_neighbour(hot, ["id"], "seq", "vc", "nb", direction, 0, 29)
    assert rows(got, "seq", "nb") == rows(want)


def test_session_numbers(hot):
    gap = 300 * 1_000_000
    w = Window.partitionBy("id").orderBy("t_us", "seq")
    prev = F.lag("t_us").over(w)
    flags = hot.withColumn("f", F.when(prev.isNull() | (F.col("t_us") - prev >= gap), 1).otherwise(0))
    want = flags.select("seq", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = session_numbers(hot, ["id"], "t_us", gap, ["seq"], 60)
    assert rows(got, "seq", "_sess") == rows(want)


def test_rolling_top_k(hot):
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("seq", F.slice(F.sort_array(F.collect_list("vc").over(w), False), 1, 3).alias("top"))
    got = stateful.rolling_top_k(hot, "id", "seq", "vc", 3, rows_per_block=64)
    assert rows(got, "seq", "top") == rows(want)


def test_keyed_top_k(hot):
    w = Window.partitionBy("id").orderBy(F.col("vc").desc(), F.col("seq"))
    want = hot.withColumn("rank", F.row_number().over(w)).filter("rank <= 3").select("id", "vc", "seq", "rank")
    got = A.keyed_top_k(hot.repartition(7), ["id"], "vc", 3, "seq")
    assert rows(got, "id", "vc", "seq", "rank") == rows(want)


def test_custom_aggregate_merge(hot):
    want = hot.groupBy("id").agg(F.round(F.avg("vc"), 6).alias("r"))
    got = custom_aggregate(hot.repartition(5), ["id"], "vc").select("id", F.round("result", 6).alias("r"))
    assert rows(got) == rows(want)


def test_latest_rule_asof(hot):
    cfg = hot.filter(F.col("seq") % 5 == 0)
    data = hot.filter(F.col("seq") % 5 != 0)
    got = joins.latest_rule(data.select("seq", "id", "vc", "arrival"), cfg.select("seq", "id", "vc", "arrival"), "arrival", "vc", rows_per_block=150)
    # brute force: latest config (by arrival, then seq) with arrival <= the row's
    c = [(r["arr"], r["seq"], r["vc"]) for r in cfg.collect()]
    want = []
    for r in data.collect():
        best = max((x for x in c if x[0] <= r["arr"]), default=None)
        want.append((r["seq"], best[2] if best else 0))
    assert rows(got, "seq", "threshold") == sorted(want)


def test_interval_join_bucketed(hot):
    l = hot.filter(F.col("seq") % 3 == 0)
    r = hot.filter(F.col("seq") % 3 == 1)
    got = joins.interval_join(l, r, "id", "et", -900, 600, ["seq"], ["seq"])
    a = l.select(F.col("seq").alias("ls"), F.col("id").alias("li"), F.col("ts").alias("lt"))
    b = r.select(F.col("seq").alias("rs"), F.col("id").alias("ri"), F.col("ts").alias("rt"))
    cond = (a.li == b.ri) & (b.rt >= a.lt - 900) & (b.rt <= a.lt + 600)
    want = a.join(b, cond).select("ls", "rs")
    assert rows(got, "l_seq", "r_seq") == rows(want)


def test_late_split_equals_definition(hot):
    on, lt = late.split_late(hot, "et", "arrival", 1800)
    w = Window.orderBy("arr", "seq").rowsBetween(Window.unboundedPreceding, -1)
    d = hot.withColumn("wm", F.max("ts").over(w) - 1800)
    want = d.filter(F.col("ts") < F.col("wm")).select("seq")
    assert rows(lt, "seq") == rows(want)
    assert on.count() + lt.count() == hot.count()


def test_null_keys_keep_their_prefix(hot):
    # null and 0 keys must stay apart, and a null key spanning many blocks
    # still gets the prefix of its earlier blocks
    d = hot.withColumn("k", F.when(F.col("id") == 0, F.lit(None)).when(F.col("id") < 5, F.lit(0)).otherwise(F.col("id")))
    d = d.withColumn("ks", F.col("k").cast("string"))
    for key in ("k", "ks"):
        w = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        want = d.select("seq", F.sum("vc").over(w).alias("s"))
        got = running_aggregate(d, [key], "seq", [("s", "sum", F.col("vc"))], rows_per_block=50)
        assert rows(got, "seq", "s") == rows(want)
    got = stateful.rolling_top_k(d, "k", "seq", "vc", 3, rows_per_block=50)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = d.select("seq", F.slice(F.sort_array(F.collect_list("vc").over(w), False), 1, 3).alias("top"))
    assert rows(got, "seq", "top") == rows(want)


def test_processor_streams_a_hot_key_in_frames(spark, hot):
    # a table through the keyed processor: rows arrive presorted, so the hot
    # key (40% of rows) is processed frame by frame with its state carried
    from sluice.streaming import processors as PR

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = PR.apply_processor(hot.select("seq", "id", "ts", "vc"), "id", PR.RunningSum())
        got_rows = rows(got, "seq", "sum_vc")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = hot.select("seq", F.sum("vc").over(w).alias("s"))
    assert got_rows == rows(want)


def _blocks(df, keys, order, tiebreak, rows_per_block):
    d, part, is_cut = with_blocks(df, keys, "blk", order, tiebreak, rows_per_block)
    assert is_cut
    sizes = d.filter("blk > 0").groupBy(*part).count()
    return sizes.agg(F.max("count"), F.count(F.lit(1))).first()


@pytest.fixture(scope="module")
def uneven(spark):
    """10,000 rows: a third at one instant, one stray row at 0, sparse ids,
    40% in one key."""
    d = spark.range(10_000).withColumnRenamed("id", "n")
    t = F.when(F.col("n") == 0, 0).when(F.col("n") % 3 == 0, 1_000_000_000_000).otherwise(F.col("n") * 1_000_003 + 999_000_000_000)
    key = F.when(F.col("n") % 5 < 2, F.lit(None)).otherwise(F.col("n") % 97)
    return d.select(t.alias("t"), (F.col("n") * (1 << 24)).alias("seq"), key.cast("long").alias("k"), (F.col("n") % 13 - 6).alias("v")).cache()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_blocks_follow_the_data(uneven, keys):
    target = 500
    total = 10_000 if not keys else 4_000
    for order, tie in (("t", ["seq"]), ("seq", [])):
        most, n = _blocks(uneven, keys, order, tie, target)
        assert most <= 2 * target, (order, most)
        assert n <= 4 * total // target, (order, n)
    w = Window.partitionBy(*keys).orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = uneven.select("seq", F.sum("v").over(w).alias("s"))
    got = running_aggregate(uneven, keys, "t", [("s", "sum", F.col("v"))], target, ["seq"])
    assert rows(got, "seq", "s") == rows(want)


def test_whole_keys_take_the_plain_window(uneven):
    assert find_cut(uneven, ["k"], "t", ["seq"]) is None
    got = running_aggregate(uneven, ["k"], "t", [("s", "sum", F.col("v"))], tiebreak=["seq"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert find_cut(uneven.filter("seq < 0"), [], "t") is None


@pytest.mark.parametrize("size,slide", [("60 minutes", "1 minute"), ("10 minutes", "4 minutes"), ("7 minutes", "7 minutes")])
def test_sliding_panes_match_window(hot, size, slide):
    from sluice.operators.windows import sliding_pane_aggregate

    w = F.window("et", size, slide)
    want = hot.groupBy("id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("vc").alias("s"), F.max("vc").alias("m")
    ).select("id", epoch_ms(F.col("w.start")).alias("ws"), epoch_ms(F.col("w.end")).alias("we"), "c", "s", "m")
    got = sliding_pane_aggregate(
        hot, ["id"], "et", size, slide, [("c", "count", F.lit(1)), ("s", "sum", F.col("vc")), ("m", "max", F.col("vc"))]
    )
    assert rows(got, "id", "window_start", "window_end", "c", "s", "m") == rows(want)


def test_sliding_panes_reject_gapped_windows(hot):
    from sluice.operators.windows import sliding_pane_aggregate

    with pytest.raises(ValueError):
        sliding_pane_aggregate(hot, ["id"], "et", "3 minutes", "5 minutes", [("c", "count", F.lit(1))])
