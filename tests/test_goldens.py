"""Hand-derived goldens on the reference's literal inputs (FIXTURES.md §2)."""

from pyspark.sql import functions as F

from conftest import rows
from sluice.functions.time import epoch_ms, from_epoch_seconds
from sluice.operators import aggregate as A
from sluice.operators import basic, joins, split, windows
from sluice.sources import from_collection, parse_sensor_csv
from sluice.sources.text import tokenize

# The reference's word file lines, in order.
WORDS = ["hello flink", "hello world", "hello java"]
SENSORS = [("sensor_1", 1, 1), ("sensor_1", 2, 2), ("sensor_2", 2, 2), ("sensor_3", 3, 3)]


def _words(spark):
    return from_collection(spark, [(1, i + 1, w) for i, w in enumerate(WORDS)], "doc_id long, line_no int, line string")


def _sensors(spark, data=SENSORS):
    return from_collection(
        spark, [(i, *r) for i, r in enumerate(data)], "seq long, id string, ts long, vc int"
    )


def test_word_count_final(spark):
    toks = tokenize(_words(spark))
    got = A.keyed_final(toks, ["word"], [F.sum("one").alias("cnt")])
    assert rows(got) == sorted([("hello", 3), ("flink", 1), ("world", 1), ("java", 1)])


def test_word_count_rolling(spark):
    toks = tokenize(_words(spark))
    got = A.keyed_rolling(toks, ["word"], "line_no", [("cnt", "sum", F.col("one"))], 2, ["pos"])
    ordered = [(r["word"], r["cnt"]) for r in got.orderBy("line_no", "pos").collect()]
    assert ordered == [("hello", 1), ("flink", 1), ("hello", 2), ("world", 1), ("hello", 3), ("java", 1)]


def test_java_split_edge_cases(spark):
    lines = from_collection(
        spark, [(1, 1, ""), (1, 2, "   "), (1, 3, "a  b "), (1, 4, " a")], "doc_id long, line_no int, line string"
    )
    got = [(r["line_no"], r["word"]) for r in tokenize(lines).orderBy("line_no", "pos").collect()]
    assert got == [(1, ""), (3, "a"), (3, ""), (3, "b"), (4, ""), (4, "a")]


def test_collection(spark):
    df = from_collection(spark, [(1,), (22,), (3,)], "x int")
    assert rows(df) == [(1,), (3,), (22,)]


def test_filter_equals(spark):
    got = basic.filter_equals(_sensors(spark), "id", "sensor_1")
    assert rows(got, "id", "ts", "vc") == [("sensor_1", 1, 1), ("sensor_1", 2, 2)]


def test_filter_null_id_dropped(spark):
    df = _sensors(spark, SENSORS + [(None, 9, 9)])
    assert basic.filter_equals(df, "id", "sensor_1").count() == 2


def test_flatmap(spark):
    df = _sensors(spark)
    got = basic.flatmap_conditional(df, "sensor_1", "sensor_2")
    assert sorted(r["value"] for r in got.collect()) == ["1", "2", "2", "2"]


def test_keyed_max(spark):
    got = A.keyed_max_first_fields(_sensors(spark), "id", "vc", "seq", ["ts"])
    assert rows(got, "id", "vc") == [("sensor_1", 2), ("sensor_2", 2), ("sensor_3", 3)]


def test_add_one(spark):
    df = from_collection(spark, [(i,) for i in (1, 2, 3, 4)], "vc int")
    assert rows(df.select(basic.add_one("vc"))) == [(2,), (3,), (4,), (5,)]


def test_union_all(spark):
    a = from_collection(spark, [(1,), (2,), (3,)], "v int")
    b = from_collection(spark, [(2,), (2,), (3,)], "v int")
    c = from_collection(spark, [("2",), ("2",), ("3",)], "v string").select(F.col("v").cast("int").alias("v"))
    got = [r[0] for r in joins.union_all(a, b, c).collect()]
    assert sorted(got) == [1, 2, 2, 2, 2, 2, 3, 3, 3]


def test_connected_join(spark):
    left = from_collection(spark, [(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, x string")
    right = from_collection(spark, [(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "id int, y string, n int")
    got = rows(left.join(right, "id").select("x", "y"))
    assert got == sorted([("a1", "aa1"), ("a1", "aa2"), ("a2", "aa1"), ("a2", "aa2"), ("b", "bb"), ("c", "cc")])


def _join_inputs(spark):
    l = from_collection(spark, [(0, "a", 1), (1, "a", 2), (2, "b", 3), (3, "c", 4)], "seq long, k string, t long")
    r = from_collection(
        spark,
        [(0, "a", 1, 1), (1, "a", 11, 1), (2, "b", 2, 1), (3, "b", 12, 1), (4, "c", 14, 1), (5, "d", 15, 1)],
        "seq long, k string, t long, v int",
    )
    return l.withColumn("et", from_epoch_seconds("t")), r.withColumn("et", from_epoch_seconds("t"))


def test_window_join(spark):
    l, r = _join_inputs(spark)
    got = joins.window_join(l, r, "k", "et", "10 seconds", ["t"], ["t"])
    assert rows(got, "k", "l_t", "r_t") == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_interval_join(spark):
    l, r = _join_inputs(spark)
    got = joins.interval_join(l, r, "k", "et", -2, 2, ["t"], ["t"])
    assert rows(got, "k", "l_t", "r_t") == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def test_parity(spark):
    df = from_collection(spark, [(i, x) for i, x in enumerate([-3, -2, 0, 1, 2])], "seq long, x int")
    got = rows(df.select("x", basic.parity("x").alias("p")))
    assert got == sorted([(-3, None), (-2, "even"), (0, "even"), (1, "odd"), (2, "even")], key=lambda t: t[0])


def test_window_aggregate_19(spark):
    df = from_collection(spark, [(i, "s1", 1693101013, v) for i, v in enumerate([3, 5, 5, 6])], "seq long, id string, ts long, vc int")
    df = df.withColumn("et", from_epoch_seconds("ts"))
    got = windows.window_aggregate(df, ["id"], "et", "10 seconds", [F.sum("vc").cast("string").alias("r")])
    assert [r["r"] for r in got.collect()] == ["19"]


def test_agg_then_process(spark):
    data = [(i, "s2", 1693101013, 4) for i in range(6)] + [(10 + i, "s1", 1693101014, 5) for i in range(6)]
    df = from_collection(spark, data, "seq long, id string, ts long, vc int").withColumn("et", from_epoch_seconds("ts"))
    agg = windows.window_aggregate(df, ["id"], "et", "10 seconds", [F.sum("vc").alias("s")])
    got = rows(agg.select("id", "window_start", "window_end", F.lit(1).alias("n"), "s"))
    assert got == [("s1", 1693101010000, 1693101020000, 1, 30), ("s2", 1693101010000, 1693101020000, 1, 24)]


def test_full_window_counts(spark):
    data = [(i, "s1", 1693101124, 5) for i in range(5)] + [(10 + i, "s2", 1693101123, 4) for i in range(4)]
    df = from_collection(spark, data, "seq long, id string, ts long, vc int").withColumn("et", from_epoch_seconds("ts"))
    got = windows.window_process(df, ["id"], "et", "10 seconds")
    assert sorted({(r["id"], r["window_start"], r["window_end"], r["count"]) for r in got.collect()}) == [
        ("s1", 1693101120000, 1693101130000, 5),
        ("s2", 1693101120000, 1693101130000, 4),
    ]


def test_side_output(spark):
    df = _sensors(spark, [("s1", 4, 55), ("s2", 3, 43), ("s1", 4, 21)])
    main, side = split.side_alert(df, F.col("vc") > 10, F.concat(F.lit("vc="), F.col("vc").cast("string")))
    assert main.count() == 3
    assert sorted(r["alert"] for r in side.collect()) == ["vc=21", "vc=43", "vc=55"]


def test_parse_reject_path(spark):
    lines = from_collection(spark, [(0, "s1,1,2"), (1, "s1,x,2"), (2, "s1,1"), (3, "s1, 1,2"), (4, "s1,+3,-4")], "seq long, line string")
    good, bad = parse_sensor_csv(lines)
    assert rows(good, "seq", "id", "ts", "vc") == [(0, "s1", 1, 2), (4, "s1", 3, -4)]
    assert sorted(r["seq"] for r in bad.collect()) == [1, 2, 3]


def test_epoch_ms_zone_free(spark):
    df = from_collection(spark, [(1693101013,)], "ts long").select(epoch_ms(from_epoch_seconds("ts")).alias("ms"))
    assert df.collect()[0]["ms"] == 1693101013000
