"""Keyed aggregations (A03-A12), scalar functions (F01-F14) and the sink
frames (K01, K04, K05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice import model
from sluice.functions import text as T
from sluice.operators import aggregate as A
from sluice.plans import P, query
from sluice.plans.q_sources import SENSOR_LINES_SQL, _sql_num
from sluice.plans.sql import SENSOR, with_views
from sluice.sinks import bucketed_lines, kafka_keyed_frame, kafka_value_frame
from sluice.sources.parse import parse_number

S = with_views(SENSOR)


def _sensor(spark, sf):
    return model.sensor_view(spark, sf).select("seq", "id", "ts", "vc")


@query("a03_keyed_sum", S + "SELECT id, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY id")
def a03(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["id"], [F.sum("vc").alias("sum_vc")])


@query(
    "a03_keyed_sum_rolling",
    S + "SELECT seq, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS sum_vc FROM sensor",
)
def a03r(spark, sf):
    return A.keyed_rolling(_sensor(spark, sf), ["id"], "seq", [("sum_vc", "sum", F.col("vc"))]).select(
        "seq", "id", "sum_vc"
    )


@query("a04_keyed_min", S + "SELECT id, min(vc) AS min_vc FROM sensor GROUP BY id")
def a04(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["id"], [F.min("vc").alias("min_vc")])


@query("a05_keyed_max", S + "SELECT id, arg_min(ts, seq) AS ts, max(vc) AS vc FROM sensor GROUP BY id")
def a05(spark, sf):
    return A.keyed_max_first_fields(_sensor(spark, sf), "id", "vc", "seq", ["ts"])


def _extreme_sql(order: str) -> str:
    return S + (
        "SELECT id, seq, ts, vc FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "
        f"{order}) AS rn FROM sensor) WHERE rn = 1"
    )


@query("a06_keyed_min_by", _extreme_sql("vc ASC, seq ASC"))
def a06(spark, sf):
    return A.keyed_extreme_row(_sensor(spark, sf), "id", "vc", "seq", "min_by")


@query("a07_keyed_max_by", _extreme_sql("vc DESC, seq ASC"))
def a07(spark, sf):
    return A.keyed_extreme_row(_sensor(spark, sf), "id", "vc", "seq", "max_by")


@query("a08_keyed_reduce_max_last", _extreme_sql("vc DESC, seq DESC"))
def a08(spark, sf):
    return A.keyed_extreme_row(_sensor(spark, sf), "id", "vc", "seq", "reduce")


@query(
    "a08_keyed_reduce_rolling",
    S
    + "SELECT seq, id, max({'vc': vc, 'seq': seq}) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING).vc "
    "AS best_vc, max({'vc': vc, 'seq': seq}) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING).seq "
    "AS best_seq FROM sensor",
)
def a08r(spark, sf):
    d = A.keyed_rolling(
        _sensor(spark, sf), ["id"], "seq", [("_best", "max", F.struct(F.col("vc"), F.col("seq")))]
    )
    return d.select("seq", "id", F.col("_best.vc").alias("best_vc"), F.col("_best.seq").alias("best_seq"))


@query("a09_agg_count", S + "SELECT vc, count(*) AS cnt FROM sensor GROUP BY vc")
def a09(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["vc"], [F.count(F.lit(1)).alias("cnt")])


@query("a10_agg_sum_text", S + "SELECT id, CAST(sum(vc) AS VARCHAR) AS result FROM sensor GROUP BY id")
def a10(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["id"], [F.sum("vc").cast("string").alias("result")])


@query("a11_agg_avg", S + "SELECT id, round(avg(vc), 6) AS avg_vc FROM sensor GROUP BY id")
def a11(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["id"], [F.round(F.avg("vc"), 6).alias("avg_vc")])


@query("a12_agg_frequency", S + "SELECT id, vc, count(*) AS cnt FROM sensor GROUP BY id, vc")
def a12(spark, sf):
    return A.keyed_final(_sensor(spark, sf), ["id", "vc"], [F.count(F.lit(1)).alias("cnt")])


# ------------------------------------------------------------ functions

def _lines(spark, sf):
    return model.sensor_lines(model.table(spark, sf, "events"))


_F = with_views(SENSOR_LINES_SQL)
_SPLIT = "string_split(line, ',')"


@query(
    "f01_fn_split",
    _F + f"SELECT seq, {_SPLIT}[1] AS f0, {_SPLIT}[2] AS f1, {_SPLIT}[3] AS f2, len({_SPLIT}) AS n_fields FROM slines",
)
def f01(spark, sf):
    return _lines(spark, sf).select(
        "seq", T.field("line", 0).alias("f0"), T.field("line", 1).alias("f1"), T.field("line", 2).alias("f2"),
        F.size(F.split("line", ",", -1)).alias("n_fields"),
    )


@query(
    "f02_fn_parse_number",
    _F + f"SELECT seq, {_sql_num(_SPLIT + '[2]', 'BIGINT')} AS ts, {_sql_num(_SPLIT + '[3]', 'INTEGER')} AS vc FROM slines",
)
def f02(spark, sf):
    return _lines(spark, sf).select(
        "seq",
        parse_number(T.field("line", 1), "bigint").alias("ts"),
        parse_number(T.field("line", 2), "int").alias("vc"),
    )


@query(
    "f03_fn_to_text",
    S + "SELECT seq, 'WaterSensor{id=''' || id || ''', ts=' || ts || ', vc=' || vc || '}' AS text FROM sensor",
)
def f03(spark, sf):
    return _sensor(spark, sf).select("seq", T.sensor_text().alias("text"))


@query(
    "f04_fn_concat",
    _F + f"SELECT seq, 'id=' || {_SPLIT}[1] || ' vc=' || coalesce(CAST({_sql_num(_SPLIT + '[3]', 'INTEGER')} AS VARCHAR), 'null') AS msg FROM slines",
)
def f04(spark, sf):
    vc = parse_number(T.field("line", 2), "int")
    return _lines(spark, sf).select(
        "seq", F.concat(F.lit("id="), T.field("line", 0), F.lit(" vc="), T.as_text(vc)).alias("msg")
    )


@query(
    "f05_fn_max2",
    _F + f"SELECT seq, greatest({_sql_num(_SPLIT + '[3]', 'INTEGER')}, {P.JUMP}) AS m FROM slines",
)
def f05(spark, sf):
    vc = parse_number(T.field("line", 2), "int")
    return _lines(spark, sf).select("seq", F.greatest(vc, F.lit(P.JUMP)).alias("m"))


@query("f06_fn_abs", S + f"SELECT seq, abs(vc - {P.JUMP}) AS d FROM sensor")
def f06(spark, sf):
    return _sensor(spark, sf).select("seq", F.abs(F.col("vc") - P.JUMP).alias("d"))


@query("f07_fn_mod", S + "SELECT seq, vc % 2 AS m2, id % 7 AS m7 FROM sensor")
def f07(spark, sf):
    return _sensor(spark, sf).select("seq", (F.col("vc") % 2).alias("m2"), (F.col("id") % 7).alias("m7"))


@query("f08_fn_divide_double", S + "SELECT seq, round(vc * 1.0 / 3, 6) AS q FROM sensor")
def f08(spark, sf):
    return _sensor(spark, sf).select("seq", F.round(F.col("vc").cast("double") / F.lit(3), 6).alias("q"))


@query(
    "f09_fn_date_format",
    S + "SELECT seq, strftime(et, '%Y-%m-%d %H:%M:%S.%g') AS text, strftime(et, '%Y-%m-%d %H') AS bucket FROM sensor",
)
def f09(spark, sf):
    s = model.sensor_view(spark, sf)
    return s.select(
        "seq",
        F.date_format("et", "yyyy-MM-dd HH:mm:ss.SSS").alias("text"),
        F.date_format("et", "yyyy-MM-dd HH").alias("bucket"),
    )


@query(
    "f10_fn_null_default",
    _F + f"SELECT seq, coalesce({_sql_num(_SPLIT + '[3]', 'INTEGER')}, 0) AS vc FROM slines",
)
def f10(spark, sf):
    return _lines(spark, sf).select("seq", F.coalesce(parse_number(T.field("line", 2), "int"), F.lit(0)).alias("vc"))


@query("f11_fn_equals", S + "SELECT seq, ('click' = event_type) AS is_click FROM sensor")
def f11(spark, sf):
    s = model.sensor_view(spark, sf)
    return s.select("seq", (F.lit("click") == F.col("event_type")).alias("is_click"))


@query("f12_fn_encode_utf8", _F + "SELECT seq, hex(encode(line)) AS hex FROM slines")
def f12(spark, sf):
    return _lines(spark, sf).select("seq", T.utf8_hex("line").alias("hex"))


@query(
    "f13_fn_list_ops",
    S
    + "SELECT id, string_agg(CAST(vc AS VARCHAR), ',' ORDER BY rn) AS top3 FROM (SELECT id, vc, row_number() "
    "OVER (PARTITION BY id ORDER BY vc DESC, seq ASC) AS rn FROM sensor) WHERE rn <= 3 GROUP BY id",
)
def f13(spark, sf):
    top = A.keyed_top_k(_sensor(spark, sf), ["id"], "vc", 3, "seq")
    # at most 3 rows per key reach the list functions
    lists = top.groupBy("id").agg(F.collect_list(F.struct("rank", "vc")).alias("l"))
    ordered = F.transform(F.sort_array("l"), lambda x: x["vc"].cast("string"))
    return lists.select("id", F.array_join(F.slice(ordered, 1, 3), ",").alias("top3"))


@query(
    "f14_fn_map_ops",
    S + "SELECT seq, true AS has_vc, vc AS got, 'ts_mod=' || (ts % 60) || ',vc=' || vc AS entries FROM sensor",
)
def f14(spark, sf):
    d = _sensor(spark, sf).withColumn(
        "m", F.create_map(F.lit("vc"), F.col("vc").cast("bigint"), F.lit("ts_mod"), F.col("ts") % 60)
    )
    entries = F.array_join(
        F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
        ",",
    )
    return d.select(
        "seq",
        F.map_contains_key("m", "vc").alias("has_vc"),
        F.element_at("m", F.lit("vc")).cast("int").alias("got"),
        entries.alias("entries"),
    )


# ------------------------------------------------------------ sink frames

@query(
    "k01_sink_file_bucketed",
    S + "SELECT strftime(et, '%Y-%m-%d %H') AS bucket, concat_ws(',', id, ts, vc) AS value FROM sensor",
)
def k01(spark, sf):
    s = model.sensor_view(spark, sf)
    return bucketed_lines(s, "et", T.csv_line("id", "ts", "vc"))


@query("k04_sink_kafka_value", S + "SELECT seq, 'ws' AS topic, hex(encode(concat_ws(',', id, ts, vc))) AS value FROM sensor")
def k04(spark, sf):
    f = kafka_value_frame(_sensor(spark, sf), T.csv_line("id", "ts", "vc"), "ws", keep=["seq"])
    return f.select("seq", "topic", F.hex("value").alias("value"))


@query(
    "k05_sink_kafka_keyed",
    S + "SELECT seq, 'ws' AS topic, hex(encode(CAST(id AS VARCHAR))) AS key, "
    "hex(encode(concat_ws(',', id, ts, vc))) AS value FROM sensor",
)
def k05(spark, sf):
    f = kafka_keyed_frame(_sensor(spark, sf), T.csv_line("id", "ts", "vc"), "ws", keep=["seq"])
    return f.select("seq", "topic", F.hex("key").alias("key"), F.hex("value").alias("value"))
