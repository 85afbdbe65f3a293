"""Event time and late data (T01-T06), joins (J01-J08) and keyed state /
timers (ST01-ST11), batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice import model
from sluice.functions.time import epoch_ms, epoch_us, floor_div
from sluice.operators import joins, late, stateful
from sluice.operators.windows import window_aggregate
from sluice.plans import P, query
from sluice.plans.sql import ARRIVALS, SENSOR, us, with_views

A = with_views(SENSOR, ARRIVALS)
S = with_views(SENSOR)
H = 1_000_000


def _arr(spark, sf):
    return model.arrivals_view(spark, sf)


# ------------------------------------------------------------ time

@query("t01_assign_event_time", S + "SELECT seq, ts * 1000 AS et_ms FROM sensor")
def t01(spark, sf):
    d = late.assign_event_time(model.sensor_view(spark, sf).select("seq", "ts"), "ts", "et2")
    return d.select("seq", epoch_ms("et2").alias("et_ms"))


def _wm_sql(delay_s: int) -> str:
    return A + (
        "SELECT seq, max(epoch_us(et)) OVER (ORDER BY epoch_us(arrival), seq ROWS BETWEEN UNBOUNDED PRECEDING "
        f"AND 1 PRECEDING) - {delay_s * H} AS wm_before_us FROM arrivals"
    )


@query("t02_wm_monotonic", _wm_sql(0))
def t02(spark, sf):
    return late.with_watermark_before(_arr(spark, sf), "et", "arrival", 0).select("seq", "wm_before_us")


@query("t03_wm_bounded_disorder", _wm_sql(P.WATERMARK_DELAY_S))
def t03(spark, sf):
    return late.with_watermark_before(_arr(spark, sf), "et", "arrival", P.WATERMARK_DELAY_S).select(
        "seq", "wm_before_us"
    )


@query(
    "t04_wm_idleness",
    with_views(
        SENSOR,
        ARRIVALS,
        "b AS (SELECT seq, id % 2 AS src, epoch_us(et) AS e, epoch_us(arrival) AS a FROM arrivals)",
        "c AS (SELECT seq, a, max(CASE WHEN src = 0 THEN e END) OVER w AS mx0, max(CASE WHEN src = 0 THEN a END) "
        "OVER w AS la0, max(CASE WHEN src = 1 THEN e END) OVER w AS mx1, max(CASE WHEN src = 1 THEN a END) OVER w "
        "AS la1, min(a) OVER w AS began FROM b WINDOW w AS (ORDER BY a, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 "
        "PRECEDING))",
        # an input that was not heard yet is idle once the whole stream is as old as the bound
        f"f AS (SELECT *, coalesce(a - coalesce(la0, began) < {P.IDLE_S * H}, true) AS busy0, "
        f"coalesce(a - coalesce(la1, began) < {P.IDLE_S * H}, true) AS busy1 FROM c)",
        "d AS (SELECT seq, a, CASE WHEN busy0 AND mx0 IS NULL OR busy1 AND mx1 IS NULL THEN NULL ELSE "
        "least(CASE WHEN busy0 THEN mx0 END, CASE WHEN busy1 THEN mx1 END) END AS cand FROM f)",
    )
    + "SELECT seq, max(cand) OVER (ORDER BY a, seq ROWS UNBOUNDED PRECEDING) AS wm_before_us FROM d",
)
def t04(spark, sf):
    d = _arr(spark, sf).withColumn("src", F.pmod(F.col("id"), F.lit(2)))
    return late.combined_watermark(d, "src", [0, 1], "et", "arrival", 0, idle_s=P.IDLE_S).select(
        "seq", "wm_before_us"
    )


_LW = us(P.LATE_WINDOW)
_T05_BASE = with_views(
    SENSOR,
    ARRIVALS,
    f"b AS (SELECT *, (epoch_us(et) // {_LW} + 1) * {_LW} AS wend, max(epoch_us(et)) OVER (ORDER BY "
    "epoch_us(arrival), seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - "
    f"{P.WATERMARK_DELAY_S * H} AS wm FROM arrivals)",
    "c AS (SELECT *, coalesce(wend <= wm, false) AS is_late FROM b)",
)


@query(
    "t05_late_side_output_late",
    _T05_BASE + "SELECT seq, id, vc, wend // 1000 AS window_end, wm AS wm_before_us FROM c WHERE is_late",
)
def t05_late(spark, sf):
    _on, lt = late.split_late(_arr(spark, sf), "et", "arrival", P.WATERMARK_DELAY_S, P.LATE_WINDOW)
    t = epoch_us("et")
    wend = (t - F.pmod(t, F.lit(_LW)) + F.lit(_LW))
    return lt.select("seq", "id", "vc", floor_div(wend, 1000).alias("window_end"), "wm_before_us")


@query(
    "t05_late_side_output_on_time",
    _T05_BASE
    + f"SELECT id, (epoch_us(et) // {_LW}) * {_LW // 1000} AS window_start, wend // 1000 AS window_end, "
    "count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc FROM c WHERE NOT is_late GROUP BY ALL",
)
def t05_on_time(spark, sf):
    on, _lt = late.split_late(_arr(spark, sf), "et", "arrival", P.WATERMARK_DELAY_S, P.LATE_WINDOW)
    return window_aggregate(
        on, ["id"], "et", P.LATE_WINDOW, [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")]
    )


_CP = "event_type IN ('click', 'purchase')"
_T06_SQL = with_views(
    SENSOR,
    ARRIVALS,
    f"b AS (SELECT seq, event_type, epoch_us(et) AS e, epoch_us(arrival) AS a FROM arrivals WHERE {_CP})",
    "c AS (SELECT seq, a, max(CASE WHEN event_type = 'click' THEN e END) OVER w AS m0, "
    "max(CASE WHEN event_type = 'purchase' THEN e END) OVER w AS m1 FROM b "
    "WINDOW w AS (ORDER BY a, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
    f"d AS (SELECT seq, CASE WHEN m0 IS NOT NULL AND m1 IS NOT NULL THEN least(m0, m1) - "
    f"{P.WATERMARK_DELAY_S * H} END AS wm_before_us FROM c)",
)


@query("t06_wm_propagation_min", _T06_SQL + "SELECT seq, wm_before_us FROM d")
def t06(spark, sf):
    d = _arr(spark, sf).filter(F.col("event_type").isin("click", "purchase"))
    return late.combined_watermark(
        d, "event_type", ["click", "purchase"], "et", "arrival", P.WATERMARK_DELAY_S
    ).select("seq", "wm_before_us")


# ------------------------------------------------------------ joins

def _clicks(spark, sf):
    return _arr(spark, sf).filter(F.col("event_type") == "click")


def _purchases(spark, sf):
    return _arr(spark, sf).filter(F.col("event_type") == "purchase")


_JW = us(P.JOIN_WINDOW)


@query(
    "j01_join_window",
    S
    + f"SELECT l.id, (epoch_us(l.et) // {_JW}) * {_JW // 1000} AS window_start, l.seq AS l_seq, r.seq AS r_seq "
    f"FROM sensor l JOIN sensor r ON l.id = r.id AND epoch_us(l.et) // {_JW} = epoch_us(r.et) // {_JW} "
    "WHERE l.event_type = 'click' AND r.event_type = 'purchase'",
)
def j01(spark, sf):
    j = joins.window_join(_clicks(spark, sf), _purchases(spark, sf), "id", "et", P.JOIN_WINDOW, ["seq"], ["seq"])
    return j.select("id", epoch_ms(F.col("_win.start")).alias("window_start"), "l_seq", "r_seq")


_J02_SQL = (
    "SELECT l.id, l.seq AS l_seq, r.seq AS r_seq FROM {L} l JOIN {R} r ON l.id = r.id "
    f"AND epoch_us(r.et) BETWEEN epoch_us(l.et) - {P.INTERVAL_S * H} AND epoch_us(l.et) + {P.INTERVAL_S * H}"
)


@query(
    "j02_join_interval",
    with_views(SENSOR, "l AS (SELECT * FROM sensor WHERE event_type = 'click')",
               "r AS (SELECT * FROM sensor WHERE event_type = 'purchase')")
    + _J02_SQL.format(L="l", R="r"),
)
def j02(spark, sf):
    return joins.interval_join(
        _clicks(spark, sf), _purchases(spark, sf), "id", "et", -P.INTERVAL_S, P.INTERVAL_S, ["seq"], ["seq"]
    )


_J03_BASE = with_views(
    SENSOR,
    ARRIVALS,
    f"b AS (SELECT *, epoch_us(et) AS e, epoch_us(arrival) AS a FROM arrivals WHERE {_CP})",
    "c AS (SELECT *, max(CASE WHEN event_type = 'click' THEN e END) OVER w AS m0, "
    "max(CASE WHEN event_type = 'purchase' THEN e END) OVER w AS m1 FROM b "
    "WINDOW w AS (ORDER BY a, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
    f"d AS (SELECT *, coalesce(e < CASE WHEN m0 IS NOT NULL AND m1 IS NOT NULL THEN least(m0, m1) - "
    f"{P.WATERMARK_DELAY_S * H} END, false) AS is_late FROM c)",
    "l AS (SELECT * FROM d WHERE event_type = 'click' AND NOT is_late)",
    "r AS (SELECT * FROM d WHERE event_type = 'purchase' AND NOT is_late)",
)


def _j03(spark, sf):
    return joins.interval_join_late(
        _clicks(spark, sf), _purchases(spark, sf), "id", "et", "arrival",
        -P.INTERVAL_S, P.INTERVAL_S, P.WATERMARK_DELAY_S, ["seq"], ["seq"],
    )


@query("j03_join_interval_late_joined", _J03_BASE + _J02_SQL.format(L="l", R="r"))
def j03_joined(spark, sf):
    return _j03(spark, sf)[0]


@query("j03_join_interval_late_left", _J03_BASE + "SELECT seq, id, ts FROM d WHERE is_late AND event_type = 'click'")
def j03_left(spark, sf):
    return _j03(spark, sf)[1].select("seq", "id", "ts")


@query(
    "j03_join_interval_late_right",
    _J03_BASE + "SELECT seq, id, ts, vc FROM d WHERE is_late AND event_type = 'purchase'",
)
def j03_right(spark, sf):
    return _j03(spark, sf)[2].select("seq", "id", "ts", "vc")


@query(
    "j04_join_connected_keyed",
    "SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer JOIN orders ON c_custkey = o_custkey",
)
def j04(spark, sf):
    c = model.table(spark, sf, "customer").select("c_custkey", "c_name")
    o = model.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return joins.connected_join(c, o, "c_custkey", "o_custkey", ["c_custkey", "c_name"], ["o_orderkey", "o_orderstatus"])


@query(
    "j05_connect_map",
    S
    + "SELECT seq, 'vc=' || vc AS value, 'left' AS origin FROM sensor WHERE event_type = 'click' "
    "UNION ALL SELECT seq, 'id=' || id AS value, 'right' AS origin FROM sensor WHERE event_type = 'view'",
)
def j05(spark, sf):
    s = model.sensor_view(spark, sf)
    ints = s.filter(F.col("event_type") == "click").select("seq", "vc")
    texts = s.filter(F.col("event_type") == "view").select("seq", F.col("id").cast("string").alias("id"))
    return joins.connect_map(
        ints,
        texts,
        lambda d: d.select("seq", F.concat(F.lit("vc="), F.col("vc").cast("string")).alias("value")),
        lambda d: d.select("seq", F.concat(F.lit("id="), F.col("id")).alias("value")),
    )


@query(
    "j06_union_all",
    S
    + "SELECT seq, vc FROM sensor WHERE event_type = 'click' UNION ALL SELECT seq, vc FROM sensor WHERE "
    "event_type IN ('click', 'view') UNION ALL SELECT seq, CAST(CAST(vc AS VARCHAR) AS INTEGER) AS vc FROM sensor "
    "WHERE event_type = 'purchase'",
)
def j06(spark, sf):
    s = model.sensor_view(spark, sf)
    a = s.filter(F.col("event_type") == "click").select("seq", "vc")
    b = s.filter(F.col("event_type").isin("click", "view")).select("seq", "vc")
    # a third input of another type, mapped first
    c = s.filter(F.col("event_type") == "purchase").select("seq", F.col("vc").cast("string").alias("vc"))
    return joins.union_all(a, b, c.select("seq", F.col("vc").cast("int").alias("vc")))


def _rule_sql(partition: str) -> str:
    return with_views(
        SENSOR,
        ARRIVALS,
        "u AS (SELECT seq, id, vc, epoch_us(arrival) AS a, 1 AS kind, NULL::INTEGER AS thr FROM arrivals "
        "WHERE event_type <> 'signup' UNION ALL SELECT seq, id, NULL, epoch_us(arrival), 0, vc FROM arrivals "
        "WHERE event_type = 'signup')",
        f"r AS (SELECT *, last_value(thr IGNORE NULLS) OVER ({partition}ORDER BY a, kind, seq ROWS UNBOUNDED "
        "PRECEDING) AS t FROM u)",
    ) + "SELECT seq, id, vc, coalesce(t, 0) AS threshold FROM r WHERE kind = 1 AND vc > coalesce(t, 0)"


def _rule(spark, sf, keys):
    a = _arr(spark, sf)
    data = a.filter(F.col("event_type") != "signup").select("seq", "id", "vc", "arrival")
    cfg = a.filter(F.col("event_type") == "signup").select("seq", "id", "vc", "arrival")
    r = joins.latest_rule(data, cfg, "arrival", "vc", keys=keys)
    return r.filter(F.col("vc") > F.col("threshold")).select("seq", "id", "vc", "threshold")


@query("j07_broadcast_rule", _rule_sql(""))
def j07(spark, sf):
    return _rule(spark, sf, [])


@query("j08_keyed_broadcast_rule", _rule_sql("PARTITION BY id "))
def j08(spark, sf):
    return _rule(spark, sf, ["id"])


# ------------------------------------------------------------ state

def _sensor(spark, sf):
    return model.sensor_view(spark, sf).select("seq", "id", "ts", "vc")


@query(
    "st01_state_value_jump",
    S + "SELECT seq, id, vc, prev FROM (SELECT *, lag(vc, 1, 0) OVER (PARTITION BY id ORDER BY seq) AS prev "
    f"FROM sensor) WHERE abs(vc - prev) > {P.JUMP}",
)
def st01(spark, sf):
    return stateful.value_jump(_sensor(spark, sf), "id", "seq", "vc", P.JUMP).select("seq", "id", "vc", "prev")


@query(
    "st02_state_list_top3",
    S + "SELECT id, seq, array_to_string(list_slice(list_reverse_sort(list(vc) OVER (PARTITION BY id ORDER BY seq "
    "ROWS UNBOUNDED PRECEDING)), 1, 3), ',') AS top3 FROM sensor",
)
def st02(spark, sf):
    r = stateful.rolling_top_k(_sensor(spark, sf), "id", "seq", "vc", 3)
    return r.select("id", "seq", F.array_join(F.transform("top", lambda x: x.cast("string")), ",").alias("top3"))


@query(
    "st03_state_map_counts",
    S + "SELECT seq, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cnt FROM sensor",
)
def st03(spark, sf):
    return stateful.running_counts_per_value(_sensor(spark, sf), "id", "seq", "vc").select("seq", "id", "vc", "cnt")


@query(
    "st04_state_reducing_sum",
    S + "SELECT seq, id, CAST(sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) "
    "AS sum_vc FROM sensor",
)
def st04(spark, sf):
    return stateful.running_sum(_sensor(spark, sf), "id", "seq", "vc", "sum_vc").select("seq", "id", "sum_vc")


@query(
    "st05_state_aggregating_avg",
    S + "SELECT seq, id, round(avg(vc) OVER (PARTITION BY id ORDER BY seq ROWS UNBOUNDED PRECEDING), 6) "
    "AS avg_vc FROM sensor",
)
def st05(spark, sf):
    r = stateful.running_avg(_sensor(spark, sf), "id", "seq", "vc", "avg_vc")
    return r.select("seq", "id", F.round("avg_vc", 6).alias("avg_vc"))


@query(
    "st06_state_ttl",
    with_views(
        SENSOR,
        ARRIVALS,
        "b AS (SELECT seq, id, vc, epoch_us(arrival) AS t FROM arrivals)",
        "l AS (SELECT *, lag(t) OVER (PARTITION BY id ORDER BY t, seq) AS pt FROM b)",
        f"i AS (SELECT *, sum(CASE WHEN pt IS NULL OR t - pt >= {P.TTL_S * H} THEN 1 ELSE 0 END) OVER "
        "(PARTITION BY id ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS island FROM l)",
        f"s AS (SELECT *, last_value(CASE WHEN vc > {P.SIDE_ALERT} THEN vc END IGNORE NULLS) OVER (PARTITION BY "
        "id, island ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old_value FROM i)",
    )
    + "SELECT seq, id, vc, old_value FROM s",
)
def st06(spark, sf):
    d = _arr(spark, sf).select("seq", "id", "vc", "arrival")
    return stateful.ttl_value(d, "id", "arrival", "vc", P.TTL_S, P.SIDE_ALERT).select("seq", "id", "vc", "old_value")


@query(
    "st07_operator_list_count",
    S + f"SELECT seq, CAST(seq % {P.PARTITIONS} AS INTEGER) AS bucket, count(*) OVER (PARTITION BY seq % "
    f"{P.PARTITIONS} ORDER BY seq ROWS UNBOUNDED PRECEDING) AS cnt FROM sensor",
)
def st07(spark, sf):
    from sluice.operators.rolling import running_aggregate

    d = _sensor(spark, sf).select("seq", F.pmod(F.col("seq"), F.lit(P.PARTITIONS)).cast("int").alias("bucket"))
    return running_aggregate(d, ["bucket"], "seq", [("cnt", "count", F.lit(1))])


@query(
    "st08_operator_list_rescale",
    S + "SELECT CAST(n AS INTEGER) AS n_buckets, count(*) AS total FROM sensor, unnest([2, 3, 4]) AS r(n) GROUP BY n",
)
def st08(spark, sf):
    # per-bucket counters restored under 2, 3 and 4 buckets add up to one total
    s = _sensor(spark, sf).select("seq")
    parts = [
        s.groupBy(F.pmod(F.col("seq"), F.lit(n)).alias("b")).count().select(F.lit(n).alias("n_buckets"), "count")
        for n in (2, 3, 4)
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("n_buckets").agg(F.sum("count").alias("total"))


@query(
    "st09_timer_event_time",
    with_views(
        SENSOR,
        ARRIVALS,
        "b AS (SELECT id, seq, epoch_us(et) AS e, epoch_us(arrival) AS a FROM arrivals)",
        f"tm AS (SELECT DISTINCT id, e + {P.TIMER_DELAY_S * H} AS timer_us, a AS reg_a FROM b)",
        "u AS (SELECT -e AS o, 0 AS kind, a AS arr, NULL::BIGINT AS id, NULL::BIGINT AS timer_us, NULL::BIGINT AS "
        f"reg_a FROM b UNION ALL SELECT -(timer_us + {P.WATERMARK_DELAY_S * H}), 1, NULL, id, timer_us, reg_a FROM tm)",
        "s AS (SELECT *, min(arr) OVER (ORDER BY o, kind ROWS UNBOUNDED PRECEDING) AS first FROM u)",
    )
    + "SELECT DISTINCT id, timer_us // 1000 AS timer_ms, CASE WHEN first IS NOT NULL THEN greatest(first, reg_a) // 1000 "
    "END AS fired_at_ms FROM s WHERE kind = 1",
)
def st09(spark, sf):
    return stateful.event_timers(_arr(spark, sf), "id", "et", "arrival", P.WATERMARK_DELAY_S, P.TIMER_DELAY_S)


@query(
    "st11_timer_delete",
    S + "SELECT seq, id, (nxt - e) // 1000000 AS gap_s FROM (SELECT *, epoch_us(et) AS e, lead(epoch_us(et)) OVER "
    f"(PARTITION BY id ORDER BY et, seq) AS nxt FROM sensor) WHERE nxt - e > {P.INACTIVITY_S * H}",
)
def st11(spark, sf):
    d = model.sensor_view(spark, sf).select("seq", "id", "et")
    return stateful.inactivity_alerts(d, "id", "et", P.INACTIVITY_S).select("seq", "id", "gap_s")
