"""Windows (W01-W15) and windowed top-N (TK01-TK05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.model import arrivals_view, sensor_view
from sluice.operators import topn, windows
from sluice.plans import P, query
from sluice.plans.sql import (
    ARRIVALS,
    SENSOR,
    ms,
    sliding_expand,
    tumble_end_ms,
    tumble_start_ms,
    us,
    with_views,
)

def _cnt_sum():
    return [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")]


def _cnt_sum_specs():
    return [("cnt", "count", F.lit(1)), ("sum_vc", "sum", F.col("vc"))]
_SQL_CNT_SUM = "count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc"


def _tumble_sql(src_ctes, col, size, keys="id, "):
    return with_views(*src_ctes) + (
        f"SELECT {keys}{tumble_start_ms(col, size)} AS window_start, "
        f"{tumble_end_ms(col, size)} AS window_end, {_SQL_CNT_SUM} "
        f"FROM {src_ctes[-1].split()[0]} GROUP BY ALL"
    )


def _slide_sql(src_ctes, col, size, slide, keys="id, "):
    src = src_ctes[-1].split()[0]
    return with_views(*src_ctes) + (
        f"SELECT {keys}window_start, window_end, {_SQL_CNT_SUM} "
        f"FROM {sliding_expand(src, col, size, slide)} GROUP BY ALL"
    )


@query("w01_win_tumbling_event", _tumble_sql([SENSOR], "et", P.TUMBLE))
def w01(spark, sf):
    return windows.window_aggregate(sensor_view(spark, sf), ["id"], "et", P.TUMBLE, _cnt_sum())


@query("w02_win_tumbling_proc", _tumble_sql([SENSOR, ARRIVALS], "arrival", P.TUMBLE))
def w02(spark, sf):
    return windows.window_aggregate(arrivals_view(spark, sf), ["id"], "arrival", P.TUMBLE, _cnt_sum())


@query("w03_win_sliding_event", _slide_sql([SENSOR], "et", P.SLIDE_SIZE, P.SLIDE_STEP))
def w03(spark, sf):
    return windows.sliding_pane_aggregate(
        sensor_view(spark, sf), ["id"], "et", P.SLIDE_SIZE, P.SLIDE_STEP, _cnt_sum_specs()
    )


@query("w04_win_sliding_proc", _slide_sql([SENSOR, ARRIVALS], "arrival", P.SLIDE_SIZE, P.SLIDE_STEP))
def w04(spark, sf):
    return windows.sliding_pane_aggregate(
        arrivals_view(spark, sf), ["id"], "arrival", P.SLIDE_SIZE, P.SLIDE_STEP, _cnt_sum_specs()
    )


def _session_sql(src_ctes, col):
    src = src_ctes[-1].split()[0]
    gap = us(P.SESSION_GAP)
    return with_views(
        *src_ctes,
        f"l AS (SELECT *, lag({col}) OVER (PARTITION BY id ORDER BY {col}, seq) AS prev FROM {src})",
        f"f AS (SELECT *, CASE WHEN prev IS NULL OR epoch_us({col}) - epoch_us(prev) >= {gap} "
        "THEN 1 ELSE 0 END AS new FROM l)",
        f"g AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY {col}, seq "
        "ROWS UNBOUNDED PRECEDING) AS sess FROM f)",
    ) + (
        f"SELECT id, {ms(f'min({col})')} AS window_start, "
        f"{ms(f'max({col})')} + {gap // 1000} AS window_end, {_SQL_CNT_SUM} "
        "FROM g GROUP BY id, sess"
    )


@query("w05_win_session_event", _session_sql([SENSOR], "et"))
def w05(spark, sf):
    return windows.session_windows(
        sensor_view(spark, sf), ["id"], "et", P.SESSION_GAP, _cnt_sum(), tiebreak=["seq"]
    )


@query("w06_win_session_proc", _session_sql([SENSOR, ARRIVALS], "arrival"))
def w06(spark, sf):
    return windows.session_windows(
        arrivals_view(spark, sf), ["id"], "arrival", P.SESSION_GAP, _cnt_sum(), tiebreak=["seq"]
    )


@query(
    "w07_win_count_tumbling",
    with_views(
        SENSOR,
        "r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor)",
    )
    + f"SELECT id, CAST((rn - 1) // {P.COUNT_SIZE} AS BIGINT) AS window_no, "
    "min(seq) AS first_seq, max(seq) AS last_seq, CAST(sum(vc) AS BIGINT) AS sum_vc "
    f"FROM r GROUP BY ALL HAVING count(*) = {P.COUNT_SIZE}",
)
def w07(spark, sf):
    return windows.count_window(
        sensor_view(spark, sf),
        ["id"],
        "seq",
        P.COUNT_SIZE,
        [F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.sum("vc").alias("sum_vc")],
    )


@query(
    "w08_win_count_sliding",
    with_views(
        SENSOR,
        "r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM sensor)",
        f"w AS (SELECT *, sum(vc) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN {P.COUNT_SIZE - 1} "
        f"PRECEDING AND CURRENT ROW) AS s, count(*) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN "
        f"{P.COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) AS c FROM r)",
    )
    + f"SELECT id, rn AS fire_at, c AS cnt, CAST(s AS BIGINT) AS sum_vc FROM w WHERE rn % {P.COUNT_SLIDE} = 0",
)
def w08(spark, sf):
    return windows.count_window_sliding(
        sensor_view(spark, sf),
        ["id"],
        "seq",
        P.COUNT_SIZE,
        P.COUNT_SLIDE,
        [F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("sum_vc")],
    )


@query("w09_win_global", with_views(SENSOR) + f"SELECT id, {_SQL_CNT_SUM} FROM sensor GROUP BY id")
def w09(spark, sf):
    return sensor_view(spark, sf).groupBy("id").agg(*_cnt_sum())


@query("w10_win_all", _slide_sql([SENSOR], "et", P.SLIDE_SIZE, P.SLIDE_STEP, keys=""))
def w10(spark, sf):
    return windows.sliding_pane_aggregate(sensor_view(spark, sf), [], "et", P.SLIDE_SIZE, P.SLIDE_STEP, _cnt_sum_specs())


@query(
    "w11_win_reduce",
    with_views(SENSOR)
    + f"SELECT id, {tumble_start_ms('et', P.TUMBLE)} AS window_start, {tumble_end_ms('et', P.TUMBLE)} "
    "AS window_end, CAST(sum(vc) AS BIGINT) AS vc, max(ts) AS ts, count(*) AS n FROM sensor GROUP BY ALL",
)
def w11(spark, sf):
    # Reference: ts becomes the wall clock once two rows were reduced; we keep
    # the latest event second (reproducible).
    return windows.window_aggregate(
        sensor_view(spark, sf),
        ["id"],
        "et",
        P.TUMBLE,
        [F.sum("vc").alias("vc"), F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n")],
    )


@query(
    "w12_win_aggregate",
    with_views(SENSOR)
    + f"SELECT id, {tumble_start_ms('et', P.TUMBLE)} AS window_start, {tumble_end_ms('et', P.TUMBLE)} "
    "AS window_end, CAST(sum(vc) AS VARCHAR) AS result FROM sensor GROUP BY ALL",
)
def w12(spark, sf):
    return windows.window_aggregate(
        sensor_view(spark, sf), ["id"], "et", P.TUMBLE, [F.sum("vc").cast("string").alias("result")]
    )


@query(
    "w13_win_process",
    with_views(SENSOR)
    + f"SELECT id, {tumble_start_ms('et', P.TUMBLE)} AS window_start, {tumble_end_ms('et', P.TUMBLE)} "
    f"AS window_end, count(*) OVER (PARTITION BY id, {tumble_start_ms('et', P.TUMBLE)}) AS count, "
    "seq, et, ts, vc, event_type FROM sensor",
)
def w13(spark, sf):
    return windows.window_process(sensor_view(spark, sf), ["id"], "et", P.TUMBLE)


@query(
    "w14_win_agg_process",
    with_views(SENSOR)
    + f"SELECT id, {tumble_start_ms('et', P.TUMBLE)} AS window_start, {tumble_end_ms('et', P.TUMBLE)} "
    "AS window_end, 1 AS inner_count, CAST(sum(vc) AS BIGINT) AS sum_vc FROM sensor GROUP BY ALL",
)
def w14(spark, sf):
    agg = windows.window_aggregate(sensor_view(spark, sf), ["id"], "et", P.TUMBLE, [F.sum("vc").alias("sum_vc")])
    # The window wrapper sees exactly one pre-aggregated value per window.
    return agg.select("id", "window_start", "window_end", F.lit(1).alias("inner_count"), "sum_vc")


@query(
    "w15_win_bounds",
    with_views(SENSOR)
    + f"SELECT seq, {tumble_start_ms('et', P.TUMBLE)} AS window_start, "
    f"{tumble_end_ms('et', P.TUMBLE)} AS window_end FROM sensor",
)
def w15(spark, sf):
    d = windows.with_window(sensor_view(spark, sf), "et", P.TUMBLE)
    return d.select("seq", *windows.window_bounds())


# ---------------------------------------------------------------- top-N

def _topn_sql(n: int, size: str, slide: str | None, select: str | None = None, limit: bool = True) -> str:
    if slide:
        exp = sliding_expand("sensor", "et", size, slide)
        counts = f"c AS (SELECT window_end, vc, count(*) AS cnt FROM {exp} GROUP BY ALL)"
    else:
        counts = (
            f"c AS (SELECT {tumble_end_ms('et', size)} AS window_end, vc, count(*) AS cnt "
            "FROM sensor GROUP BY ALL)"
        )
    ranked = (
        "r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, vc ASC) "
        "AS rank FROM c)"
    )
    where = f" WHERE rank <= {n}" if limit else ""
    return with_views(SENSOR, counts, ranked) + f"SELECT {select or 'window_end, vc, cnt, rank'} FROM r{where}"


@query("tk01_topn_window_all", _topn_sql(P.TOP_N, P.SLIDE_SIZE, P.SLIDE_STEP))
def tk01(spark, sf):
    return topn.topn_window(sensor_view(spark, sf), "et", "vc", P.SLIDE_SIZE, P.SLIDE_STEP, P.TOP_N).select(
        "window_end", "vc", "cnt", "rank"
    )


@query("tk02_topn_window_incremental", _topn_sql(P.TOP_N, P.SLIDE_SIZE, P.SLIDE_STEP))
def tk02(spark, sf):
    counts = topn.window_value_counts(sensor_view(spark, sf), "et", "vc", P.SLIDE_SIZE, P.SLIDE_STEP)
    # stage 2 is keyed by the window end only (the reference's keyBy(windowEnd))
    return topn.rank_top_n(counts.select("window_end", "vc", "cnt"), P.TOP_N)


@query(
    "tk03_topn_text_report",
    _topn_sql(
        P.TOP_N,
        P.SLIDE_SIZE,
        P.SLIDE_STEP,
        select="window_end, rank, printf('No.%d vc=%d count=%d window_end=%s', rank, vc, cnt, "
        "strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S.%g')) AS line",
    ),
)
def tk03(spark, sf):
    top = topn.topn_window(sensor_view(spark, sf), "et", "vc", P.SLIDE_SIZE, P.SLIDE_STEP, P.TOP_N)
    return topn.topn_text_report(top)


@query("tk04_sort_desc", _topn_sql(0, P.TUMBLE, None, limit=False))
def tk04(spark, sf):
    counts = topn.window_value_counts(sensor_view(spark, sf), "et", "vc", P.TUMBLE, None)
    return topn.rank_all(counts).select("window_end", "vc", "cnt", F.col("rank").cast("int").alias("rank"))


@query("tk05_limit_n", _topn_sql(5, P.TUMBLE, None))
def tk05(spark, sf):
    return topn.topn_window(sensor_view(spark, sf), "et", "vc", P.TUMBLE, None, 5).select(
        "window_end", "vc", "cnt", "rank"
    )
