"""Windowed top-N (TK01-TK05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.time import from_epoch_ms
from sluice.operators.rolling import running_aggregate
from sluice.operators.windows import sliding_pane_aggregate, window_aggregate


def window_value_counts(df: DataFrame, et: str, value: str, size: str, slide: str | None) -> DataFrame:
    """Stage 1 (TK02): count per (window, value).  Partial aggregation before
    the shuffle - each window's rank input is one row per distinct value.
    Sliding windows count per pane first (:func:`sliding_pane_aggregate`)."""
    if slide:
        return sliding_pane_aggregate(df, [value], et, size, slide, [("cnt", "count", F.lit(1))])
    return window_aggregate(df, [value], et, size, [F.count(F.lit(1)).alias("cnt")], slide)


def rank_top_n(counts: DataFrame, n: int, by: str = "window_end", value: str = "vc") -> DataFrame:
    """Stage 2: rank inside each window by count desc, ties by value asc
    (TK04), keep ``min(n, size)`` (TK05).  Spark prunes with WindowGroupLimit
    before the window sort."""
    w = Window.partitionBy(by).orderBy(F.col("cnt").desc(), F.col(value).asc())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def rank_all(counts: DataFrame, by: str = "window_end", value: str = "vc") -> DataFrame:
    """TK04 the full order inside each window: a running row count, so a
    window with very many values is cut over many tasks."""
    ordered = counts.withColumn("_down", -F.col("cnt"))
    return running_aggregate(ordered, [by], "_down", [("rank", "count", F.lit(1))], tiebreak=[value]).drop("_down")


def topn_window(
    df: DataFrame, et: str, value: str, size: str, slide: str | None, n: int
) -> DataFrame:
    return rank_top_n(window_value_counts(df, et, value, size, slide), n, "window_end", value)


def topn_text_report(top: DataFrame, value: str = "vc") -> DataFrame:
    """TK03 report line per rank (the count is printed, not the window end)."""
    end_text = F.date_format(from_epoch_ms(F.col("window_end")), "yyyy-MM-dd HH:mm:ss.SSS")
    return top.select(
        "window_end",
        "rank",
        F.format_string(
            "No.%d vc=%d count=%d window_end=%s", F.col("rank"), F.col(value), F.col("cnt"), end_text
        ).alias("line"),
    )
