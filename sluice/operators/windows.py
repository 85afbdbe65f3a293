"""Time, session, count and global windows.

Window bounds are reported like the reference: half-open ``[start, end)`` in
epoch milliseconds (``window_start``, ``window_end`` BIGINT columns).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.time import duration_us, epoch_ms, epoch_us, floor_div, shift_seconds
from sluice.operators.rolling import ROWS_PER_BLOCK, blocks_of, null_free_keys, running_aggregate


def with_window(df: DataFrame, et: str, size: str, slide: str | None = None) -> DataFrame:
    """Assign tumbling (``slide=None``) or sliding windows; a row lands in
    ``size/slide`` windows (Spark plans this as ``Expand``)."""
    w = F.window(et, size, slide) if slide else F.window(et, size)
    return df.withColumn("_win", w)


def window_bounds() -> list[Column]:
    """``[start, end)`` of the assigned window in epoch ms."""
    return [
        epoch_ms(F.col("_win.start")).alias("window_start"),
        epoch_ms(F.col("_win.end")).alias("window_end"),
    ]


def window_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    size: str,
    aggs: Sequence[Column],
    slide: str | None = None,
) -> DataFrame:
    """Keyed (or, with no keys, window-all - W10) windowed aggregate.

    Partial aggregation runs before the exchange, so the window-all form stays
    parallel too.
    """
    g = with_window(df, et, size, slide).groupBy(*keys, "_win").agg(*aggs)
    rest = [c for c in g.columns if c not in (*keys, "_win")]
    return g.select(*keys, *window_bounds(), *rest)


_PANE_AGG = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def sliding_pane_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    size: str,
    slide: str,
    specs: Sequence[tuple[str, str, Column]],
) -> DataFrame:
    """W03/W04/W10 sliding windows for decomposable aggregates (sum, count,
    min, max given as ``(name, kind, expr)``), through *panes*.

    ``window(et, size, slide)`` copies every row into ``size/slide`` windows
    before aggregating (``Expand``), so a 1 day / 1 minute window multiplies
    the rows by 1,440.  Here rows are first aggregated per key and pane (width
    ``gcd(size, slide)``, partial aggregation before the shuffle), and only
    the one row per key and pane is copied into the windows that contain the
    pane and combined.  Same windows as ``window()``: starts at multiples of
    ``slide``, half-open ``[start, start + size)``, only windows with rows.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if not 0 < slide_us <= size_us:
        raise ValueError("slide must be positive and at most the window size (as for window())")
    pane_us = math.gcd(size_us, slide_us)
    t = epoch_us(et)
    panes = df.filter(t.isNotNull()).groupBy(*keys, floor_div(t, pane_us).alias("_pane")).agg(
        *[_PANE_AGG[k][0](e).alias(f"_p_{n}") for n, k, e in specs]
    )
    ps = F.col("_pane") * F.lit(pane_us)
    # windows [j*slide, j*slide + size) that contain the whole pane
    lo = -floor_div(-(ps + F.lit(pane_us - size_us)), slide_us)
    hi = floor_div(ps, slide_us)
    w = panes.withColumn("_j", F.explode(F.sequence(lo, hi))).withColumn("_ws", F.col("_j") * F.lit(slide_us))
    g = w.groupBy(*keys, "_ws").agg(*[_PANE_AGG[k][1](F.col(f"_p_{n}")).alias(n) for n, k, _ in specs])
    return g.select(
        *keys,
        floor_div("_ws", 1000).alias("window_start"),
        floor_div(F.col("_ws") + F.lit(size_us), 1000).alias("window_end"),
        *[n for n, _, _ in specs],
    )


def window_process(
    df: DataFrame, keys: Sequence[str], et: str, size: str, slide: str | None = None
) -> DataFrame:
    """W13 full-window function: every element with its window bounds and the
    element count of its window.

    The element list is never gathered into one row: counts are aggregated per
    window (partial aggregation) and joined back to the rows on (key, window).
    """
    w, part = null_free_keys(with_window(df, et, size, slide), keys)
    counts = w.groupBy(*part, "_win").agg(F.count(F.lit(1)).alias("count"))
    return w.join(counts, [*part, "_win"]).select(
        *keys, *window_bounds(), "count", *[c for c in df.columns if c not in keys]
    )


def session_numbers(
    df: DataFrame,
    keys: Sequence[str],
    t_us: str,
    gap_us: int,
    tiebreak: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
    name: str = "_sess",
    block: str | None = "find",
) -> DataFrame:
    """Number the gap sessions of each key.

    Keys that are whole: two windows over one shuffle.  Keys that are cut, in
    one block-decomposed pass.  Inside a (key, block): a break is a row at least ``gap`` after its local
    predecessor; the running count of breaks numbers the local sessions.  Per
    block only (first, last, breaks) is kept; a small per-key scan over the
    blocks adds the break at a block's first row (gap to the previous block's
    last row) and the breaks of all earlier blocks.
    """
    d, part, blk, _ = blocks_of(df, keys, t_us, tiebreak, rows_per_block, block)
    order = [F.col(t_us)] + [F.col(c) for c in tiebreak]
    w = Window.partitionBy(*part).orderBy(*order)
    prev = F.lag(t_us).over(w)
    d = d.withColumn("_brk", F.when(prev.isNotNull() & (F.col(t_us) - prev >= gap_us), 1).otherwise(0))
    d = d.withColumn("_lsess", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if blk is None:
        return d.select(*df.columns, (F.col("_lsess") + 1).alias(name))
    tot = d.groupBy(*part).agg(
        F.min(t_us).alias("_first"), F.max(t_us).alias("_last"), F.sum("_brk").alias("_brks")
    )
    wb = Window.partitionBy(*part[:-1]).orderBy(blk)
    prev_last = F.lag("_last").over(wb)
    tot = tot.withColumn("_fbrk", F.when(prev_last.isNull() | (F.col("_first") - prev_last >= gap_us), 1).otherwise(0))
    tot = tot.withColumn(
        "_before",
        F.coalesce(
            F.sum(F.col("_brks") + F.col("_fbrk")).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    pre = tot.select(*part, (F.col("_before") + F.col("_fbrk")).alias("_base"))
    out = d.join(pre, part, "inner")
    return out.select(*df.columns, (F.col("_base") + F.col("_lsess")).alias(name))


def session_windows(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    gap: str,
    aggs: Sequence[Column],
    tiebreak: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """W05/W06 gap-based sessions: a row at least ``gap`` after the previous
    row of its key opens a new session; a session spans ``[first, last+gap)``.

    Same result as ``groupBy(key, session_window(et, gap))`` in batch, but a
    hot key is cut (:func:`session_numbers`) and so spread over many tasks.
    Whole keys are numbered and aggregated behind one shuffle.
    """
    gap_us = duration_us(gap)
    d = df.withColumn("_t_us", epoch_us(et))
    d = session_numbers(d, keys, "_t_us", gap_us, tiebreak, rows_per_block)
    g = d.groupBy(*keys, "_sess").agg(
        F.min(et).alias("_s"), F.max(et).alias("_e"), *aggs
    )
    rest = [c for c in g.columns if c not in (*keys, "_sess", "_s", "_e")]
    return g.select(
        *keys,
        epoch_ms("_s").alias("window_start"),
        (epoch_ms("_e") + F.lit(gap_us // 1000)).alias("window_end"),
        *rest,
    )


def count_window(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    size: int,
    aggs: Sequence[Column],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """W07 tumbling count window: fires for every ``size`` rows of a key; the
    incomplete last group never fires."""
    d = running_aggregate(df, keys, order, [("_rn", "count", F.lit(1))], rows_per_block)
    d = d.withColumn("window_no", F.floor((F.col("_rn") - 1) / size).cast("bigint"))
    g = d.groupBy(*keys, "window_no").agg(F.count(F.lit(1)).alias("_n"), *aggs)
    return g.filter(F.col("_n") == size).drop("_n")


def count_window_sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    size: int,
    slide: int,
    aggs: Sequence[Column],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """W08 sliding count window: fires at every ``slide``-th row of a key over
    the last ``size`` rows (early firings hold fewer rows).

    Row number ``r`` belongs to the firings ``e`` with ``e % slide == 0`` and
    ``r <= e <= r + size - 1`` - at most ``ceil(size/slide)`` copies, so every
    group is bounded by ``size`` rows.
    """
    d = running_aggregate(df, keys, order, [("_rn", "count", F.lit(1))], rows_per_block)
    first = F.ceil(F.col("_rn") / slide) * slide
    d = d.withColumn(
        "fire_at", F.explode(F.sequence(first.cast("bigint"), (F.col("_rn") + size - 1).cast("bigint"), F.lit(slide).cast("bigint")))
    )
    g = d.groupBy(*keys, "fire_at").agg(F.max("_rn").alias("_last"), *aggs)
    return g.filter(F.col("_last") == F.col("fire_at")).drop("_last")


def processing_time(df: DataFrame, name: str = "pt") -> DataFrame:
    """Processing time for W02/W04/W06 in streaming; batch tests use an
    ``arrival`` column instead."""
    return df.withColumn(name, F.current_timestamp())


__all__ = [
    "with_window",
    "window_bounds",
    "window_aggregate",
    "window_process",
    "session_windows",
    "count_window",
    "count_window_sliding",
    "processing_time",
    "shift_seconds",
]
