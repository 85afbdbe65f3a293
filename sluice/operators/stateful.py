"""Keyed state, timers and TTL (ST01-ST11) - batch (table) forms.

Each function gives, for a whole table, exactly the rows the streaming
stateful operator (``sluice.streaming.processors``) emits when the rows are
replayed in order.  All of them are built from the block-decomposed running
helpers, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import epoch_us, floor_div
from sluice.operators.windows import session_numbers
from sluice.operators.rolling import (
    ROWS_PER_BLOCK,
    keyed_neighbour,
    running_aggregate,
    with_blocks,
)


def value_jump(df: DataFrame, key: str, order: str, value: str, threshold: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ST01 ValueState: alert when ``|value - previous value|`` exceeds the
    threshold; the previous value starts at 0, so a first reading above the
    threshold alerts too."""
    d = keyed_neighbour(df, [key], order, value, "prev", -1, 0, rows_per_block)
    return d.filter(F.abs(F.col(value) - F.col("prev")) > threshold)


def running_counts_per_value(df: DataFrame, key: str, order: str, value: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ST03 MapState ``value -> count``: per input row, the updated count of
    its value within the key."""
    return running_aggregate(df, [key, value], order, [("cnt", "count", F.lit(1))], rows_per_block)


def running_sum(df: DataFrame, key: str, order: str, value: str, name: str = "sum", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ST04 ReducingState(sum): running sum per row."""
    return running_aggregate(df, [key], order, [(name, "sum", F.col(value))], rows_per_block)


def running_avg(df: DataFrame, key: str, order: str, value: str, name: str = "avg", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ST05 AggregatingState(avg): running (sum, count) -> sum / count."""
    d = running_aggregate(
        df,
        [key],
        order,
        [("_s", "sum", F.col(value).cast("double")), ("_c", "count", F.col(value))],
        rows_per_block,
    )
    return d.withColumn(name, F.col("_s") / F.col("_c")).drop("_s", "_c")


def ttl_value(
    df: DataFrame,
    key: str,
    arrival: str,
    value: str,
    ttl_s: int,
    keep_if_above: int,
    tiebreak: Sequence[str] = ("seq",),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """ST06 ValueState with a time-to-live refreshed by reads *and* writes.

    Every row reads the state (refresh) and emits the old value, then stores
    its own value when it is above ``keep_if_above``.  Since every row touches
    the state, the state of a key expires exactly when the gap to the key's
    previous row is at least the TTL.  So: islands of rows with gaps < TTL;
    inside an island the old value is the last stored value of earlier rows.
    """
    ttl = ttl_s * 1_000_000
    d = df.withColumn("_t", epoch_us(arrival))
    # islands = gap sessions with gap = TTL; both scans share one cut, and
    # where no key is cut, one shuffle
    d, _, is_cut = with_blocks(d, [key], "_cut", "_t", tiebreak, rows_per_block)
    block = "_cut" if is_cut else None
    d = session_numbers(d, [key], "_t", ttl, tiebreak, name="_island", block=block)
    stored = F.when(
        F.col(value) > keep_if_above,
        F.struct(F.col("_t").alias("t"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(tiebreak)], F.col(value).alias("v")),
    )
    d = running_aggregate(
        d, [key, "_island"], "_t", [("_last", "max", stored)], tiebreak=list(tiebreak), exclusive=True, block=block
    )
    return d.select(*df.columns, F.col("_last.v").alias("old_value"))


def inactivity_alerts(
    df: DataFrame, key: str, et: str, limit_s: int, tiebreak: Sequence[str] = ("seq",), rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """ST11 a timer re-armed (old one deleted) on every row: it fires when no
    further row of the key comes within ``limit``; fires only when a later
    row exists (end of input does not flush)."""
    d = df.withColumn("_t", epoch_us(et))
    d = keyed_neighbour(d, [key], "_t", "_t", "_next", +1, None, rows_per_block, list(tiebreak))
    return d.filter(F.col("_next") - F.col("_t") > limit_s * 1_000_000).select(
        *df.columns, floor_div(F.col("_next") - F.col("_t"), 1_000_000).alias("gap_s")
    )


def event_timers(
    df: DataFrame,
    key: str,
    et: str,
    arrival: str,
    delay_s: int,
    timer_offset_s: int,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """ST09 event-time timers.  Each row registers a timer at
    ``et + timer_offset`` for its key.  The watermark after a row is (max
    event time so far) - delay; a timer fires at the first row, from its
    registration on, after which the watermark has reached it.  Registrations
    of the same key and time while the timer is pending are one timer; one
    that comes after it has fired registers, and fires, anew.

    Because the watermark is a running maximum, "first row whose watermark
    reaches t" is "first arrival among rows with ``et >= t + delay``": a
    suffix minimum over event time, computed with the same ordered scan
    (descending event time) - never a pairwise comparison.  All registrations
    up to that arrival are the one pending timer; each distinct later arrival
    finds the watermark past its time and fires at once.
    """
    offset = timer_offset_s * 1_000_000
    delay = delay_s * 1_000_000
    base = df.select(F.col(key), F.col("seq"), epoch_us(et).alias("_e"), epoch_us(arrival).alias("_a"))
    timers = base.groupBy(key, (F.col("_e") + F.lit(offset)).alias("timer_us"), F.col("_a").alias("_reg_a")).agg(F.count(F.lit(1)).alias("_n"))
    probes = timers.select(
        key,
        "timer_us",
        "_reg_a",
        (-(F.col("timer_us") + F.lit(delay))).alias("_o"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("long").alias("_arr"),
        F.xxhash64(key, "timer_us", "_reg_a").alias("_id"),
    )
    rows = base.select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        F.lit(None).cast("long").alias("timer_us"),
        F.lit(None).cast("long").alias("_reg_a"),
        (-F.col("_e")).alias("_o"),
        F.lit(0).alias("_kind"),
        F.col("_a").alias("_arr"),
        F.col("seq").cast("long").alias("_id"),
    )
    u = rows.unionByName(probes).withColumn("_at", F.col("_o") * 2 + F.col("_kind"))  # rows before probes
    scanned = running_aggregate(u, [], "_at", [("_first", "min", F.col("_arr"))], rows_per_block, ["_id"])
    fire = F.when(F.col("_first").isNotNull(), F.greatest(F.col("_first"), F.col("_reg_a")))
    # one row for each firing; a timer that never fires has one row, too
    fired = scanned.filter(F.col("_kind") == 1).select(key, "timer_us", fire.alias("_fire")).distinct()
    return fired.select(
        key,
        floor_div("timer_us", 1000).alias("timer_ms"),
        floor_div("_fire", 1000).alias("fired_at_ms"),
    )


# ------------------------------------------------------------ rolling top-k

def rolling_top_k(df: DataFrame, key: str, order: str, value: str, k: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ST02 ListState top-k: per input row, the ``k`` largest values of the
    key so far (descending); null values are not stored.

    ``k`` running maxima in a row: the first is the maximum so far; what a
    value pushes out of it - the smaller of the value and the maximum before -
    is the input of the second, and so on.  All of them scan the same order,
    so whole keys need one shuffle and one sort.
    """
    d = df.select(key, order, F.col(value).alias("_x"))
    d, _, is_cut = with_blocks(d, [key], "_cut", order, (), rows_per_block)
    for i in range(k):
        d = running_aggregate(d, [key], order, [(f"_p{i}", "max", F.col("_x"))], exclusive=True, block="_cut" if is_cut else None)
        both = F.col("_x").isNotNull() & F.col(f"_p{i}").isNotNull()
        d = d.withColumn(f"_top{i}", F.greatest(f"_p{i}", "_x")).withColumn("_x", F.when(both, F.least(f"_p{i}", "_x")))
    return d.select(key, order, F.array_compact(F.array(*[f"_top{i}" for i in range(k)])).alias("top"))
