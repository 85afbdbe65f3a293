"""Event time, watermarks and late data (T01-T06), batch (column) forms.

Spark judges lateness inside a stream with the previous micro-batch's
watermark and only *drops* late rows, so routing late rows to a side output is
done here, explicitly, on an ``arrival`` ordering:

* ``wm_before`` of a row = (max event time over all *earlier* arrivals) -
  delay.  The library the reference runs on subtracts one more millisecond;
  that detail is left out.
* a row is late (record form) iff ``et < wm_before``; its window is closed
  (window form) iff ``window_end <= wm_before``.

The prefix maximum runs through :func:`rolling.running_aggregate` with no key:
arrival blocks are maximised locally and combined through a small prefix, so
no single task ever sees more than a block's rows, cut where the data lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import duration_us, epoch_us, from_epoch_seconds
from sluice.operators.rolling import ROWS_PER_BLOCK, running_aggregate, with_blocks


def assign_event_time(df: DataFrame, seconds_col: str = "ts", name: str = "et") -> DataFrame:
    """T01 timestamp = seconds field x 1000 ms."""
    return df.withColumn(name, from_epoch_seconds(seconds_col))


def with_watermark_before(
    df: DataFrame,
    et: str,
    arrival: str,
    delay_s: int,
    name: str = "wm_before_us",
    tiebreak: Sequence[str] = ("seq",),
    rows_per_block: int = ROWS_PER_BLOCK,
    keys: Sequence[str] = (),
) -> DataFrame:
    """T02/T03 batch watermark: ``max(et of earlier arrivals) - delay`` in
    epoch microseconds (null before the first row).  ``delay_s=0`` is the
    monotonous strategy.  With ``keys`` (a source, a partition of it) each has
    a clock of its own."""
    d = df.withColumn("_arr_us", epoch_us(arrival)).withColumn("_et_us", epoch_us(et))
    d = running_aggregate(
        d, list(keys), "_arr_us", [("_max_et", "max", F.col("_et_us"))], rows_per_block, list(tiebreak), exclusive=True
    )
    return d.withColumn(name, F.col("_max_et") - F.lit(delay_s * 1_000_000)).drop("_max_et", "_arr_us", "_et_us")


def split_late(
    df: DataFrame,
    et: str,
    arrival: str,
    delay_s: int,
    window: str | None = None,
    tiebreak: Sequence[str] = ("seq",),
    keys: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """T05 ``(on_time, late)``.  With ``window`` (tumbling size) a row is late
    when its window had closed at its arrival, else when its own event time is
    behind the watermark."""
    d = with_watermark_before(df, et, arrival, delay_s, tiebreak=tiebreak, keys=keys)
    if window:
        size = duration_us(window)
        t = epoch_us(et)
        end = (t - F.pmod(t, F.lit(size))) + F.lit(size)
        late = end <= F.col("wm_before_us")
    else:
        late = epoch_us(et) < F.col("wm_before_us")
    d = d.withColumn("_late", F.coalesce(late, F.lit(False)))
    return d.filter(~F.col("_late")).drop("_late"), d.filter(F.col("_late")).drop("_late")


def combined_watermark(
    df: DataFrame,
    source: str,
    sources: Sequence,
    et: str,
    arrival: str,
    delay_s: int,
    idle_s: int | None = None,
    name: str = "wm_before_us",
    tiebreak: Sequence[str] = ("seq",),
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """T04/T06 the clock of a task with several inputs: the minimum over the
    inputs' watermarks (an input without rows yet holds it at -inf = null).

    With ``idle_s`` (T04 idleness) an input whose last arrival - for an input
    not heard yet, the first arrival of all - is at least ``idle_s`` old no
    longer holds the minimum back; the combined clock never
    moves backwards (running max of the minimum).  ``sources`` is the fixed,
    known list of inputs.
    """
    d = df.withColumn("_arr_us", epoch_us(arrival)).withColumn("_et_us", epoch_us(et))
    d, _, is_cut = with_blocks(d, [], "_cut", "_arr_us", list(tiebreak), rows_per_block)
    block = "_cut" if is_cut else None
    specs = [("_began", "min", F.col("_arr_us"))]
    for i, s in enumerate(sources):
        mine = F.col(source) == F.lit(s)
        specs.append((f"_mx{i}", "max", F.when(mine, F.col("_et_us"))))
        specs.append((f"_la{i}", "max", F.when(mine, F.col("_arr_us"))))
    d = running_aggregate(d, [], "_arr_us", specs, rows_per_block, list(tiebreak), exclusive=True, block=block)
    delay = F.lit(delay_s * 1_000_000)
    if idle_s is None:
        wms = [F.col(f"_mx{i}") - delay for i in range(len(sources))]
        anynull = F.lit(False)
        for i in range(len(sources)):
            anynull = anynull | F.col(f"_mx{i}").isNull()
        cand = F.when(~anynull, F.least(*wms) if len(wms) > 1 else wms[0])
        out = d.withColumn(name, cand)
    else:
        idle = F.lit(idle_s * 1_000_000)
        busy = [
            F.coalesce(F.col("_arr_us") - F.coalesce(f"_la{i}", "_began") < idle, F.lit(True))
            for i in range(len(sources))
        ]
        active = [F.when(b, F.col(f"_mx{i}") - delay) for i, b in enumerate(busy)]
        held = F.lit(False)
        for i, b in enumerate(busy):
            held = held | b & F.col(f"_mx{i}").isNull()
        cand = F.least(*active) if len(active) > 1 else active[0]
        d = d.withColumn("_cand", F.when(~held, cand))
        # monotone: never behind an earlier value of the combined clock
        d = running_aggregate(d, [], "_arr_us", [(name, "max", F.col("_cand"))], rows_per_block, list(tiebreak), block=block)
        out = d.drop("_cand")
    drop = [c for c in out.columns if c.startswith("_mx") or c.startswith("_la")] + ["_arr_us", "_et_us", "_began", "_cut"]
    return out.drop(*drop)


def late_by_clock(df: DataFrame, et: str, clock: str = "wm_before_us") -> Column:
    return F.coalesce(epoch_us(et) < F.col(clock), F.lit(False))
