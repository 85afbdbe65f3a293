"""Keyed stateful processors (ST01-ST12, W07 stream form) for
``groupBy(key).transformWithStateInPandas``.

Rows of one key arrive as pandas frames (Arrow batches), are ordered by
``seq`` (the API does not order rows inside a key), and are processed with
vectorised pandas where the state allows it.  State lives in the RocksDB
state store and is checkpointed with the query, unlike the reference's plain
fields.

Notes kept from probing the API: ``handleExpiredTimer`` is called with
keyword arguments (``key``, ``timerValues``, ``expiredTimerInfo``); TTL is
only accepted in ProcessingTime mode.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from sluice.session import ship_package
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def _ordered(rows: Iterator[pd.DataFrame], seq: str | list[str] = "seq") -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(seq, kind="stable")


class KeyedProcess(StatefulProcessor):
    """ST12 keyed process function surface: ``open(handle)`` declares state,
    ``process(key, frame, timer_values)`` gets the key's new rows ordered by
    ``seq`` and yields output frames, ``on_timer`` handles expired timers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:  # pragma: no cover - hook
        pass

    # The columns by which a key's rows of a micro-batch are ordered.
    order: str | list[str] = "seq"

    # Set by ``apply_processor`` on a table whose rows are already in
    # ``(key, seq)`` order: frames are then processed one at a time (memory
    # of one Arrow batch, never the whole key) and their order is checked.
    presorted: str | None = None

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if not self.presorted:
            # a stream: the key's rows of one micro-batch, bounded by the trigger
            frame = _ordered(rows, self.order)
            if len(frame):
                yield from self.process(key, frame, timerValues)
            return
        last = None
        for frame in rows:
            if not len(frame):
                continue
            order = frame[self.presorted]
            if not order.is_monotonic_increasing or (last is not None and order.iloc[0] < last):
                raise RuntimeError(f"rows of key {key} are not in {self.presorted} order")
            last = order.iloc[-1]
            yield from self.process(key, frame.reset_index(drop=True), timerValues)

    def process(self, key, frame: pd.DataFrame, timer_values: TimerValues) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        yield from self.on_timer(key, timerValues, expiredTimerInfo.getExpiryTimeInMs())

    def on_timer(self, key, timer_values: TimerValues, expiry_ms: int) -> Iterator[pd.DataFrame]:
        return iter(())

    def close(self) -> None:
        pass


class RunningSum(KeyedProcess):
    """ST04 ReducingState(sum): one running sum per input row."""

    output = "seq long, id long, sum_vc long"

    def open(self, handle):
        self.total = handle.getValueState("total", StructType([StructField("v", LongType())]))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The key's sum of another query (``v``), to go on from."""
        self.total.update((int(initialState["v"].iloc[0]),))

    def process(self, key, frame, timer_values):
        base = self.total.get()[0] if self.total.exists() else None
        seen = frame["vc"].notna().cummax() | (base is not None)
        sums = (frame["vc"].fillna(0).astype("int64").cumsum() + (base or 0)).astype("Int64").where(seen)
        if seen.iloc[-1]:  # no reading yet: no sum yet
            self.total.update((int(sums.iloc[-1]),))
        yield pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "sum_vc": sums})


class RunningAvg(KeyedProcess):
    """ST05 AggregatingState(avg) with a (sum, count) accumulator."""

    output = "seq long, id long, avg_vc double"

    def open(self, handle):
        self.acc = handle.getValueState(
            "acc", StructType([StructField("s", DoubleType()), StructField("c", LongType())])
        )

    def process(self, key, frame, timer_values):
        s0, c0 = self.acc.get() if self.acc.exists() else (0.0, 0)
        v = frame["vc"].astype("float64")
        s = v.fillna(0).cumsum() + s0
        c = v.notna().astype("int64").cumsum() + c0
        self.acc.update((float(s.iloc[-1]), int(c.iloc[-1])))
        yield pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "avg_vc": (s / c.where(c > 0)).round(6)})


class ValueJump(KeyedProcess):
    """ST01 ValueState: previous reading (starts at 0); alert on a jump."""

    output = "seq long, id long, vc int, prev int"

    def __init__(self, threshold: int):
        self.threshold = threshold

    def open(self, handle):
        self.last = handle.getValueState("last", StructType([StructField("vc", IntegerType())]))

    def process(self, key, frame, timer_values):
        vc = frame["vc"].astype("Int64")
        prev = vc.shift(1)
        prev.iloc[0] = self.last.get()[0] if self.last.exists() else 0
        self.last.update((None if pd.isna(vc.iloc[-1]) else int(vc.iloc[-1]),))
        out = pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "vc": vc.astype("Int32"), "prev": prev.astype("Int32")})
        yield out[((vc - prev).abs() > self.threshold).fillna(False).to_numpy(bool)]


class TopK(KeyedProcess):
    """ST02 ListState: the k largest values so far, emitted once per input."""

    output = "seq long, id long, top3 string"

    def __init__(self, k: int = 3):
        self.k = k

    def open(self, handle):
        self.top = handle.getListState("top", StructType([StructField("vc", IntegerType())]))

    def process(self, key, frame, timer_values):
        # k running maxima: what a value pushes out of one feeds the next
        top = sorted((r[0] for r in self.top.get()), reverse=True)
        low = -(1 << 62)
        x = frame["vc"].astype("Int64").fillna(low).astype("int64").to_numpy()
        columns = []
        for i in range(self.k):
            best = np.maximum.accumulate(np.concatenate([[top[i] if i < len(top) else low], x]))
            columns.append(best[1:])
            x = np.minimum(x, best[:-1])
        texts = [",".join(str(v) for v in row if v != low) for row in np.stack(columns, axis=1).tolist()]
        if columns[0][-1] != low:  # an empty list cannot be stored
            self.top.put([(int(c[-1]),) for c in columns if c[-1] != low])
        yield pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "top3": texts})


class ValueCounts(KeyedProcess):
    """ST03 MapState ``vc -> count``; emits the updated count per input."""

    output = "seq long, id long, vc int, cnt long"

    def open(self, handle):
        self.counts = handle.getMapState(
            "counts", StructType([StructField("vc", IntegerType())]), StructType([StructField("n", LongType())])
        )
        self.null_count = handle.getValueState("null_count", StructType([StructField("n", LongType())]))

    def process(self, key, frame, timer_values):
        # one read of the key's map and one write per changed value per
        # batch; the per-row counts are a vectorised running count.  Null
        # readings are a value of their own, outside the integers.
        none = -(1 << 40)
        vc = frame["vc"].astype("Int64").fillna(none).astype("int64")
        stored = {none if k[0] is None else int(k[0]): int(v[0]) for k, v in self.counts.iterator()}
        nulls = self.null_count.get()[0] if self.null_count.exists() else 0
        stored[none] = nulls
        cnt = vc.groupby(vc).cumcount().astype("int64") + 1 + vc.map(stored).fillna(0).astype("int64")
        last = pd.DataFrame({"vc": vc, "cnt": cnt}).groupby("vc")["cnt"].max()
        for v, n in last.items():
            if v == none:
                self.null_count.update((int(n),))
            else:
                self.counts.updateValue((int(v),), (int(n),))
        yield pd.DataFrame(
            {"seq": frame["seq"].astype("int64"), "id": key[0], "vc": vc.astype("Int64").where(vc != none).astype("Int32"), "cnt": cnt}
        )


class CountWindow(KeyedProcess):
    """W07 count window: fires every ``size`` rows of a key."""

    output = "id long, window_no long, first_seq long, last_seq long, sum_vc long"

    def __init__(self, size: int):
        self.size = size

    def open(self, handle):
        self.acc = handle.getValueState(
            "acc",
            StructType(
                [
                    StructField("n", LongType()),
                    StructField("fired", LongType()),
                    StructField("first", LongType()),
                    StructField("s", LongType()),
                ]
            ),
        )

    def process(self, key, frame, timer_values):
        # ``s`` is null while the open window has no reading but null ones
        n, fired, first, s = self.acc.get() if self.acc.exists() else (0, 0, None, None)
        d = pd.DataFrame({"seq": frame["seq"].astype("int64").to_numpy(), "vc": frame["vc"].astype("Int64").to_numpy()})
        groups = d.groupby(fired + (np.arange(len(d)) + n) // self.size)
        g = groups.agg(first_seq=("seq", "first"), last_seq=("seq", "last"), rows=("seq", "size"))
        g["sum_vc"] = groups["vc"].sum(min_count=1).astype("Int64")
        if n:  # the window left open by earlier frames
            head = g.index[0]
            g.loc[head, "first_seq"], g.loc[head, "rows"] = first, g.loc[head, "rows"] + n
            if s is not None:
                g.loc[head, "sum_vc"] = s + (0 if pd.isna(g.loc[head, "sum_vc"]) else g.loc[head, "sum_vc"])
        tail = g.iloc[-1]
        if tail["rows"] < self.size:
            self.acc.update((int(tail["rows"]), int(g.index[-1]), int(tail["first_seq"]), None if pd.isna(tail["sum_vc"]) else int(tail["sum_vc"])))
        else:
            self.acc.update((0, int(g.index[-1]) + 1, None, None))
        full = g[g["rows"] == self.size]
        if len(full):
            yield full.drop(columns="rows").reset_index(names="window_no").assign(id=key[0])[["id", "window_no", "first_seq", "last_seq", "sum_vc"]]


class SlidingCountWindow(KeyedProcess):
    """W08 sliding count window: at every ``slide``-th row of a key, the last
    ``size`` rows (early firings hold fewer)."""

    output = "id long, fire_at long, first_seq long, last_seq long, sum_vc long"

    def __init__(self, size: int, slide: int):
        self.size = size
        self.slide = slide

    def open(self, handle):
        self.rows = handle.getValueState("rows", StructType([StructField("n", LongType())]))
        self.last = handle.getListState("last", StructType([StructField("seq", LongType()), StructField("vc", LongType())]))

    def process(self, key, frame, timer_values):
        n = self.rows.get()[0] if self.rows.exists() else 0
        kept = pd.DataFrame(list(self.last.get()), columns=["seq", "vc"])
        new = pd.DataFrame({"seq": frame["seq"].to_numpy(), "vc": frame["vc"].astype("Int64").to_numpy()})
        d = pd.concat([kept.astype({"vc": "Int64"}), new], ignore_index=True)
        total, before = n + len(new), n - len(kept)  # ``before``: rows that ``d`` no longer holds
        fires = np.arange((n // self.slide + 1) * self.slide, total + 1, self.slide)
        out = []
        for e in fires.tolist():  # one for ``slide`` rows
            w = d.iloc[max(0, e - self.size - before) : e - before]
            s = w["vc"].sum(min_count=1)
            out.append((key[0], e, int(w["seq"].iloc[0]), int(w["seq"].iloc[-1]), s))
        tail = d.iloc[-self.size :]
        self.rows.update((total,))
        self.last.put([(int(a), None if pd.isna(b) else int(b)) for a, b in zip(tail["seq"], tail["vc"])])
        if out:
            yield pd.DataFrame(out, columns=["id", "fire_at", "first_seq", "last_seq", "sum_vc"]).astype({"sum_vc": "Int64"})


class TtlValue(KeyedProcess):
    """ST06 ValueState with TTL (ProcessingTime mode).  Spark refreshes the
    TTL on write; a read refreshes it here by writing the value back."""

    output = "seq long, id long, vc int, old_value int"

    def __init__(self, ttl_ms: int, keep_if_above: int):
        self.ttl_ms = ttl_ms
        self.keep_if_above = keep_if_above

    def open(self, handle):
        self.value = handle.getValueState("v", StructType([StructField("vc", IntegerType())]), self.ttl_ms)

    def process(self, key, frame, timer_values):
        # the rows of a batch come at one processing time: one read, one write
        old = self.value.get()[0] if self.value.exists() else None
        vc = frame["vc"].astype("Int64")
        kept = vc.where((vc > self.keep_if_above).fillna(False)).ffill()
        if old is not None:
            kept = kept.fillna(old)
        if not pd.isna(kept.iloc[-1]):  # a read refreshes the TTL, too
            self.value.update((int(kept.iloc[-1]),))
        before = kept.shift(1)
        before.iloc[0] = pd.NA if old is None else old
        yield pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "vc": vc.astype("Int32"), "old_value": before.astype("Int32")})


class EventTimers(KeyedProcess):
    """ST09 event-time timer at ``et + offset`` per row (EventTime mode);
    one timer per (key, time); fires once the watermark passes it."""

    output = "id long, timer_ms long, fired_wm_ms long"

    def __init__(self, offset_ms: int):
        self.offset_ms = offset_ms

    def process(self, key, frame, timer_values):
        for t in frame["et_ms"].tolist():
            self.handle.registerTimer(int(t) + self.offset_ms)
        return iter(())

    def on_timer(self, key, timer_values, expiry_ms):
        yield pd.DataFrame(
            {"id": [key[0]], "timer_ms": [expiry_ms], "fired_wm_ms": [timer_values.getCurrentWatermarkInMs()]}
        )


class ClockReader(KeyedProcess):
    """T09 time progress: each row with the processing time and the watermark
    that its function reads (null where the time mode has no such clock)."""

    output = "seq long, id long, processing_ms long, watermark_ms long"

    def __init__(self, time_mode: str):
        self.time_mode = time_mode

    def process(self, key, frame, timer_values):
        now = timer_values.getCurrentProcessingTimeInMs() if self.time_mode == "ProcessingTime" else None
        mark = timer_values.getCurrentWatermarkInMs() if self.time_mode == "EventTime" else None
        out = pd.DataFrame({"seq": frame["seq"].astype("int64"), "id": key[0], "processing_ms": now, "watermark_ms": mark})
        yield out.astype({"processing_ms": "Int64", "watermark_ms": "Int64"})


class InactivityTimer(KeyedProcess):
    """ST10/ST11 processing- or event-time inactivity alert: every row deletes
    the pending timer and registers a new one ``limit`` later.  A gap over the
    limit between rows that come together alerts at once; a row out of order
    never moves the timer back."""

    output = "id long, timer_ms long"

    def __init__(self, limit_ms: int, time_col: str = "et_ms"):
        self.limit_ms = limit_ms
        self.time_col = time_col

    def open(self, handle):
        self.pending = handle.getValueState("pending", StructType([StructField("t", LongType())]))

    def process(self, key, frame, timer_values):
        if self.time_col in frame:
            times = np.sort(frame[self.time_col].dropna().to_numpy(dtype="int64"))
        else:
            times = np.array([timer_values.getCurrentProcessingTimeInMs()])
        if not len(times):
            return
        if self.pending.exists():
            armed = self.pending.get()[0]
            self.handle.deleteTimer(armed)
            times = np.concatenate([[armed - self.limit_ms], times[times > armed - self.limit_ms]])
        missed = times[:-1][np.diff(times) > self.limit_ms] + self.limit_ms
        t = int(times[-1]) + self.limit_ms
        self.handle.registerTimer(t)
        self.pending.update((t,))
        if len(missed):
            yield pd.DataFrame({"id": key[0], "timer_ms": missed})

    def on_timer(self, key, timer_values, expiry_ms):
        self.pending.clear()
        yield pd.DataFrame({"id": [key[0]], "timer_ms": [expiry_ms]})


class LateRouter(KeyedProcess):
    """T05 late rows as a tagged output of one stateful operator: each key (a
    source, or a partition of it) keeps the maximum of its event times, and its
    rows leave in arrival order with ``late``, by the clock before each row.
    Table form: ``late.split_late(..., keys=[key])``.  The key's rows have
    ``seq``, ``et_us`` and ``arr_us``."""

    order = ["arr_us", "seq"]

    def __init__(self, key: str, delay_s: int, window_s: int | None = None):
        self.delay, self.window = delay_s * 1_000_000, window_s and window_s * 1_000_000
        self.output = f"seq long, {key} long, et_us long, arr_us long, late boolean"
        self.key = key

    def open(self, handle):
        self.top = handle.getValueState("top", StructType([StructField("et_us", LongType())]))

    def process(self, key, frame, timer_values):
        low = -(1 << 62)
        et = frame["et_us"].astype("Int64").fillna(low).astype("int64").to_numpy()
        tops = np.maximum.accumulate(np.concatenate([[self.top.get()[0] if self.top.exists() else low], et]))
        if tops[-1] > low:
            self.top.update((int(tops[-1]),))
        clock = tops[:-1] - self.delay
        late = et - et % self.window + self.window <= clock if self.window else et < clock
        late &= (et > low) & (tops[:-1] > low)
        yield pd.DataFrame({"seq": frame["seq"].astype("int64"), self.key: key[0], "et_us": frame["et_us"].astype("Int64"), "arr_us": frame["arr_us"].astype("int64"), "late": late})


class KeyedRule(KeyedProcess):
    """J08 keyed broadcast rule: config rows (``kind == 0``) set the key's
    threshold (last wins, default 0); data rows above it alert.  Rows are
    taken in (arrival, kind, seq) order."""

    output = "seq long, id long, vc int, threshold int"

    def __init__(self, default: int = 0):
        self.default = default

    def open(self, handle):
        self.thr = handle.getValueState("thr", StructType([StructField("v", IntegerType())]))

    def handleInputRows(self, key, rows, timerValues):
        order = ["arr_us", "kind", "seq"]
        frames = (f for f in rows if len(f))
        if not self.presorted:
            whole = list(frames)  # one micro-batch of the key, bounded by the trigger
            frames = [pd.concat(whole, ignore_index=True)] if whole else []
        thr, seen = self.thr.get()[0] if self.thr.exists() else self.default, False
        for frame in frames:
            frame, seen = frame.sort_values(order, kind="stable").reset_index(drop=True), True
            vc, config = frame["vc"].astype("Int64"), frame["kind"] == 0
            # a config without a value leaves the default
            rule = vc.fillna(self.default).where(config).ffill().fillna(thr)
            thr = int(rule.iloc[-1])
            alert = (~config & (vc > rule).fillna(False)).to_numpy(bool)
            if alert.any():
                yield pd.DataFrame({"seq": frame["seq"][alert].astype("int64"), "id": key[0], "vc": vc[alert].astype("int32"), "threshold": rule[alert].astype("int32")})
        if seen:
            self.thr.update((thr,))


def apply_processor(
    df, key: str, processor: KeyedProcess, time_mode: str = "None", output_mode: str = "Append", order: str | None = "seq", initial_state=None
):
    """``groupBy(key).transformWithStateInPandas(processor)``; works on batch
    frames (one pass) and streams.

    On a table (not a stream) with an ``order`` column, the rows are first
    hash-partitioned by key exactly as the stateful operator needs and sorted
    by ``(key, order)`` inside each partition; the operator reuses that
    partitioning without another sort, so each key's rows arrive in order
    and are processed batch by batch -- a hot key is streamed through its
    state, never gathered into one frame.
    """
    import sluice

    spark = df.sparkSession
    ship_package(spark)
    spark.streams.active  # registers the state store coordinator (needed in batch mode too)
    processor = copy.copy(processor)  # the caller's may serve a stream next
    if order and not df.isStreaming:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, key).sortWithinPartitions(key, order)
        processor.presorted = order
    # The state worker beside the driver gets no shipped files: the processor
    # travels with its code.
    cloudpickle.register_pickle_by_value(sluice)
    try:
        return df.groupBy(key).transformWithStateInPandas(
            statefulProcessor=processor,
            outputStructType=processor.output,
            outputMode=output_mode,
            timeMode=time_mode,
            initialState=initial_state.groupBy(key) if initial_state is not None else None,
        )
    finally:
        cloudpickle.unregister_pickle_by_value(sluice)


def read_state(spark, checkpoint: str, name: str, key: str, batch_id: int | None = None, operator: int = 0):
    """C02 the state ``name`` of a stopped query as a table: the key and the
    state's fields, as they were after ``batch_id`` (none: the last batch)."""
    reader = spark.read.format("statestore").option("stateVarName", name).option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    d = reader.load(checkpoint)
    return d.select(d["key"].getField(d.schema["key"].dataType.names[0]).alias(key), "value.*")
