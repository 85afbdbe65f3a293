"""Joins, merges and rule streams.

* window join     - equi-join on (key, window): Spark's shuffle join; AQE
                    splits skewed partitions.
* interval join   - equi key plus a closed time range.  A plain key join
                    would compare every pair of a hot key; here both sides
                    also join on a time bucket of the interval's width (the
                    left row probes its own and both neighbouring buckets),
                    so only nearby rows meet.
* rule streams    - "latest config at or before my arrival" (as-of) by one
                    ordered scan of the tagged union: a running max of
                    ``struct(arrival, seq, value)`` over config rows.  No
                    broadcast is needed, so the config side may be any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import epoch_us, floor_div
from sluice.operators.late import combined_watermark, late_by_clock
from sluice.operators.rolling import BROADCAST_KEYS, ROWS_PER_BLOCK, running_aggregate
from sluice.session import written


def window_join(
    left: DataFrame, right: DataFrame, key: str, et: str, size: str, lcols: Sequence[str], rcols: Sequence[str]
) -> DataFrame:
    """J01 inner join of rows with the same key in the same tumbling window."""
    lw = left.select(F.col(key), F.window(et, size).alias("_win"), *[F.col(c).alias(f"l_{c}") for c in lcols])
    rw = right.select(F.col(key), F.window(et, size).alias("_win"), *[F.col(c).alias(f"r_{c}") for c in rcols])
    return lw.join(rw, [key, "_win"], "inner")


#: Rows of a key on one side up to which it is joined as it is.
ROWS_PER_PART = 1 << 18


def heavy_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> tuple[DataFrame, int]:
    """The keys with more than ``rows_per_part`` rows on either side, and how
    many: ``k0, ...``, whether the left side is the larger and is split
    (``by_left``), and into how many ``parts``.  One count a side, combined on
    the map side; keys that one side lacks are none."""
    def counted(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias(name))

    names = [f"k{i}" for i in range(len(left_keys))]
    both = counted(left, left_keys, "l").join(counted(right, right_keys, "r"), names)
    most = F.greatest("l", "r")
    heavy = both.filter(most > rows_per_part).select(*names, (F.col("l") >= F.col("r")).alias("by_left"), F.ceil(most / rows_per_part).cast("int").alias("parts"))
    heavy = written(heavy, "heavy-keys")
    return heavy, heavy.count()


def heavy_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    lcols: Sequence[str],
    rcols: Sequence[str],
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Inner equi-join (J01, J04) that does not rest on adaptive execution for
    a heavy key: its rows on the larger side are dealt into parts by a hash of
    the row (so that a task that runs again deals alike; equal rows stay
    together), and each of its rows on the other side is copied to every part.
    So a task gets about ``rows_per_part`` rows of the larger side of a key.
    Without heavy keys it is the plain join; null keys join nothing."""
    lx = left.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(left_keys)], *[F.col(c).alias(f"_l_{c}") for c in lcols])
    rx = right.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(right_keys)], *[F.col(c).alias(f"_r_{c}") for c in rcols])
    keys = [f"_k{i}" for i in range(len(left_keys))]
    out = [F.col(f"_l_{c}").alias(c) for c in lcols] + [F.col(f"_r_{c}").alias(c) for c in rcols]
    heavy, n = heavy_keys(left, right, left_keys, right_keys, rows_per_part)
    if not n:
        return lx.join(rx, keys).select(*out)
    of = heavy.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
    of = F.broadcast(of) if n <= BROADCAST_KEYS else of

    def dealt(df: DataFrame, is_left: bool) -> DataFrame:
        d = df.join(of, keys, "left")
        split = F.col("by_left") == F.lit(is_left)
        parts = F.sequence(F.lit(0), F.col("parts") - 1)
        own = F.array(F.pmod(F.xxhash64(*df.columns), F.col("parts")).cast("int"))
        return d.withColumn("_part", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(split, own).otherwise(parts))).drop("by_left", "parts")

    return dealt(lx, True).join(dealt(rx, False), [*keys, "_part"]).select(*out)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    et: str,
    lower_s: int,
    upper_s: int,
    lcols: Sequence[str],
    rcols: Sequence[str],
) -> DataFrame:
    """J02 inner join: same key and ``l.et + lower <= r.et <= l.et + upper``
    (closed bounds)."""
    width = max(upper_s - lower_s, 1) * 1_000_000
    lx = left.select(
        F.col(key).alias("_k"),
        epoch_us(et).alias("_lt"),
        *[F.col(c).alias(f"l_{c}") for c in lcols],
    ).withColumn(
        "_b",
        F.explode(
            F.sequence(
                floor_div(F.col("_lt") + F.lit(lower_s * 1_000_000), width),
                floor_div(F.col("_lt") + F.lit(upper_s * 1_000_000), width),
            )
        ),
    )
    rx = right.select(
        F.col(key).alias("_rk"),
        epoch_us(et).alias("_rt"),
        floor_div(epoch_us(et), width).alias("_rb"),
        *[F.col(c).alias(f"r_{c}") for c in rcols],
    )
    cond = (
        (F.col("_k") == F.col("_rk"))
        & (F.col("_b") == F.col("_rb"))
        & (F.col("_rt") >= F.col("_lt") + F.lit(lower_s * 1_000_000))
        & (F.col("_rt") <= F.col("_lt") + F.lit(upper_s * 1_000_000))
    )
    j = lx.join(rx, cond, "inner")
    return j.select(F.col("_k").alias(key), *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols])


def connected_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, lcols: Sequence[str], rcols: Sequence[str]
) -> DataFrame:
    """J04 two keyed inputs, each kept whole as keyed state: every row meets
    every row of its key on the other side, whichever comes first.  On tables
    an equi-join, whose hot keys adaptive execution splits; on streams Spark's
    stream-stream join, whose state is the two inputs."""
    on = left[left_key] == right[right_key]
    return left.join(right, on, "inner").select(*[left[c] for c in lcols], *[right[c] for c in rcols])


def interval_join_late(
    left: DataFrame,
    right: DataFrame,
    key: str,
    et: str,
    arrival: str,
    lower_s: int,
    upper_s: int,
    delay_s: int,
    lcols: Sequence[str],
    rcols: Sequence[str],
    tiebreak: Sequence[str] = ("seq",),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J03 interval join with late sides: ``(joined, late left, late right)``.

    A row is late if its event time is behind the clock of both inputs (the
    smaller watermark) at its arrival; late rows leave on their side's frame,
    whole, and do not join.  Both inputs run through one ordered scan, whose
    result is written once for the three frames.
    """
    tagged = left.withColumn("_side", F.lit("l")).unionByName(right.withColumn("_side", F.lit("r")), allowMissingColumns=True)
    d = combined_watermark(tagged, "_side", ["l", "r"], et, arrival, delay_s, name="_clock", tiebreak=tiebreak)
    d = written(d.withColumn("_late", late_by_clock(d, et, "_clock")), "sides")
    sides = {s: d.filter(F.col("_side") == s) for s in "lr"}
    on_time = [sides[s].filter(~F.col("_late")) for s in "lr"]
    joined = interval_join(*on_time, key, et, lower_s, upper_s, lcols, rcols)
    return joined, sides["l"].filter("_late").select(*left.columns), sides["r"].filter("_late").select(*right.columns)


def connect_map(left: DataFrame, right: DataFrame, lmap, rmap, lname: str = "left", rname: str = "right") -> DataFrame:
    """J05 two inputs of different types, each with its own map into one
    output type; ``origin`` tags the input."""
    a = lmap(left).withColumn("origin", F.lit(lname))
    b = rmap(right).withColumn("origin", F.lit(rname))
    return a.unionByName(b)


def union_all(*frames: DataFrame) -> DataFrame:
    """J06 n-ary union by name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def latest_rule(
    data: DataFrame,
    configs: DataFrame,
    arrival: str,
    value: str,
    keys: Sequence[str] = (),
    name: str = "threshold",
    default=0,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """J07/J08 each data row with the latest config value whose arrival is at
    or before the row's arrival (``default`` before the first config).

    ``keys`` empty: one global rule (broadcast state); with keys: a rule per
    key (keyed broadcast).  A config and a data row at the same instant: the
    config counts.
    """
    keys = list(keys)
    cfg = configs.select(
        *keys,
        epoch_us(arrival).alias("_a"),
        F.lit(0).alias("_kind"),
        F.col("seq").alias("_seq"),
        F.struct(epoch_us(arrival).alias("a"), F.col("seq").alias("s"), F.col(value).alias("v")).alias("_cfg"),
    )
    dat_cols = data.columns
    dat = data.select(
        *[F.col(c) for c in dat_cols],
        epoch_us(arrival).alias("_a"),
        F.lit(1).alias("_kind"),
        F.col("seq").alias("_seq"),
        F.lit(None).cast(cfg.schema["_cfg"].dataType).alias("_cfg"),
    )
    u = dat.unionByName(cfg, allowMissingColumns=True)
    r = running_aggregate(u, keys, "_a", [("_last", "max", F.col("_cfg"))], rows_per_block, ["_kind", "_seq"])
    return r.filter(F.col("_kind") == 1).select(
        *dat_cols, F.coalesce(F.col("_last.v"), F.lit(default)).alias(name)
    )
