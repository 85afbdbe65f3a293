"""Structured Streaming forms of the operators.

Each takes a streaming frame whose event-time columns are TIMESTAMP (see
``replay.to_event_time``) and returns a streaming frame (or a
``foreachBatch`` function) whose final result equals the batch operator's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.time import epoch_ms
from sluice.sinks.idempotent import IdempotentBatchWriter
from sluice.sources.text import java_split_space


def word_count_update(lines: DataFrame, line: str = "line") -> DataFrame:
    """A02 stream: running count per word; ``outputMode('update')`` emits the
    latest count of each changed word per micro-batch."""
    words = lines.select(F.explode(java_split_space(F.col(line))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def window_aggregate_append(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    size: str,
    delay: str,
    aggs: Sequence[Column],
    slide: str | None = None,
) -> DataFrame:
    """W01/W03/W10 stream: watermark + windowed aggregate; ``append`` emits
    each window once, when the watermark passes its end."""
    w = F.window(et, size, slide) if slide else F.window(et, size)
    g = df.withWatermark(et, delay).groupBy(*keys, w.alias("_win")).agg(*aggs)
    rest = [c for c in g.columns if c not in (*keys, "_win")]
    return g.select(
        *keys,
        epoch_ms(F.col("_win.start").cast("timestamp_ntz")).alias("window_start"),
        epoch_ms(F.col("_win.end").cast("timestamp_ntz")).alias("window_end"),
        *rest,
    )


def session_aggregate_append(
    df: DataFrame, keys: Sequence[str], et: str, gap: str, delay: str, aggs: Sequence[Column]
) -> DataFrame:
    """W05 stream: ``session_window`` with a watermark."""
    g = df.withWatermark(et, delay).groupBy(*keys, F.session_window(et, gap).alias("_win")).agg(*aggs)
    rest = [c for c in g.columns if c not in (*keys, "_win")]
    return g.select(
        *keys,
        epoch_ms(F.col("_win.start").cast("timestamp_ntz")).alias("window_start"),
        epoch_ms(F.col("_win.end").cast("timestamp_ntz")).alias("window_end"),
        *rest,
    )


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    key: str,
    et: str,
    lower_s: int,
    upper_s: int,
    delay: str,
    lcols: Sequence[str],
    rcols: Sequence[str],
) -> DataFrame:
    """J02 stream: stream-stream inner join with watermarks on both sides and
    a time-range condition, so Spark can drop old join state."""
    lw = left.withWatermark(et, delay).select(
        F.col(key).alias("_lk"), F.col(et).alias("_lt"), *[F.col(c).alias(f"l_{c}") for c in lcols]
    )
    rw = right.withWatermark(et, delay).select(
        F.col(key).alias("_rk"), F.col(et).alias("_rt"), *[F.col(c).alias(f"r_{c}") for c in rcols]
    )
    cond = (
        (F.col("_lk") == F.col("_rk"))
        & (F.col("_rt") >= F.col("_lt") + F.expr(f"INTERVAL '{lower_s}' SECOND"))
        & (F.col("_rt") <= F.col("_lt") + F.expr(f"INTERVAL '{upper_s}' SECOND"))
    )
    return lw.join(rw, cond, "inner").select(
        F.col("_lk").alias(key), *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols]
    )


def window_join_stream(
    left: DataFrame, right: DataFrame, key: str, et: str, size: str, delay: str, lcols, rcols
) -> DataFrame:
    """J01 stream: both sides windowed, joined on (key, window)."""
    lw = left.withWatermark(et, delay).select(
        F.col(key), F.window(et, size).alias("_win"), *[F.col(c).alias(f"l_{c}") for c in lcols]
    )
    rw = right.withWatermark(et, delay).select(
        F.col(key), F.window(et, size).alias("_win"), *[F.col(c).alias(f"r_{c}") for c in rcols]
    )
    return lw.join(rw, [key, "_win"], "inner")


def topn_per_batch(path: str, n: int, value: str = "vc"):
    """TK02 stage 2 as a ``foreachBatch`` function: the windows closed in a
    batch (from an append-mode window count) ranked and written per batch id
    (a replayed batch overwrites its own output).  All counts of one window
    arrive in the same batch in append mode."""
    writer = IdempotentBatchWriter(path)

    def rank(batch: DataFrame, batch_id: int) -> None:
        w = Window.partitionBy("window_end").orderBy(F.col("cnt").desc(), F.col(value).asc())
        writer(batch.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n), batch_id)

    return rank


def processing_time_windows(
    df: DataFrame, keys: list[str], aggs: list, size: str, slide: str | None = None, session: bool = False
) -> DataFrame:
    """W02/W04/W06 stream: tumbling (``slide=None``), sliding, or session
    (``size`` is the gap) windows over the time at which a row is processed.
    A window is final one trigger after its end."""
    from sluice.operators.windows import processing_time

    d = processing_time(df).withWatermark("pt", "0 seconds")
    w = F.session_window("pt", size) if session else F.window("pt", size, slide) if slide else F.window("pt", size)
    g = d.groupBy(*keys, w.alias("_win")).agg(*aggs)
    rest = [c for c in g.columns if c not in (*keys, "_win")]
    return g.select(*keys, F.col("_win.start").alias("window_start"), F.col("_win.end").alias("window_end"), *rest)


def previous_state(spark, state_path: str, batch_id: int) -> DataFrame | None:
    """The state row that the batch before ``batch_id`` left (each batch
    leaves one, so no other is read); none for the first batch.  The folder is
    asked through Spark's file system, and any failure to read is a failure."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state_path}/batch_id={batch_id - 1}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        if batch_id:
            raise RuntimeError(f"batch {batch_id} finds no state of batch {batch_id - 1} under {state_path}")
        return None
    return spark.read.parquet(folder.toString())


def split_late_per_batch(
    state_path: str,
    on_time_path: str,
    late_path: str,
    et: str,
    arrival: str,
    delay_s: int,
    window: str | None = None,
):
    """T05 stream: route late rows to a side output inside ``foreachBatch``.

    Spark itself only drops rows behind the watermark.  Here each micro-batch
    is split with the batch definition of lateness (``late.split_late``),
    seeded with the maximum event time of all earlier batches.  That maximum
    is one small row per batch id under ``state_path`` (read back as
    ``max(batch_id < current)``), and both outputs are written per batch id,
    so a replayed batch reproduces, not duplicates, its results.
    """
    from sluice.functions.time import duration_us, epoch_us
    from sluice.operators.late import with_watermark_before

    on_writer = IdempotentBatchWriter(on_time_path)
    late_writer = IdempotentBatchWriter(late_path)
    state_writer = IdempotentBatchWriter(state_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = previous_state(spark, state_path, batch_id)
        prev = None if state is None else state.first()["max_et_us"]
        d = with_watermark_before(batch, et, arrival, delay_s)
        if prev is not None:
            seeded = F.greatest(F.col("wm_before_us"), F.lit(prev - delay_s * 1_000_000))
            d = d.withColumn("wm_before_us", F.coalesce(seeded, F.lit(prev - delay_s * 1_000_000)))
        if window:
            size = duration_us(window)
            t = epoch_us(et)
            late = (t - F.pmod(t, F.lit(size)) + F.lit(size)) <= F.col("wm_before_us")
        else:
            late = epoch_us(et) < F.col("wm_before_us")
        d = d.withColumn("_late", F.coalesce(late, F.lit(False))).persist()
        try:
            on_writer(d.filter(~F.col("_late")).drop("_late"), batch_id)
            late_writer(d.filter(F.col("_late")).drop("_late"), batch_id)
            top = batch.agg(F.max(epoch_us(et)).alias("m")).collect()[0][0]
            new_max = max(x for x in (prev, top) if x is not None) if (prev is not None or top is not None) else None
            state_writer(spark.createDataFrame([(new_max,)], "max_et_us long"), batch_id)
        finally:
            d.unpersist()

    return run


def rule_per_batch(state_path: str, out_path: str, kind_col: str, config_kind, value: str, arrival: str, default=0):
    """J07 stream: a global rule (broadcast state) applied inside
    ``foreachBatch``.  Config rows (``kind_col == config_kind``) and data rows
    come in one stream; each batch is resolved with the batch as-of operator,
    seeded with the latest config of earlier batches (one small row per batch
    id under ``state_path``).  Alerts (``value > threshold``) are written per
    batch id."""
    from sluice.functions.time import epoch_us, from_epoch_us
    from sluice.operators.joins import latest_rule

    out_writer = IdempotentBatchWriter(out_path)
    state_writer = IdempotentBatchWriter(state_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cfg = batch.filter(F.col(kind_col) == config_kind)
        data = batch.filter(F.col(kind_col) != config_kind)
        seed = previous_state(spark, state_path, batch_id)
        seed_rows = None
        if seed is not None:
            seed_rows = seed.filter(F.col("a").isNotNull()).select(
                F.col("s").alias("seq"), F.col("v").alias(value), from_epoch_us("a").alias(arrival)
            )
        cfg_all = cfg.select("seq", value, arrival)
        if seed_rows is not None:
            cfg_all = cfg_all.unionByName(seed_rows)
        r = latest_rule(data, cfg_all, arrival, value, name="threshold", default=default)
        out_writer(r.filter(F.col(value) > F.col("threshold")), batch_id)
        last = cfg_all.agg(F.max(F.struct(epoch_us(arrival).alias("a"), F.col("seq").alias("s"), F.col(value).alias("v"))).alias("m")).select("m.*")
        state_writer(last, batch_id)

    return run


def drop_buckets_before(spark, path: str, first_kept: int, column: str = "bucket") -> int:
    """Delete the folders ``<column>=<n>`` under ``path`` with ``n`` below
    ``first_kept``; how many there were."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for f in system.listStatus(folder) if system.exists(folder) else []:
        name, _, value = f.getPath().getName().partition("=")
        if name == column and value.lstrip("-").isdigit() and int(value) < first_kept:
            system.delete(f.getPath(), True)
            gone += 1
    return gone


def interval_join_late_per_batch(
    path: str,
    side: str,
    key: str,
    et: str,
    arrival: str,
    lower_s: int,
    upper_s: int,
    delay_s: int,
    lcols: Sequence[str],
    rcols: Sequence[str],
):
    """J03 stream: interval join with late sides as a ``foreachBatch``
    function over one stream of both inputs (``side`` is ``l`` or ``r``).

    Results go to ``joined``, ``late_left`` and ``late_right`` under ``path``.
    The clock of both inputs goes on from the maxima that earlier batches left
    (one state row a batch).  Rows on time are kept under ``rows`` in folders
    of one time bucket each, as wide as the interval reaches; a batch reads
    only the buckets that its rows reach.  A row on time is never behind the
    clock, so a bucket that ended more than the interval's reach before the
    clock meets no later row: its folder is deleted by the first batch that
    starts with such a clock, when the batch that moved the clock is committed.
    So the state, and what a batch reads, is what lies between the clock and
    the latest rows.  Everything is written per batch id, so a replayed batch
    replaces its results.
    """
    from sluice.functions.time import epoch_us, floor_div, from_epoch_us
    from sluice.operators.joins import interval_join
    from sluice.operators.late import combined_watermark, late_by_clock

    writers = {n: IdempotentBatchWriter(f"{path}/{n}") for n in ("state", "joined", "late_left", "late_right")}
    keep = IdempotentBatchWriter(f"{path}/rows", by=("bucket",))
    reach = max(abs(lower_s), abs(upper_s), 1) * 1_000_000

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = previous_state(spark, f"{path}/state", batch_id)
        batch = batch.persist()
        rows = batch.withColumn("_seed", F.lit(False))
        if state is not None:  # each input's maximum so far, ahead of all arrivals
            seeds = state.select("side", "max_et").filter("max_et is not null")
            n, behind = seeds.agg(F.count(F.lit(1)), F.min("max_et")).first()
            if n == 2:
                drop_buckets_before(spark, f"{path}/rows", (behind - delay_s * 1_000_000 - reach) // reach)
            first = batch.agg(F.min(epoch_us(arrival))).first()[0] or 0
            seeds = seeds.select(F.col("side").alias(side), from_epoch_us("max_et").cast(batch.schema[et].dataType).alias(et))
            seeds = seeds.withColumn(arrival, from_epoch_us(F.lit(first - 1)).cast(batch.schema[arrival].dataType)).withColumn("_seed", F.lit(True))
            rows = rows.unionByName(seeds, allowMissingColumns=True)
        d = combined_watermark(rows, side, ["l", "r"], et, arrival, delay_s, name="_clock")
        d = d.withColumn("_late", late_by_clock(d, et, "_clock")).filter("not _seed").drop("_seed", "_clock").persist()
        try:
            for s, name in (("l", "late_left"), ("r", "late_right")):
                writers[name](d.filter((F.col(side) == s) & F.col("_late")).drop("_late"), batch_id)
            new = d.filter("not _late").drop("_late")
            bucketed = new.filter(F.col(et).isNotNull()).withColumn("bucket", floor_div(epoch_us(et), reach))
            keep(bucketed, batch_id)
            low, high = bucketed.agg(F.min("bucket"), F.max("bucket")).first()
            old = spark.read.schema(bucketed.schema.add("batch_id", "long")).parquet(f"{path}/rows").filter(F.col("batch_id") < batch_id)
            near = F.lit(False) if low is None else F.col("bucket").between(low - 1, high + 1)
            old = old.filter(near).drop("batch_id", "bucket")
            of = lambda f, s: f.filter(F.col(side) == s)
            args = (key, et, lower_s, upper_s, lcols, rcols)
            met = interval_join(of(new, "l"), of(new.unionByName(old), "r"), *args).unionByName(interval_join(of(old, "l"), of(new, "r"), *args))
            writers["joined"](met, batch_id)
            tops = d.groupBy(F.col(side).alias("side")).agg(F.max(epoch_us(et)).alias("max_et"))
            tops = tops if state is None else tops.unionByName(state.select("side", "max_et"))
            both = spark.createDataFrame([("l", None), ("r", None)], "side string, max_et long")  # a row for each input in every batch
            writers["state"](tops.unionByName(both).groupBy("side").agg(F.max("max_et").alias("max_et")), batch_id)
        finally:
            d.unpersist()
            batch.unpersist()

    return run


def running_aggregate_per_batch(path: str, state_path: str, keys: Sequence[str], order: str, specs, tiebreak: Sequence[str] = (), rows_per_block: int | None = None):
    """A03 ST03 ST04 ST05 stream: one running value per row as a
    ``foreachBatch`` function, for streams with a hot key.

    A keyed stateful operator runs a key's rows of a micro-batch in one task.
    Here they are cut into blocks as on tables (``rolling.running_aggregate``),
    so a key that holds most rows of a batch uses all tasks, and the value goes
    on from the key's total after the batch before.  ``specs`` are ``(name,
    kind, expr)``, nullable keys count.  The totals, a row a key, are written
    anew with each batch id: what a batch costs besides its rows grows with the
    number of keys, so with very many keys and small batches the keyed
    processors are the better form.  Rows of a later batch come later in
    ``order``.
    """
    from sluice.operators.rolling import _AGG, ROWS_PER_BLOCK, combined, null_free_keys, running_aggregate

    out_writer, state_writer = IdempotentBatchWriter(path), IdempotentBatchWriter(state_path)
    again = {"count": F.sum}  # a count of counts is a sum

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            local = running_aggregate(batch, keys, order, specs, rows_per_block or ROWS_PER_BLOCK, tiebreak)
            totals = batch.groupBy(*keys).agg(*[_AGG[k](e).alias(n) for n, k, e in specs])
            state = previous_state(batch.sparkSession, state_path, batch_id)
            if state is not None:
                before = state.filter("NOT mark").drop("mark")
                totals = totals.unionByName(before.select(*totals.columns)).groupBy(*keys).agg(*[again.get(k, _AGG.get(k))(n).alias(n) for n, k, _ in specs])
                rows, part = null_free_keys(local, keys)
                known, _ = null_free_keys(before.select(*[F.col(c).cast(batch.schema[c].dataType).alias(c) for c in keys], *[F.col(n).alias(f"_b_{n}") for n, _, _ in specs]), keys)
                known = known.select(*part, *[f"_b_{n}" for n, _, _ in specs])
                joined = rows.join(known, part, "left")
                local = joined.select(*batch.columns, *[combined(k, F.col(f"_b_{n}"), F.col(n)).alias(n) for n, k, _ in specs])
            out_writer(local, batch_id)
            mark = batch.sparkSession.range(1).select(F.lit(True).alias("mark"))  # a state row in every batch
            state_writer(totals.withColumn("mark", F.lit(False)).unionByName(mark, allowMissingColumns=True), batch_id)
        finally:
            batch.unpersist()

    return run
