"""W13 / P13 user code over a window's elements without gathering them.

A window's rows are dealt into blocks of about ``rows_per_block`` rows.  User
code sees a block as an iterator of Arrow batches (never the window, nor the
block, in one frame) and yields partial rows; further user code gets a window's
partial rows, again batch by batch, and yields the window's results.  So a
window that holds a third of all rows is worked on by many tasks, and what
meets in one task is what the partial step leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.rolling import BROADCAST_KEYS, ROWS_PER_BLOCK, given_keys, null_free_keys
from sluice.operators.windows import window_bounds, with_window
from sluice.session import ship_package, written

Batches = Iterator[pa.RecordBatch]


def _each(fn: Callable[[Batches], Batches], n_keys: int, columns: list[str], schema: T.StructType):
    """``fn`` over a group's batches of ``columns``, its rows prefixed by the
    group's keys."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(key: tuple, batches: Batches) -> Batches:
        inner = (b.select(columns) for b in batches)
        for out in fn(inner):
            keys = [pa.array([k.as_py()] * out.num_rows, f.type) for k, f in zip(key, target)]
            rest = [out.column(f.name).cast(f.type) for f in list(target)[n_keys:]]
            yield pa.RecordBatch.from_arrays(keys + rest, schema=target)

    return run


def window_user_process(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    size: str,
    columns: Sequence[str],
    partial: Callable[[Batches], Batches],
    partial_schema: str,
    merge: Callable[[Batches], Batches],
    result_schema: str,
    slide: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``keys, window_start, window_end`` and the columns of ``result_schema``.

    ``partial`` gets the ``columns`` of a block's rows and yields batches of
    ``partial_schema``; ``merge`` gets all batches of a window's partial rows
    and yields batches of ``result_schema``.  Neither may rest on the order of
    rows.
    """
    ship_package(df.sparkSession)
    w, part = null_free_keys(with_window(df, et, size, slide), keys)
    w = w.filter(F.col("_win").isNotNull())
    by = [*part, "_win"]
    large = w.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_block)
    large = written(large.select(*by, F.ceil(F.col("_n") / rows_per_block).cast("int").alias("_blocks")), "large-windows")
    n = large.count()
    cut = w
    if n:
        cut = w.join(F.broadcast(large) if n <= BROADCAST_KEYS else large, by, "left")
        own = F.pmod(F.xxhash64(*df.columns), F.col("_blocks")).cast("int")
        cut = cut.withColumn("_block", F.coalesce(own, F.lit(0))).drop("_blocks")
    else:
        cut = cut.withColumn("_block", F.lit(0))
    fields = T.StructType.fromDDL(partial_schema).fields
    of_block = T.StructType([*(cut.schema[c] for c in by), cut.schema["_block"], *fields])
    first = cut.select(*by, "_block", *columns).groupBy(*by, "_block").applyInArrow(_each(partial, len(by) + 1, list(columns), of_block), of_block)
    results = T.StructType.fromDDL(result_schema).fields
    of_window = T.StructType([*(cut.schema[c] for c in by), *results])
    found = first.drop("_block").groupBy(*by).applyInArrow(_each(merge, len(by), [f.name for f in fields], of_window), of_window)
    back = given_keys(keys, part)
    return found.select(*back, *window_bounds(), *[f.name for f in results])


# ------------------------------------------------------------ a user's median


def value_counts(batches: Batches) -> Batches:
    """Partial step of a median: each value with its number of rows."""
    counts: dict = {}
    for b in batches:
        for pair in b.column(0).drop_null().value_counts().to_pylist():
            counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.float64()), pa.array(list(counts.values()), pa.int64())], ["value", "n"])


def median_of_counts(batches: Batches) -> Batches:
    """Merge step: the median (mean of the middle two) of counted values."""
    counts: dict = {}
    for b in batches:
        for v, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[v] = counts.get(v, 0) + n
    total, seen, found = sum(counts.values()), 0, []
    places = [(total - 1) // 2, total // 2] if total else []
    for v in sorted(counts):
        seen += counts[v]
        found += [v] * sum(seen - counts[v] <= p < seen for p in places)
    yield pa.RecordBatch.from_arrays([pa.array([sum(found) / 2 if found else None], pa.float64()), pa.array([total], pa.int64())], ["median", "n_values"])


def window_median(df: DataFrame, keys: Sequence[str], et: str, value: str, size: str, slide: str | None = None, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The median of ``value`` in each window, by user code."""
    d = df.withColumn(value, F.col(value).cast("double"))
    return window_user_process(d, keys, et, size, [value], value_counts, "value double, n long", median_of_counts, "median double, n_values long", slide, rows_per_block)
