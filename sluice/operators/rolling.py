"""Skew-safe running (per-row) keyed aggregates and neighbour lookups.

A streaming keyed operator emits one result per input row: a running sum, the
previous value of the key, a running count.  The batch form is a window
``partition by key order by seq rows unbounded preceding``; Spark runs that
frame in one task per key, so a key holding a third of all rows would run in
one task.

Keys with at most ``rows_per_block`` rows run as that plain window: one
shuffle.  The rows of larger keys (or, without a key, of the whole table) are
cut into *blocks*, which are ranges of (key, order, tiebreak).  Their bounds are
places of a sample of the rows themselves: a stray value, a burst, or sparse
numbers change neither the blocks' size nor their number.  The bounds are
written once, as one row; a row finds its block among them by a binary search in
expressions, so it is shuffled once, to where its block is scanned, and a
retried task finds the same blocks.  The rows are computed again for the sample
and for the totals.  Then:

1. local running aggregate inside ``(key, block)``
2. one total per ``(key, block)`` of the cut keys             (map-side combined)
3. exclusive prefix of the totals over the blocks of a key    (small: blocks)
4. join the prefix back on ``(key, block)`` and combine.

The driver takes two numbers, the count of large keys and of their rows.  The
plan holds no list: the large keys are a table, the bounds a subquery.  There
are about ``MAX_BLOCKS`` blocks at most, which bounds the prefix step; beyond
``MAX_BLOCKS * rows_per_block`` rows the blocks grow.

Only decomposable aggregates (sum, count, min, max - including ``max`` over a
struct, which gives "last value by order") are offered.  The result is exact.

Nullable keys travel as null-free columns (:func:`null_free_keys`), so the
join back is a plain equi-join on exactly the columns the local scan is
partitioned by: when the prefix is too large to broadcast, the sort-merge join
reuses that partitioning and only the small prefix side is shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import written

#: Rows of a block: what one task scans in order, however the rows lie.
ROWS_PER_BLOCK = 1 << 18
#: Blocks of one scan, about.
MAX_BLOCKS = 10_000
#: Rows of a block from which its bound is taken.
SAMPLED = 50
#: Large keys up to which their table may be broadcast (a key and its flag).
BROADCAST_KEYS = 65_536

_AGG = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def null_free_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Null-free key columns; the frame with them and their names.

    A nullable key of a primitive type travels as ``coalesce(key, default)``
    plus an ``isnull(key)`` flag: a plain equi-join on these columns is
    exactly the null-safe join, and the sort keeps its fast prefix on the key.
    Other nullable types are wrapped in a struct (struct equality treats null
    fields as equal).
    """
    part: list[str] = []
    for i, c in enumerate(keys):
        f = df.schema[c]
        if not f.nullable:
            part.append(c)
            continue
        kc, kn = f"_sl_k{i}", f"_sl_n{i}"
        if isinstance(f.dataType, (T.StringType, T.BooleanType) + _NUMERIC):
            df = df.withColumn(kc, F.coalesce(F.col(c), F.lit(0).cast(f.dataType))).withColumn(
                kn, F.col(c).isNull()
            )
            part += [kc, kn]
        else:
            df = df.withColumn(kc, F.struct(F.col(c)))
            part.append(kc)
    return df, part


def given_keys(keys: Sequence[str], part: Sequence[str]) -> list[Column]:
    """The keys as they were from their null-free columns."""
    out, i = [], 0
    for n, c in enumerate(keys):
        if part[i] == c:
            out.append(F.col(c))
            i += 1
        elif i + 1 < len(part) and part[i + 1] == f"_sl_n{n}":
            out.append(F.when(~F.col(part[i + 1]), F.col(part[i])).alias(c))
            i += 2
        else:
            out.append(F.col(part[i])[c].alias(c))
            i += 1
    return out


def _dealt(d: DataFrame, keys: Sequence[str], part: Sequence[str]) -> DataFrame:
    """``d`` dealt by its partition columns; nullable keys are not shuffled
    beside their null-free columns, but made from them afterwards."""
    twice = [c for c in keys if c not in part]
    back = dict(zip(keys, given_keys(keys, part)))
    return d.drop(*twice).repartition(*part).select(*[back[c] if c in twice else F.col(c) for c in d.columns])


@dataclass
class Cut:
    """Where large keys (without a key: all rows) are cut: a written table of
    one row, the array ``bounds`` of about as many places as ``blocks``, and
    the table of the large keys (none without a key)."""

    bounds: DataFrame
    blocks: int
    keys: DataFrame | None = None

    def rows(self, d: DataFrame, key: Sequence[str]) -> DataFrame:
        """The rows of large keys."""
        return d if self.keys is None else d.join(self.keys, key, "left_semi")


def _place(key: Sequence[str], order: str, tiebreak: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*key, order, *tiebreak])])


def find_cut(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = (), rows_per_block: int = ROWS_PER_BLOCK
) -> Cut | None:
    """The cut of ``df``'s large keys, or none if no key is large: one count
    per key decides (map-side combined), of which the driver takes two sums."""
    d, key = null_free_keys(df, keys)
    if not key:
        total = d.count()
        return _cut(d, key, order, tiebreak, total, rows_per_block, None) if total > rows_per_block else None
    large = d.groupBy(*key).count().filter(F.col("count") > rows_per_block).persist()
    try:
        n, total = large.agg(F.count(F.lit(1)), F.sum("count")).first()
        if not n:
            return None
        of = written(large.select(*key), "large-keys")
    finally:
        large.unpersist()
    return _cut(d, key, order, tiebreak, total, rows_per_block, F.broadcast(of) if n <= BROADCAST_KEYS else of)


def _cut(d: DataFrame, key: Sequence[str], order: str, tiebreak: Sequence[str], total: int, rows_per_block: int, of: DataFrame | None) -> Cut:
    """The cut of the ``total`` rows of large keys: bounds are every so-many-th
    place of a sample, which one task sorts (``SAMPLED`` rows a block, at most
    ``MAX_BLOCKS`` blocks)."""
    cut = Cut(d, min(MAX_BLOCKS, -(-total // rows_per_block)), of)
    share = min(1.0, SAMPLED * cut.blocks / total)
    places = cut.rows(d, key).sample(fraction=share, seed=42).select(_place(key, order, tiebreak).alias("at"))
    numbered = places.select("at", F.row_number().over(Window.orderBy("at")).alias("n"))
    every = numbered.filter(F.col("n") % max(1, round(share * total / cut.blocks)) == 0)
    cut.bounds = written(every.agg(F.sort_array(F.collect_list("at")).alias("bounds")), "bounds")
    return cut


def _numbered(d: DataFrame, key: Sequence[str], blk: str, order: str, tiebreak: Sequence[str], cut: Cut) -> DataFrame:
    """``d`` with the number of its block: how many bounds are not after the
    row, and one; 0 for rows of a key in which no bound lies.  A search by
    halves, as one fold: as a chain of columns the plan grows with their square
    and more."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(cut.blocks.bit_length() + 1))])

    def searched(v: Column) -> Column:
        bounds, at = v["bounds"], v["at"]
        return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get(bounds, n + step - 1) <= at, step).otherwise(0))

    def of_row(v: Column) -> Column:
        n, bounds, at = v["n"], v["bounds"], v["at"]
        if not key:
            return n + 1
        beside = [F.get(bounds, n - 1), F.get(bounds, n)]
        of_key = [reduce(and_, [b[f"_{i}"].eqNullSafe(at[f"_{i}"]) for i in range(len(key))]) for b in beside]
        return F.when(reduce(or_, of_key), n + 1).otherwise(0)

    bind = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  f's argument is computed once
    row = F.struct(cut.bounds.scalar().alias("bounds"), _place(key, order, tiebreak).alias("at"))
    found = lambda v: F.struct(searched(v).alias("n"), v["bounds"].alias("bounds"), v["at"].alias("at"))
    # a column first: Spark takes no subquery inside the functions
    d = d.withColumn("_sl_row", row).withColumn(blk, bind(F.col("_sl_row"), lambda v: bind(found(v), of_row)))
    return d.withColumn(blk, F.coalesce(blk, F.lit(0))).drop("_sl_row")


def with_blocks(
    df: DataFrame,
    keys: Sequence[str],
    blk: str,
    order: str,
    tiebreak: Sequence[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
    cut: Cut | None | str = "find",
) -> tuple[DataFrame, list[str], bool]:
    """The block column where large keys are cut: the frame, the partition
    columns (null-free keys first, block last), whether cut.  Uncut, the
    partition columns are the keys, so what follows on the key needs no
    further shuffle.  Cut, the frame is a written table, for several scans, in
    which rows of keys that are whole have block 0."""
    if cut == "find":
        cut = find_cut(df, keys, order, tiebreak, rows_per_block)
    if cut is None:
        return df, list(keys), False
    d, key = null_free_keys(df, keys)
    return written(_numbered(d, key, blk, order, tiebreak, cut), "blocks"), [*key, blk], True


def blocks_of(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str], rows_per_block: int, block: str | None
) -> tuple[DataFrame, list[str], str | None, DataFrame | None]:
    """For one scan: the frame with its block column, not written but dealt by
    the partition columns, these, the block column's name (none: no key is
    large), and the frame's rows of large keys, as they lie.  ``block`` names the column of a frame that is
    cut already (for its keys or the first of them), none says that it has no
    large key."""
    if block is None:
        return df, list(keys), None, None
    cut = find_cut(df, keys, order, tiebreak, rows_per_block) if block == "find" else None
    if block == "find" and cut is None:
        return df, list(keys), None, None
    d, key = null_free_keys(df, keys)
    if cut is None:
        part = [*key, block]
        return _dealt(d, keys, part), part, block, d.filter(F.col(block) > 0)
    at, part = ("_sl_blk", order, tiebreak, cut), [*key, "_sl_blk"]
    return _dealt(_numbered(d, key, *at), keys, part), part, "_sl_blk", _numbered(cut.rows(d, key), key, *at)


def combined(kind: str, prefix: Column, local: Column) -> Column:
    """The running value that goes on from ``prefix`` (null: nothing yet)."""
    if kind == "count":
        return F.coalesce(prefix, F.lit(0)) + local
    if kind == "sum":
        return (
            F.when(prefix.isNull(), local)
            .when(local.isNull(), prefix)
            .otherwise(prefix + local)
        )
    if kind == "max":
        return F.when(prefix.isNull(), local).when(local.isNull(), prefix).otherwise(
            F.greatest(prefix, local)
        )
    if kind == "min":
        return F.when(prefix.isNull(), local).when(local.isNull(), prefix).otherwise(
            F.least(prefix, local)
        )
    raise ValueError(kind)


def running_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: Sequence[tuple[str, str, Column]],
    rows_per_block: int = ROWS_PER_BLOCK,
    tiebreak: Sequence[str] = (),
    exclusive: bool = False,
    block: str | None = "find",
) -> DataFrame:
    """Add one running aggregate column per ``(name, kind, expr)`` spec.

    ``order`` must be unique within a key together with ``tiebreak``; the frame
    is "all earlier rows of the key and this row" (``exclusive=True``: earlier
    rows only).  ``block`` is the block column of a frame from
    :func:`with_blocks`, for several scans of one cut.
    """
    d, part, blk, large = blocks_of(df, keys, order, tiebreak, rows_per_block, block)
    ordering = [F.col(order)] + [F.col(c) for c in tiebreak]
    w_local = (
        Window.partitionBy(*part)
        .orderBy(*ordering)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    )
    local = d.select(
        "*", *[_AGG[k](e).over(w_local).alias(f"_sl_l_{n}") for n, k, e in specs]
    )
    out_cols = [c for c in df.columns]
    if blk is None:
        # an exclusive count has no rows before the first: 0
        return local.select(*out_cols, *[F.col(f"_sl_l_{n}").alias(n) for n, _, _ in specs])
    totals = large.groupBy(*part).agg(*[_AGG[k](e).alias(f"_sl_t_{n}") for n, k, e in specs])
    w_prefix = (
        Window.partitionBy(*part[:-1]).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    )
    # count of counts is a sum
    prefix = totals.select(
        *part,
        *[
            _AGG["sum" if k == "count" else k](F.col(f"_sl_t_{n}")).over(w_prefix).alias(f"_sl_p_{n}")
            for n, k, _ in specs
        ],
    )
    joined = local.join(prefix, part, "left")
    return joined.select(
        *out_cols,
        *[combined(k, F.col(f"_sl_p_{n}"), F.col(f"_sl_l_{n}")).alias(n) for n, k, _ in specs],
    )


def keyed_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    name: str,
    direction: int = -1,
    default=None,
    rows_per_block: int = ROWS_PER_BLOCK,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``lag(value)`` (direction -1) or ``lead(value)`` (+1) within a key.

    Rows without a neighbour get ``default``.  Skew-safe like
    :func:`running_aggregate`: the first (last) row of each block looks the
    neighbour up in the block totals of the key.
    """
    d, part, blk, large = blocks_of(df, keys, order, tiebreak, rows_per_block, "find")
    asc = direction < 0
    o = [F.col(c).asc() if asc else F.col(c).desc() for c in [order, *tiebreak]]
    w_local = Window.partitionBy(*part).orderBy(*o)
    if blk is None:
        return d.select(*df.columns, F.lag(value, 1, default).over(w_local).alias(name))
    local = d.select(
        "*",
        F.lag(value, 1).over(w_local).alias("_sl_nb"),
        F.row_number().over(w_local).alias("_sl_rn"),
    )
    edge = F.struct(
        F.col(order).alias("o"),
        *[F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)],
        F.col(value).alias("v"),
    )
    totals = large.groupBy(*part).agg(
        (F.max(edge) if asc else F.min(edge)).alias("_sl_edge")
    )
    w_blocks = Window.partitionBy(*part[:-1]).orderBy(F.col(blk).asc() if asc else F.col(blk).desc())
    prefix = totals.select(
        *part,
        F.lag(F.col("_sl_edge.v"), 1).over(w_blocks).alias("_sl_pb"),
        (F.row_number().over(w_blocks) == 1).alias("_sl_first_blk"),
    )
    joined = local.join(prefix, part, "left")
    dflt = F.lit(default)
    result = (
        F.when(F.col("_sl_rn") > 1, F.col("_sl_nb"))
        .when(F.coalesce(F.col("_sl_first_blk"), F.lit(True)), dflt)
        .otherwise(F.col("_sl_pb"))
    )
    return joined.select(*df.columns, result.alias(name))
