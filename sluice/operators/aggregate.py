"""Keyed aggregations (A01-A12): final, rolling and bounded top-k.

*final* = ``groupBy`` (partial aggregation before the exchange, so a hot key
is combined map-side); *rolling* = one result per input row through the
block-decomposed running aggregate (see ``rolling``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.rolling import ROWS_PER_BLOCK, running_aggregate


def keyed_final(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs)


def keyed_rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: Sequence[tuple[str, str, Column]],
    rows_per_block: int = ROWS_PER_BLOCK,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Rolling keyed aggregate: one output row per input row."""
    return running_aggregate(df, keys, order, specs, rows_per_block, tiebreak)


def row_struct(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return F.struct(*[F.col(c) for c in (cols or df.columns)])


def keyed_max_first_fields(df: DataFrame, key: str, field: str, seq: str, others: Sequence[str]) -> DataFrame:
    """A05 ``max(field)``: the maximum of ``field``; every other field keeps the
    value of the key's first row (by ``seq``)."""
    firsts = [F.min_by(F.col(o), F.col(seq)).alias(o) for o in others]
    return df.groupBy(key).agg(*firsts, F.max(field).alias(field))


def keyed_extreme_row(df: DataFrame, key: str, field: str, seq: str, kind: str) -> DataFrame:
    """The whole row holding the extreme ``field`` of the key.

    * ``min_by``  (A06) - smallest, first row wins ties
    * ``max_by``  (A07) - largest, first row wins ties
    * ``reduce``  (A08) - largest, newest row wins ties (strict ``>`` reduce)
    """
    row = row_struct(df, [c for c in df.columns if c != key])
    if kind == "min_by":
        # a null reading is no minimum unless the key has nothing else
        best = F.min_by(row, F.struct(F.col(field).isNull(), F.col(field), F.col(seq)))
    elif kind == "max_by":
        best = F.max_by(row, F.struct(F.col(field), -F.col(seq)))
    elif kind == "reduce":
        best = F.max_by(row, F.struct(F.col(field), F.col(seq)))
    else:
        raise ValueError(kind)
    return df.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def keyed_top_k(df: DataFrame, keys: Sequence[str], value: str, k: int, tiebreak: str) -> DataFrame:
    """The ``k`` rows with the largest ``value`` per key (ties: smaller
    ``tiebreak`` first), bounded in every phase.

    A ``row_number() <= k`` filter: Spark plans a *partial*
    ``WindowGroupLimit`` before the exchange, so each map partition ships at
    most ``k`` rows per key, and the final rank sees at most
    ``k x partitions`` rows of a key.  No key is sorted whole.
    """
    cols = [*keys, value, tiebreak]
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last(), F.col(tiebreak).asc())
    return df.select(*cols).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
