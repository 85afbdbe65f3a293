"""Projections, filters, flat-maps and the function surface.

Stateless operators are column expressions so they stay inside whole-stage
codegen.  Python is used only where the operator *is* user Python code
(P04 lifecycle, P14 table function, P15 user aggregate), and then
Arrow-batched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import ship_package


def map_project(df: DataFrame, *cols) -> DataFrame:
    """P01 record -> field."""
    return df.select(*cols)


def map_named(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """P02 a named, reusable transform."""
    return df.transform(fn)


def add_one(col: str) -> Column:
    """P03 x -> x + 1."""
    return (F.col(col) + 1).alias(col)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """P05/P06 equality filter; a null field is dropped, never an error."""
    return df.filter(F.lit(value) == F.col(col))


def filter_param(value) -> Callable[[DataFrame], DataFrame]:
    """P07 a predicate built with a parameter, reusable through ``transform``."""
    def apply(df: DataFrame, col: str = "id") -> DataFrame:
        return filter_equals(df, col, value)

    return apply


def filter_threshold(df: DataFrame, col: str, threshold) -> DataFrame:
    """P08 ``col > threshold``."""
    return df.filter(F.col(col) > F.lit(threshold))


def parity(col: str) -> Column:
    """P09 route by truncating ``%``: even when ``x % 2 == 0``, odd when
    ``x % 2 == 1``; negative odd numbers (``-3 % 2 = -1``) go to neither."""
    r = F.col(col) % 2
    return F.when(r == 0, F.lit("even")).when(r == 1, F.lit("odd"))


def flatmap_conditional(df: DataFrame, first_id, second_id) -> DataFrame:
    """P10: first key -> [vc]; second key -> [ts, vc]; other keys -> nothing;
    all as text."""
    out = (
        F.when(F.col("id") == first_id, F.array(F.col("vc").cast("string")))
        .when(F.col("id") == second_id, F.array(F.col("ts").cast("string"), F.col("vc").cast("string")))
        .otherwise(F.array().cast(T.ArrayType(T.StringType())))
    )
    return df.select("seq", F.posexplode(out).alias("pos", "value"))


def process_rows(df: DataFrame, outputs: Column) -> DataFrame:
    """P13 general per-row process function: ``outputs`` is an array of
    ``struct(route, payload)`` (0..n main and side rows per input)."""
    return df.select("*", F.explode(outputs).alias("_out")).select(
        *df.columns, F.col("_out.route").alias("route"), F.col("_out.payload").alias("payload")
    )


class RichMap:
    """P04 lifecycle: ``open`` once per task, ``map`` per batch, ``close``
    once per task (also when the task fails)."""

    def open(self, partition_id: int) -> None:  # pragma: no cover - hook
        pass

    def map(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        raise NotImplementedError

    def close(self) -> None:  # pragma: no cover - hook
        pass


def rich_map(df: DataFrame, factory: Callable[[], RichMap], schema: T.StructType | str) -> DataFrame:
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        ctx = TaskContext.get()
        fn.open(ctx.partitionId() if ctx else 0)
        try:
            for b in batches:
                yield fn.map(b)
        finally:
            fn.close()

    return df.mapInArrow(run, schema)


class AddOneMap(RichMap):
    """x -> x + 1 on column ``vc`` keeping ``seq``; counts its calls."""

    def open(self, partition_id: int) -> None:
        self.partition_id = partition_id
        self.opened = True

    def map(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        import pyarrow.compute as pc

        vc = batch.column(batch.schema.get_field_index("vc"))
        seq = batch.column(batch.schema.get_field_index("seq"))
        return pa.RecordBatch.from_arrays([seq, pc.add(vc, pa.scalar(1, pa.int32()))], names=["seq", "vc"])
