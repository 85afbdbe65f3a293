"""User functions: table function (P14) and user aggregate.

P15 keeps the create/add/merge/result contract of the reference's aggregate
function, but with a real, associative ``merge``, and every step works on a
whole Arrow table of many keys at once (one Python call per batch or per
partition, never one per key).  It runs in two phases so no key is ever
gathered in one task:

1. ``mapInArrow``: per input partition, ``add`` every row into one
   accumulator per key (map-side combine);
2. hash-repartition the partial accumulators by key (at most one per key per
   input partition), then ``mapInArrow`` again: ``merge`` them per key and
   compute the ``result``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.functions import arrow_udtf

from sluice.session import ship_package


@arrow_udtf(returnType="seq bigint, pos int, value string")
class ConditionalExpand:
    """The P10 flat-map as a table function (first key -> [vc], second
    key -> [ts, vc]).  ``eval`` gets a whole Arrow batch of the input table
    and yields the expanded rows of the batch, vectorised."""

    def eval(self, batch: pa.RecordBatch):
        ids = batch.column("id")
        first = pc.fill_null(pc.equal(ids, batch.column("first_id")), False)
        second = pc.and_(pc.fill_null(pc.equal(ids, batch.column("second_id")), False), pc.invert(first))

        def rows(mask, pos: int, col: str) -> pa.Table:
            b = batch.filter(mask)
            return pa.table(
                {
                    "seq": b.column("seq"),
                    "pos": pa.array([pos] * b.num_rows, pa.int32()),
                    "value": pc.cast(b.column(col), pa.string()),
                }
            )

        yield pa.concat_tables([rows(first, 0, "vc"), rows(second, 0, "ts"), rows(second, 1, "vc")])


def udtf_expand(df: DataFrame, first_id: int, second_id: int) -> DataFrame:
    """Rows ``(seq, pos, value)``; the table argument keeps the input's
    partitioning, so the function runs in every scan task."""
    ship_package(df.sparkSession)
    inp = df.select(
        "seq", "id", "ts", "vc",
        F.lit(first_id).cast(df.schema["id"].dataType).alias("first_id"),
        F.lit(second_id).cast(df.schema["id"].dataType).alias("second_id"),
    )
    return ConditionalExpand(inp.asTable())


#: Keys whose accumulators a task of the first phase holds at a time.
HELD_KEYS = 100_000


class AverageAggregate:
    """create / add / merge / result over a (sum, count) accumulator, each
    step vectorised over all keys of an Arrow table."""

    acc_fields = [("sum", pa.float64()), ("count", pa.int64())]
    result_type = "double"

    @staticmethod
    def add(tbl: pa.Table, keys: list[str], value: str) -> pa.Table:
        v = pc.cast(tbl.column(value), pa.float64())
        t = pa.table({**{k: tbl.column(k) for k in keys}, "v": v})
        g = t.group_by(keys, use_threads=False).aggregate([("v", "sum"), ("v", "count")])
        return pa.table(
            {**{k: g.column(k) for k in keys}, "sum": g.column("v_sum"), "count": g.column("v_count")}
        )

    @staticmethod
    def merge(acc: pa.Table, keys: list[str]) -> pa.Table:
        g = acc.group_by(keys, use_threads=False).aggregate([("sum", "sum"), ("count", "sum")])
        return pa.table(
            {**{k: g.column(k) for k in keys}, "sum": g.column("sum_sum"), "count": g.column("count_sum")}
        )

    @staticmethod
    def result(acc: pa.Table) -> pa.Array:
        cnt = acc.column("count")
        # an all-null key has count 0: no average
        safe = pc.if_else(pc.equal(cnt, 0), pa.scalar(None, pa.int64()), cnt)
        return pc.divide(acc.column("sum"), pc.cast(safe, pa.float64()))


def custom_aggregate(df: DataFrame, keys: Sequence[str], value: str, agg=AverageAggregate) -> DataFrame:
    ship_package(df.sparkSession)
    keys = list(keys)
    key_schema = df.select(*keys).schema
    acc_schema = T.StructType(
        key_schema.fields + [T.StructField(n, from_arrow_type(t)) for n, t in agg.acc_fields]
    )
    out_schema = T.StructType(key_schema.fields + [*T.StructType.fromDDL(f"result {agg.result_type}").fields])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # accumulators of at most HELD_KEYS keys; beyond, they are handed on
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            new = agg.add(pa.Table.from_batches([b]), keys, value)
            held = new if held is None else agg.merge(pa.concat_tables([held, new]), keys)
            if held.num_rows > HELD_KEYS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by key: only the last key of a batch may go on in the next
        def done(acc: pa.Table) -> Iterator[pa.RecordBatch]:
            yield from pa.table({**{k: acc.column(k) for k in keys}, "result": agg.result(acc)}).to_batches()

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = agg.merge(t if last is None else pa.concat_tables([last, t]), keys)
            last = t.slice(t.num_rows - 1)
            yield from done(t.slice(0, t.num_rows - 1))
        if last is not None:
            yield from done(last)

    partials = df.select(*keys, value).mapInArrow(partial, acc_schema)
    return partials.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final, out_schema)
