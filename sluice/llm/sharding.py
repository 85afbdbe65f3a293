"""Operator 5: shards as runs of a Hilbert curve over metadata, in expressions.

Each dimension is quantised to ``2 ** BITS`` levels of about equal row counts
(quantiles of all rows); texts count by the bytes after the prefix that all
values of the column share, so the order of the values is kept.  The Hilbert
index of the levels orders the rows; ties go by text checksum, so equal texts
stand together, then by a hash of the id and the id.  The ordered rows are cut
into runs whose row counts differ by at most one (law ``rows``).  Rows near
each other on the curve are near in every dimension, so a shard's minima and
maxima are narrow in all of them and readers can skip files on any.

The order is one range exchange of small rows (no text).  Its keys reach down
to the id, so a cell or a text with a third of all rows is spread over many
tasks.  Positions are the row number within a task plus the counts of the
tasks before.

Defined results: null text has size 8 and checksum 0; nulls in a dimension
come first; repeated rows get places of their own; fewer rows than shards fill
the first shards with one row each; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import materialize

SHARDS = 24
BITS = 5
DIMENSIONS = ("lang", "source", "size", "doc_id")
#: Bytes of a text value that count after the shared prefix.
TEXT_BYTES = 7
ACCURACY = 10_000


def text_metadata(docs: DataFrame) -> DataFrame:
    """The small rows that are sharded: id, lang, source, size and checksum of
    the UTF-8 bytes."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", "lang", "source", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))


def _shared(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _numbers(df: DataFrame, dims: Sequence[str]) -> dict[str, Column]:
    """A number for each dimension in the order of its values."""
    texts = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    ends = df.agg(*[f(d).alias(f"{f.__name__}_{d}") for d in texts for f in (F.min, F.max)]).first() if texts else None
    out = {}
    for d in dims:
        if d in texts:
            skip = _shared(ends[f"min_{d}"], ends[f"max_{d}"])
            tail = F.substring(F.col(d).cast("binary"), skip + 1, TEXT_BYTES)
            out[d] = F.conv(F.rpad(F.hex(tail), 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
        else:
            out[d] = F.col(d).cast("double")
    return out


def hilbert_index(levels: Sequence[Column], bits: int) -> Column:
    """The Hilbert curve's index of a cell: Skilling's transform, as folds
    over the list of its steps."""
    n = len(levels)
    xor = lambda a, b: a.bitwiseXOR(b)
    zero = F.lit(0).cast("long")

    def undo(x: Column, step: Column) -> Column:
        """Invert the first coordinate's low bits or exchange them."""
        q, i = step["q"], step["i"]
        p = q - 1
        xi, x0 = F.get(x, i), F.get(x, F.lit(0))
        on = xi.bitwiseAND(q) != 0
        swap = xor(x0, xi).bitwiseAND(p)
        first = F.when(on, xor(x0, p)).otherwise(xor(x0, swap))
        return F.transform(x, lambda v, j: F.when(j == 0, first).when(~on & (j == i), xor(v, swap)).otherwise(v))

    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])
    cell = F.aggregate(steps, F.array(*[c.cast("long") for c in levels]), undo) if bits > 1 else F.array(*[c.cast("long") for c in levels])
    # Gray code: each coordinate with all before it, then the last one's share.
    gray = lambda x: F.transform(x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), zero, xor))
    powers = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<bigint>")
    turn = lambda x: F.aggregate(powers, zero, lambda t, q: F.when(F.get(x, F.lit(n - 1)).bitwiseAND(q) != 0, xor(t, q - 1)).otherwise(t))
    done = lambda x: F.transform(x, lambda v: xor(v, turn(x)))
    # Bit b of every coordinate, the first coordinate's first.
    order = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(1 << b).cast("long").alias("q")) for b in range(bits - 1, -1, -1) for i in range(n)])
    digits = lambda x: F.aggregate(order, zero, lambda h, s: h * 2 + (F.get(x, s["i"]).bitwiseAND(s["q"]) != 0).cast("long"))
    one = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  f sees x as a value, computed once
    return one(one(one(cell, gray), done), digits)


def curve_index(df: DataFrame, dims: Sequence[str] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, the Hilbert index of its quantised dimensions."""
    numbers = _numbers(df, dims)
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = df.agg(*[F.percentile_approx(numbers[d], share, ACCURACY).alias(d) for d in dims]).first()
    levels = []
    for d in dims:
        level = F.lit(0)
        for c, n in sorted(Counter(edges[d] or []).items()):  # a frequent value passes several levels at once
            level = level + F.when(numbers[d] > c, n).otherwise(0)
        levels.append(level)
    placed = df.select("*", *[lv.alias(f"_level{i}") for i, lv in enumerate(levels)])
    return placed.select(*df.columns, hilbert_index([F.col(f"_level{i}") for i in range(len(dims))], bits).alias("curve"))


def positions(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``df`` with ``position``, its place from 0 in the order of the columns
    ``order``, and the number of rows."""
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    task, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    tasks = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))  # a row a task
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(tasks.select("_task", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts")
    total = starts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rows = placed.withColumn("_task", task).join(starts, "_task").withColumn("position", F.col("_start") + inside)
    return rows.select(*df.columns, "position"), total


def hilbert_shards(df: DataFrame, n_shards: int = SHARDS, dims: Sequence[str] = DIMENSIONS, bits: int = BITS, ties: Sequence[str] = ("text_crc32", "doc_id")) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``."""
    keyed = curve_index(df, dims, bits).withColumn("_spread", F.xxhash64(ties[-1]))
    ordered, total = positions(keyed, ["curve", *ties[:-1], "_spread", ties[-1]])
    less, more = divmod(total, n_shards)  # the first `more` shards have a row more
    edge, each = more * (less + 1), max(less, 1)
    shard = F.expr(f"case when position < {edge} then position div {less + 1} else {more} + (position - {edge}) div {each} end")
    slot = F.expr(f"case when position < {edge} then position % {less + 1} else (position - {edge}) % {each} end")
    return ordered.select(*df.columns, "curve", shard.cast("int").alias("shard"), slot.alias("slot"))


def shard_bounds(shards: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """What a reader prunes by: rows, minima and maxima of each shard."""
    return shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])


def write_shards(shards: DataFrame, path: str) -> None:
    """One sorted run of files a shard."""
    shards.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
