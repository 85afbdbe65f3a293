"""Operator 10: bound-certified best-fit packing.

``document_pieces`` turns whole texts into pieces of at most ``capacity``
tokens; ``pack`` puts pieces into as few sequences as it can.

1. The pieces are dealt at random into parts of about ``part_rows`` pieces and
   each part is packed best-fit decreasing (one pass, bounded memory).
2. Dual feasible functions give a lower bound on the sequences of each part.
   Where bound and result are equal the part is certified.
3. Parts with a gap hand over every sequence with room, certified parts only
   those with much room (what rounding up leaves).  The handed-over sequences
   are dealt anew as whole sequences, so documents of many parts meet, and
   best-fit decreasing runs again; a part keeps its old sequences unless the
   new ones are fewer.  This goes on until they fit one part, or a round
   neither gains a sequence nor leaves fewer pieces to hand over.  How many
   parts end without a certificate is logged.

Defined results: null or empty text is the end id alone; repeated rows are
packed each; ties in length go by the order of the written table; an empty
table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize
from sluice.llm.subwords import ids_of

CAPACITY = 2048
END_ID = 0
PART_ROWS = 16_384
#: A certified part hands over sequences with at least this share of room.
MUCH_ROOM = 16

_log = logging.getLogger(__name__)


def cuts(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all of full length but the first."""
    first = (n_tokens - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def document_pieces(df: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, added: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian uint32 bytes);
    ``added`` as in ``subwords``."""
    fields = ["doc_id", "piece", "start", "length", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        ids = ids_of(tokenizer_path, end_id, added)
        for b in batches:
            rows, held = [], 0
            for k, raw in zip(b.column("doc_id").to_pylist(), ids.encode_all(b.column("text"))):
                rows += [(k, i, s, n, raw[4 * s : 4 * (s + n)]) for i, (s, n) in enumerate(cuts(len(raw) // 4, capacity))]
                held += len(raw)
                if held > 1 << 22:
                    yield _batch(rows, fields, types)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, fields, types)

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids binary")


def _batch(rows: list[tuple], fields: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], fields)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of three families of dual feasible functions on the
    number of bins that ``lengths`` need (exact integer arithmetic)."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(object if capacity > 1 << 20 else np.int64)
    size = np.arange(capacity + 1)
    total = lambda value, unit: -(-int((count * value).sum()) // unit)
    best = total(size, capacity)
    if not len(lengths):
        return 0
    # U(e): sizes over capacity - e count whole, those under e not at all.
    n_up, s_up = np.cumsum(count[::-1])[::-1], np.cumsum((count * size)[::-1])[::-1]
    for e in np.unique(lengths[lengths <= capacity // 2]):
        big = int(n_up[capacity - e + 1]) if e else 0
        middle = int(s_up[e]) - (int(s_up[capacity - e + 1]) if e else 0)
        best = max(best, big - (-middle // capacity))
    # u(k): rounding to multiples of 1/k.
    for k in range(1, 33):
        exact = (k + 1) * size % capacity == 0
        best = max(best, total(np.where(exact, k * size, (k + 1) * size // capacity * capacity), k * capacity))
    # phi(e): large sizes rounded up by what fits beside them in units of e.
    for e in range(max(1, capacity // 64), capacity // 2 + 1, max(1, capacity // 64)):
        m = capacity // e
        value = np.where(2 * size > capacity, m - (capacity - size) // e, np.where(size >= e, 1, 0))
        best = max(best, total(value, m))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length (given longest first) and each bin's
    room.  Open bins are kept by room; a bit set finds the smallest room that
    is large enough."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, room, bins, offsets = 0, [], [], []
    for n in lengths.tolist():
        fit = open_rooms >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = stacks[r].pop()
            if not stacks[r]:
                open_rooms ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins.append(b)
        offsets.append(capacity - r)
        room[b] = r = r - n
        if r:
            if not stacks[r]:
                open_rooms |= 1 << r
            stacks[r].append(b)
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(room, np.int64)


def _pack_part(part: pa.Table, capacity: int, round_no: int) -> pa.Table:
    lengths = part["length"].to_numpy()
    bins, offsets, room = best_fit_decreasing(lengths, capacity)
    certified = len(room) == lower_bound(lengths, capacity)
    old = part["sequence_id"].to_numpy()
    if round_no and len(np.unique(old)) <= len(room):
        ids, offsets = old, part["offset"].to_numpy()
        _, inverse = np.unique(old, return_inverse=True)
        room = (capacity - np.bincount(inverse, lengths)).astype(np.int64)
        bins, gained = inverse, False
    else:
        # A piece is first in one sequence only, so its number names it.
        first = np.zeros(len(room), np.int64)
        first[bins[offsets == 0]] = part["item"].to_numpy()[offsets == 0]
        ids, gained = first[bins], True
    handed = (room > 0) if not certified else (room * MUCH_ROOM >= capacity)
    part = part.drop_columns(["sequence_id", "offset", "handed", "gained", "open_parts"])
    return (
        part.append_column("sequence_id", pa.array(ids, pa.int64()))
        .append_column("offset", pa.array(offsets, pa.int64()))
        .append_column("handed", pa.array(handed[bins]))
        .append_column("gained", pa.array(np.full(len(ids), gained)))
        .append_column("open_parts", pa.array((np.arange(len(ids)) == 0) & (not certified)))
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The parts of a partition sorted by part, each whole."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        part = b.column(b.schema.get_field_index("part")).to_numpy()
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            if held and held[0].column(held[0].schema.get_field_index("part"))[0].as_py() != part[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def _round(items: DataFrame, unit: str, rows: int, part_rows: int, capacity: int, round_no: int) -> DataFrame:
    n_parts = max(1, -(-rows // part_rows))
    dealt = items.withColumn("part", F.pmod(F.xxhash64(unit), F.lit(n_parts)))
    dealt = dealt.repartition("part").sortWithinPartitions("part", F.desc("length"), "item")
    schema = items.schema
    order = schema.names

    def run(batches):
        for part in _parts(batches):
            packed = _pack_part(part.drop_columns(["part"]), capacity, round_no)
            yield from packed.select(order).combine_chunks().to_batches()

    return materialize(map_batches(dealt, run, schema), "packed")


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``pieces`` (any columns and ``length``, 1 to ``capacity``) with
    ``sequence_id`` and ``offset`` added.  The columns ``carry`` (token ids,
    for one) stay out of the rounds and are joined to the result."""
    columns = pieces.columns
    whole = materialize(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    items = whole.drop(*carry)
    state = items.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("handed"), F.lit(True).alias("gained"), F.lit(True).alias("open_parts"))
    rows, unit, done = items.count(), "item", []
    for round_no in itertools.count():
        state = _round(state, unit, rows, part_rows, capacity, round_no)
        single, before, unit = rows <= part_rows, rows, "sequence_id"
        rows, gained, open_parts = state.agg(F.count_if("handed"), F.max("gained"), F.count_if("open_parts")).first()
        if single or not rows or not (gained or rows < before):
            _log.info("packed in %d rounds, %d parts without a certificate", round_no + 1, open_parts)
            done.append(state)
            break
        done.append(state.filter(~F.col("handed")))
        state = state.filter("handed")
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    if carry:
        result = result.join(whole.select("item", *carry), "item")
    return result.select(*columns, "sequence_id", "offset")
