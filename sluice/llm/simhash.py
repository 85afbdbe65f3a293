"""Operator 9: SimHash near-duplicates by anchor-point covering.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a
text's word shingles.  Fingerprints that differ in at most ``DISTANCE`` = 4 of
64 bits are linked; a document's component is the smallest document id
reachable by links.

Finding the links.  The 64 bits are dealt into six blocks of 11, 11, 11, 11,
10 and 10 bits.  Six windows of three blocks hold every pair of blocks
together (a covering design).  Four differing bits leave two blocks equal, or
lie in at most three blocks, so some window holds at most one of them.  The
anchors of a window are the 2^26 code words of the perfect Hamming code of 31
bits, covering radius 1: each fingerprint has one anchor within 1 (its home)
and is replicated to every anchor within radius plus threshold, 1 + 1.  Two
fingerprints that differ in at most one bit of the window so meet at the home
of either.  At an anchor, whole fingerprints are compared bit by bit.

Exact copies of a fingerprint are folded before, so a group of copies is one
row.  At an anchor only a spanning forest of the links leaves the task: a
search takes each newly reached fingerprint once and looks only at those not
reached yet, so a dense group costs about its size, not its square.

Defined results: null or wordless text has fingerprint 0, linked like any
other; a null id keeps its fingerprint, counts for no
component's minimum, and has a null component where no id is reachable; repeated rows
stay repeated; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize, null_safe, text_rows
from sluice.llm.graph import connected_components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Every two of the six blocks are in one of these.
WINDOWS = ((0, 1, 2), (0, 1, 3), (2, 3, 4), (2, 3, 5), (0, 4, 5), (1, 4, 5))
CODE_BITS = 31
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text."""
    from xxhash import xxh64_intdigest

    # bytes.split() takes exactly space and 0x09-0x0D; bytes.lower() only A-Z.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = zip(starts[at : min(at + _CHUNK, n)].tolist(), ends[at : at + _CHUNK].tolist())
        hashes = np.array([xxh64_intdigest(flat[s:e], SEED) for s, e in part], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            rows = [(k, fingerprint(t, shingle)) for k, t in text_rows(b, "doc_id", "text")]
            ids = pa.array([k for k, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.array([f for _, f in rows], np.uint64).view(np.int64))], ["doc_id", "fp"])

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, fp long")


def _window_bits() -> list[list[int]]:
    starts = np.concatenate([[0], np.cumsum(BLOCKS)])
    return [[b for k in w for b in range(starts[k], starts[k + 1])][:CODE_BITS] for w in WINDOWS]


def _syndrome_pairs() -> np.ndarray:
    """For each syndrome s > 0 the 15 masks of two positions, none of them s,
    whose numbers xor to s."""
    masks = np.zeros((CODE_BITS + 1, CODE_BITS // 2), np.uint64)
    for s in range(1, CODE_BITS + 1):
        masks[s] = [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in range(1, CODE_BITS + 1) if i < i ^ s and i != s]
    return masks


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (window, code word, replica) and the row of ``fps`` of each: one
    home and 15.5 further anchors on average for each window."""
    pairs, one = _syndrome_pairs(), np.uint64(1)
    keys, rows, every = [], [], np.arange(len(fps))
    for w, bits in enumerate(_window_bits()):
        value, syndrome = np.zeros(len(fps), np.uint64), np.zeros(len(fps), np.int64)
        for i, bit in enumerate(bits):
            on = fps >> np.uint64(bit) & one
            value |= on << np.uint64(i)
            syndrome ^= on.astype(np.int64) * (i + 1)
        off = syndrome > 0
        home = value ^ np.where(off, one << (np.maximum(syndrome, 1) - 1).astype(np.uint64), np.uint64(0))
        far = (value[off, None] ^ pairs[syndrome[off]]).ravel()
        tag = lambda word, replica: (np.uint64(w) << np.uint64(32)) | word << one | np.uint64(replica)
        keys += [tag(home, 0), tag(far, 1)]
        rows += [every, np.repeat(every[off], pairs.shape[1])]
    return np.concatenate(keys).view(np.int64), np.concatenate(rows)


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is linked among ``fps``: breadth first, each
    reached fingerprint against those not reached yet."""
    left, links = fps, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found = left[near]
                links += [(int(x), int(y)) for y in found]
                queue += list(found)
                left = left[~near]
    return links


def _anchor_links(batches, distance: int):
    """Rows sorted by key; the homes of an anchor come just before its
    replicas.  Only groups with a home and company are looked at."""
    rest_k, rest_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)  # bits of a negative number are not counted as they stand

    def links(k: np.ndarray, f: np.ndarray):
        place = k >> 1
        edges = np.flatnonzero(place[1:] != place[:-1]) + 1
        first, last = np.concatenate([[0], edges]), np.concatenate([edges, [len(k)]])
        good = (last - first > 1) & (k[first] & 1 == 0)
        found = []
        for a, z in zip(first[good].tolist(), last[good].tolist()):
            if z - a == 2:
                x, y = int(f[a]), int(f[a + 1])
                if (x ^ y).bit_count() <= distance:
                    found.append((x, y))
            else:
                found += _forest(f[a:z], distance)
        if found:
            pairs = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"])

    for b in batches:
        k = np.concatenate([rest_k, b.column(0).to_numpy()])
        f = np.concatenate([rest_f, b.column(1).to_numpy().view(np.uint64)])
        if not len(k):
            continue
        keep = np.searchsorted(k >> 1, k[-1] >> 1)  # the last anchor may go on
        yield from links(k[:keep], f[:keep]) if keep else ()
        rest_k, rest_f = k[keep:], f[keep:]
    if len(rest_k):
        yield from links(rest_k, rest_f)


def linked_fingerprints(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(a, b)`` between the rows of ``distinct`` (column ``fp``) that
    join exactly the fingerprints reachable from each other."""
    if distance > DISTANCE:
        raise ValueError(f"the windows cover up to {DISTANCE} differing bits")

    def replicate(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                fps = b.column(0).slice(at, 2000).to_numpy().view(np.uint64)
                keys, rows = anchors(fps)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps.view(np.int64)[rows])], ["k", "fp"])

    placed = map_batches(distinct.select("fp"), replicate, "k long, fp long")
    placed = placed.repartition(F.shiftright("k", 1)).sortWithinPartitions("k", "fp")
    return map_batches(placed, lambda batches: _anchor_links(batches, distance), "a long, b long").distinct()


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``df``."""
    prints = materialize(fingerprints(df, shingle), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    parts = connected_components(linked_fingerprints(distinct, distance))
    named = distinct.join(parts, distinct["fp"] == parts["node"])
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = named.join(least, "component").select("fp", "component_id")
    classes = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(df: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``df`` whose document is its component's smallest id, with
    all their columns.  Rows with a null id stay.  Rows that share an id stay
    or go together, and of those equal in id and text one stays."""
    kept = near_duplicates(df, shingle, distance).filter("doc_id is null or doc_id = component_id").select("doc_id").distinct()
    rows = null_safe(df, kept, ["doc_id"], "left_semi")
    repeated = df.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").limit(1).count()
    return rows.dropDuplicates(["doc_id", "text"]) if repeated else rows
