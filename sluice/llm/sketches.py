"""Operator 1: document fingerprints as bottom-k sketches of shingle hashes.

A sketch holds the ``K`` smallest distinct 64-bit hashes of a text's shingles
of five words (fewer words: the whole sequence; none: no shingle).  Sketches
merge: the sketch of a union is the ``K`` smallest of the union of sketches,
so long texts are hashed in blocks, and parts of a corpus can be sketched
apart and merged (``merge_sketches``).  From sketches come estimates of
resemblance, containment and the number of distinct shingles.

Words follow the shingle operators' rule (runs of bytes other than space and
0x09-0x0D, A-Z lower-cased).  Hashing is array work over the bytes of a block
of words: a polynomial hash of each word from running sums, a polynomial of
five word hashes for each shingle, then a mixing step.

Defined results: null text is the empty text; two empty sketches have
resemblance 1 and containment 1, an empty and another 0; equal texts have equal
sketches; repeated rows are fingerprinted each; rows that share an id, and
null ids (first), follow one another in the order of their texts; other columns
are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, text_rows
from sluice.session import ship_package

K = 128
#: Groups that a task holds while it merges sketches (1 KB each).
HELD = 16_384
SHINGLE = 5
#: Bytes of text hashed at a time.
BLOCK = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, BLOCK + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all (the finaliser of a known 64-bit mixer)."""
    h = (h ^ h >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ h >> _U(27)) * _U(0x94D049BB133111EB)
    return h ^ h >> _U(31)


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a block of whole words."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    word = np.concatenate([[False], ~_BREAK[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * _POWER[: len(data)])])
    return _mix((sums[end] - sums[start]) * _INVERSE[start] + (end - start).astype(np.uint64)), start


def _shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(size, len(words))):
        h = h * _U(_STEP) + words[i : i + n]
    return _mix(h)


def _smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values in order."""
    m = 2 * k
    while len(hashes) > m:
        found = np.unique(np.partition(hashes, m)[:m])
        if len(found) >= k:
            return found[:k]
        m *= 4
    return np.unique(hashes)[:k]


def _blocks(raw: bytes, block: int) -> Iterator[bytes]:
    """Cut at word breaks; a word longer than a block is its own (hashed by
    digest, see ``sketch``)."""
    at = 0
    while len(raw) - at > block:
        cut = max(raw.rfind(c, at, at + block) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:
            ends = [e for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (e := raw.find(c, at + 1)) > 0]
            cut = min(ends, default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def sketch(text: str | None, k: int = K, size: int = SHINGLE, block: int = BLOCK) -> np.ndarray:
    """The k smallest distinct shingle hashes of a whole text, in order."""
    least, words, seen = np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0
    raw = (text or "").encode()
    for part in _blocks(raw, block):
        if len(part) > block:  # one word, perhaps after a break
            one = part.translate(_LOWER.tobytes()).strip(b" \t\n\x0b\x0c\r")
            new = np.frombuffer(hashlib.sha256(one).digest()[:8], "<u8") if one else np.zeros(0, np.uint64)
        else:
            new, _ = _word_hashes(part)
        words = np.concatenate([words[-(size - 1) :] if size > 1 else words[:0], new])
        seen += len(new)
        if len(words) >= size:
            least = _smallest(np.concatenate([least, _shingle_hashes(words, size)]), k)
    if 0 < seen < size:
        least = _shingle_hashes(words, size)
    return least


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all: of the k smallest of
    both, those in both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:k]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    union = np.union1d(a, b)[:k]
    common = resemblance(a, b, k) * distinct_shingles(union, k) if len(b) else 0.0
    return min(1.0, common / distinct_shingles(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def sketch_documents(df: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, n_distinct`` (estimated) for each row."""

    def run(batches):
        for b in batches:
            rows = [(d, s := sketch(t, k, size)) for d, t in text_rows(b, "doc_id", "text")]
            cols = [pa.array([d for d, _ in rows], pa.int64()), pa.array([to_text(s) for _, s in rows]), pa.array([distinct_shingles(s, k) for _, s in rows])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "fingerprint", "n_distinct"])

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, fingerprint string, n_distinct double")


def merge_sketches(df: DataFrame, by: list[str], column: str = "fingerprint", k: int = K, most: int = HELD) -> DataFrame:
    """One sketch a group of ``by`` (string columns).  Each task merges what
    it has before the shuffle, holding ``most`` groups, and streams the
    groups in order after it, so a hot group sends few sketches a task and
    memory does not grow with the number of groups."""

    def rows_of(groups):
        cols = [pa.array([g[i] for g, _ in groups], pa.string()) for i in range(len(by))]
        return pa.RecordBatch.from_arrays([*cols, pa.array([to_text(v) for _, v in groups])], [*by, column])

    def before(batches):
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            for *key, s in text_rows(b, *by, column):
                held[tuple(key)] = np.union1d(held.get(tuple(key), _NONE), from_text(s))[:k]
                if len(held) >= most:
                    yield rows_of(list(held.items()))
                    held = {}
        if held:
            yield rows_of(list(held.items()))

    def after(batches):
        # sorted by group: one is held
        group, hashes = None, _NONE
        for b in batches:
            done = []
            for *key, s in text_rows(b, *by, column):
                if group is not None and key != group:
                    done.append((group, hashes))
                    hashes = _NONE
                group, hashes = key, np.union1d(hashes, from_text(s))[:k]
            if done:
                yield rows_of(done)
        if group is not None:
            yield rows_of([(group, hashes)])

    schema = ", ".join(f"`{c}` string" for c in [*by, column])
    part = map_batches(df.select(*by, column), before, schema)
    return map_batches(part.repartition(*by).sortWithinPartitions(*by), after, schema)


_NONE = np.zeros(0, np.uint64)
_FIRST = -(1 << 63)  # stands for a null id: before all others


def _followed(df: DataFrame) -> DataFrame:
    """``task, guard, doc_id, text``: ids dealt in order over as many tasks as
    there are shuffle partitions, each task's rows sorted and followed by the
    first row of the next task (``guard``; the last is followed by the first
    of all).  The borders are quantiles of all ids; borders and first ids are
    the only things that pass the driver, one a task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    levels = np.arange(1, n) / n
    cuts = docs.agg(F.percentile_approx("place", F.lit(levels), max(10_000, 10 * n))).first()[0] if n > 1 else None
    edges = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def task_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, place.to_numpy(), "right").astype(np.int32))

    ship_package(df.sparkSession)
    placed = docs.withColumn("task", task_of("place"))
    firsts = sorted(docs.select("place").withColumn("task", task_of("place")).groupBy("task").agg(F.min("place")).collect())
    if not firsts:
        return placed.select("task", F.lit(False).alias("guard"), "doc_id", "text")
    starts = np.array([place for _, place in firsts], np.int64)
    previous = np.roll(np.array([task for task, _ in firsts], np.int32), 1)

    @F.pandas_udf("int")
    def followed_task(place: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(starts, place.to_numpy()), len(starts) - 1)
        return pd.Series(np.where(starts[at] == place.to_numpy(), previous[at], -1).astype(np.int32))

    placed = placed.withColumn("follows", followed_task("place"))
    own = F.struct(F.col("task").alias("task"), F.lit(False).alias("guard"))
    twice = F.array(own, F.struct(F.col("follows").alias("task"), F.lit(True).alias("guard")))
    dealt = placed.withColumn("to", F.explode(F.when(F.col("follows") >= 0, twice).otherwise(F.array(own))))
    dealt = dealt.select("to.task", "to.guard", "place", "doc_id", "text")
    return dealt.repartitionById(len(edges) + 1, "task").sortWithinPartitions("task", "guard", "place", "text").drop("place")


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the beginning of
    ``following`` as there is."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


def compare_with_edit(df: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """Each document's sketch, that of its edited text (``edited`` with the
    next document), and their likeness and that to the next document's:
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(one: tuple, following: tuple) -> tuple:
        doc, text, own = one
        changed = edited(text, following[1])
        s = sketch(changed, k, size)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return doc, len(text), digest, to_text(own), to_text(s), resemblance(own, s, k), resemblance(own, following[2], k)

    def run(batches):
        held = None
        for b in batches:
            rows = []
            for t, guard, doc, text in text_rows(b, "task", "guard", "doc_id", "text"):
                if guard and held is None:
                    continue  # a further row with the first id
                now = (doc, text, sketch(text, k, size))
                if held is not None:
                    rows.append(compared(held, now))
                held = None if guard else now
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(_followed(df), run, schema)
