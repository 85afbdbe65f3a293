"""Operator 11: hard negatives by inner products, with LEMP-style pruning.

Vectors are rows of whole numbers (components times ``scale``, rounded down).
A search looks for the best rows of each *window* ``[low, high]`` of scores of
an anchor, of the anchor's label or of the others, over all rows:

* Rows are grouped into length buckets (a factor of ``2 ** (1 / STEPS)`` from
  one to the next), and these by hash into blocks of about ``BLOCK`` rows;
  anchors into chunks of about ``CHUNK``.  Every chunk meets every block whose
  lengths can reach the anchor's threshold, in a task of its own, the anchors
  streamed past the block: no group depends on how many rows share a label or
  a vector.
* In a block each coordinate of the normalised vectors has a sorted list.  For
  an anchor, the threshold over both lengths bounds the cosine; for the
  ``FOCUS`` coordinates in which the anchor is largest, this bounds the values
  that a row may have there.  The ranges are found in the sorted lists, the
  shortest gives the candidates, the others are intersected with it, and what
  remains is verified with exact scores.
* The block of the longest vectors is searched first, and where it fills a
  window, its last score raises the threshold for all other blocks.

A block hands on at most the wanted number of rows for a window.

Defined results: rows with a null id or label, a null vector, or any null or
non-finite component take no part, nor do vectors whose squared length reaches
2**62 (a score could leave the range of a long); only vectors of equal size
meet, and vectors without components score 0; zero vectors score 0; equal
scores go by the smaller id; repeated rows are rows of their own, each anchor
and each partner; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize

BLOCK = 4096
CHUNK = 2048
FOCUS = 5
STEPS = 4
LONGEST = float(1 << 62)
NO_LOW, NO_HIGH = -(1 << 63), (1 << 63) - 1
#: Room for rounding in cosines and values of normalised vectors.
SLACK = 1e-9
KEY = ["size", "part", "bucket", "sub", "chunk"]


def whole_vectors(df: DataFrame, anchor: Column, scale: int = 256) -> DataFrame:
    """The rows that take part: ``row_id`` (its own for each row), ``vec_id,
    label, is_anchor, vector, size, length, bucket``; written once."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), anchor.alias("is_anchor"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    squared = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    rows = rows.withColumn("length", F.sqrt(squared)).filter(F.col("length") * F.col("length") < LONGEST)
    bucket = F.when(F.col("length") > 0, F.floor(F.log2("length") * STEPS)).otherwise(-1).cast("int")
    rows = rows.select(
        F.monotonically_increasing_id().alias("row_id"), "vec_id", "label", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"), F.col("v").cast("array<int>").alias("vector"), F.size("v").alias("size"), "length", bucket.alias("bucket")
    )
    return materialize(rows, "whole-vectors")


class _Block:
    """The rows of a block, with a sorted list for each coordinate."""

    def __init__(self, rows: pa.Table, size: int):
        self.row_id, self.vec_id, self.label = (rows[c].to_numpy() for c in ("row_id", "vec_id", "label"))
        self.whole = rows["vector"].combine_chunks().flatten().to_numpy().reshape(len(self.row_id), size).astype(np.int64)
        self.lengths = rows["length"].to_numpy()
        self.longest = self.lengths.max()
        self.real = self.whole.astype(np.float64)
        self.units = self.real / np.maximum(self.lengths, 1e-300)[:, None]
        self.order = np.argsort(self.units, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(self.units, axis=0).T.copy()

    def candidates(self, unit: np.ndarray, length: float, low: int) -> np.ndarray | None:
        """Rows that may score ``low`` or more; None: all of them."""
        if low <= 0 or not len(unit):
            return None
        reach = length * self.longest
        cosine = low / reach if reach else 2.0
        if cosine > 1 + SLACK:
            return self.order[0][:0]
        part = np.arccos(max(-1.0, min(1.0, cosine - SLACK)))
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        at = np.arccos(np.clip(unit[focus], -1, 1))
        least, most = np.cos(np.minimum(np.pi, at + part)) - SLACK, np.cos(np.maximum(0, at - part)) + SLACK
        ranges = [(np.searchsorted(self.sorted[f], a), np.searchsorted(self.sorted[f], z, "right")) for f, a, z in zip(focus, least, most)]
        first = min(range(len(focus)), key=lambda i: ranges[i][1] - ranges[i][0])
        rows = self.order[focus[first]][slice(*ranges[first])]
        for i, f in enumerate(focus):
            if i != first:
                x = self.units[rows, f]
                rows = rows[(x >= least[i]) & (x <= most[i])]
        return rows

    def scores(self, vector: np.ndarray, length: float, rows: np.ndarray | None) -> np.ndarray:
        if length * self.longest < float(1 << 52):  # doubles are exact
            real = self.real if rows is None else self.real[rows]
            return (real @ vector.astype(np.float64)).astype(np.int64)
        return (self.whole if rows is None else self.whole[rows]) @ vector

    def best(self, anchor: dict, same: bool, wanted: int):
        """``(slot, row, score)`` of the anchor's windows."""
        vector = np.asarray(anchor["vector"], np.int64)
        unit = vector / anchor["length"] if anchor["length"] else vector.astype(np.float64)
        rows = self.candidates(unit, anchor["length"], min(w["low"] for w in anchor["windows"]))
        score = self.scores(vector, anchor["length"], rows)
        rows = np.arange(len(self.row_id)) if rows is None else rows
        keep = (self.label[rows] == anchor["label"]) == same
        keep &= self.row_id[rows] != anchor["row_id"]
        rows, score = rows[keep], score[keep]
        order = np.lexsort((self.row_id[rows], self.vec_id[rows], -score))
        rows, score = rows[order], score[order]
        for w in anchor["windows"]:
            at = np.searchsorted(-score, -w["high"])
            for i in range(at, min(at + wanted, len(rows))):
                if score[i] < w["low"]:
                    break
                yield w["slot"], rows[i], score[i]


def _blocks(batches, same: bool, wanted: int):
    """Rows sorted by ``KEY``, in each key the block's rows before anchors."""
    key, held, block = None, [], None
    for b in batches:
        keys = list(zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in KEY)))
        kinds = b.column(b.schema.get_field_index("is_probe")).to_numpy(zero_copy_only=False)
        edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]), len(keys)]
        out = []
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            if keys[a] != key:
                key, held, block = keys[a], [], None
            if not kinds[a]:
                held.append(b.slice(a, z - a))
                continue
            if not held:
                continue
            if block is None:
                block = _Block(pa.Table.from_batches(held), key[0])
            for anchor in b.slice(a, z - a).select(["row_id", "label", "vector", "length", "windows"]).to_pylist():
                for slot, row, score in block.best(anchor, same, wanted):
                    out.append((anchor["row_id"], slot, score, block.vec_id[row], block.row_id[row]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _FOUND)], ["row_id", "slot", "score", "found_id", "found_row"])


_FOUND = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _search(rows: DataFrame, anchors: DataFrame, windows: DataFrame, same: bool, wanted: int) -> DataFrame:
    """``row_id, slot, rank, score, found_id``: the best ``wanted`` rows of each
    window (``row_id, slot, low, high``) of the anchors."""
    part = F.col("label") if same else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("part", part), anchors.withColumn("part", part)
    buckets = rows.groupBy("size", "part", "bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("subs"))
    buckets = buckets.groupBy("size", "part").agg(F.sort_array(F.collect_list(F.struct("bucket", "subs")), asc=False).alias("buckets"))  # 125 at most, as lengths end at 2**31
    chunks = anchors.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    groups = materialize(buckets.join(chunks, ["size", "part"]), "groups")
    own = F.get(F.filter("buckets", lambda b: b["bucket"] == F.col("bucket")), F.lit(0))["subs"]
    dealt = rows.join(groups, ["size", "part"]).withColumn("sub", F.pmod(F.xxhash64("row_id"), own).cast("int"))
    leads = lambda d: (F.col("bucket") == F.get("buckets", F.lit(0))["bucket"]) & (F.col("sub") == 0)
    dealt = dealt.withColumn("leads", leads(dealt)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def over(windows: DataFrame, leading: bool) -> DataFrame:
        all_windows = windows.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("windows"), F.min("low").alias("least"))
        asked = anchors.drop("bucket").join(all_windows, "row_id").join(groups, ["size", "part"])
        asked = asked.withColumn("chunk", F.pmod(F.xxhash64("row_id"), F.col("chunks")).cast("int")).withColumn("_b", F.explode("buckets")).withColumn("bucket", F.col("_b.bucket"))
        reach = F.col("length") * F.pow(F.lit(2.0), (F.col("bucket") + 1) / STEPS) * (1 + SLACK)
        asked = asked.filter((F.col("least") <= 0) | (F.col("bucket") >= 0) & (reach >= F.col("least")))
        asked = asked.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("_b.subs") - 1)))
        asked = asked.withColumn("leads", leads(asked))
        cols = [*KEY, "is_probe", "row_id", "vec_id", "label", "vector", "length", "windows"]
        both = dealt.withColumn("is_probe", F.lit(False)).withColumn("windows", F.lit(None).cast(all_windows.schema["windows"].dataType)).filter(F.col("leads") == leading).select(*cols)
        both = both.unionByName(asked.withColumn("is_probe", F.lit(True)).filter(F.col("leads") == leading).select(*cols))
        sorted_ = both.repartition(*KEY).sortWithinPartitions(*KEY, "is_probe", "row_id")
        return map_batches(sorted_, lambda batches: _blocks(batches, same, wanted), "row_id long, slot int, score long, found_id long, found_row long")

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("row_id", "slot").orderBy(F.desc("score"), "found_id", "found_row")
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= wanted)

    lead = materialize(over(windows, True), "leading")
    full = best(lead).filter(F.col("rank") == wanted).select("row_id", "slot", F.col("score").alias("last"))
    raised = windows.join(full, ["row_id", "slot"], "left").withColumn("low", F.greatest("low", F.coalesce("last", "low"))).drop("last")
    return best(lead.unionByName(over(raised, False))).select("row_id", "slot", "rank", "score", "found_id")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for ``rows`` of :func:`whole_vectors`: for each anchor and
    each of its ``positives`` best other rows of its label, the ``negatives``
    best rows of other labels whose score lies from ``low`` to ``high`` percent
    of the positive's."""
    anchors = rows.filter("is_anchor")
    rows = rows.drop("is_anchor")
    anchors = anchors.drop("is_anchor")
    whole = anchors.select("row_id", F.lit(0).alias("slot"), F.lit(NO_LOW).alias("low"), F.lit(NO_HIGH).alias("high"))
    found = materialize(_search(rows, anchors, whole, True, positives), "positives")
    share = lambda p: F.col("score").cast("decimal(20,0)") * F.lit(p).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)")
    near = found.select("row_id", F.col("rank").alias("slot"), F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high")).filter("low <= high")
    hard = _search(rows, anchors, near, False, negatives).withColumnsRenamed({"score": "negative_score", "found_id": "negative_id"})
    of = found.select("row_id", F.col("rank").alias("slot"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = hard.join(of, ["row_id", "slot"]).join(anchors.select("row_id", F.col("vec_id").alias("anchor_id")), "row_id")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
