"""Operator 2: near-duplicate embeddings by a random-projection tree forest.

Each of ``TREES`` trees splits the vectors at the median of a random
projection, again and again.  A vector near a border spills over into both
halves, so a linked pair is rarely parted in one tree and practically never in
all.  Within a leaf, vectors of equal label are compared by cosine in double
precision; the links of all trees are united.

Medians are fitted on a bounded sample (``SAMPLE`` distinct vectors chosen by
hash); every vector is routed.  The depth follows from the largest label so
that a leaf holds about ``LEAF`` of its vectors, however many there are: trees
of more than ``STAGE`` levels grow in stages, each of which fits the next levels
of every leaf so far on a sample of that leaf, in a task, and routes the leaf's
vectors by a join.  A leaf with more than ``BLOCK`` rows - a dense group that no
projection parts - is compared block against block in separate tasks, whole.

Equal vectors of a label are folded to one before.  A pair counts in the first
leaf that it shares (each vector carries its leaves of all trees, about 1.1 to
the power of the depth for each tree), so a leaf hands on a count for each
vector and a spanning star of its linked vectors, never its pairs.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite values, or has a null label or id, links with nothing and is its
own component; vectors of unequal length do not link; repeated rows are
further vectors; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import map_batches, materialize
from sluice.llm.graph import connected_components
from sluice.session import ship_package

COSINE = 0.98
TREES = 8
LEAF = 256
STAGE = 10
SAMPLE = 8192
BLOCK = 4096
#: Half the overlap at a border, in standard deviations of the projected
#: difference of two vectors that just link.
SPILL = 0.75
#: A place is the number of a tree, moved by this, and of a leaf.
TREE = 48


def _units(df: DataFrame) -> DataFrame:
    """``vec_id, label, key, unit``: a digest of the vector and the vector over
    its length; both null where it cannot link."""

    def run(batches):
        for b in batches:
            ids, labels, vectors = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
            keys, units = [], []
            for i in range(b.num_rows):
                v = vectors[i].values
                bad = ids[i] is None or labels[i] is None or v is None or not len(v) or v.null_count
                x = None if bad else v.to_numpy()
                size = 0.0 if bad or not np.isfinite(x).all() else float(np.linalg.norm(x / np.abs(x).max())) if x.any() else 0.0
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if size else None)
                units.append(x / np.abs(x).max() / size if size else None)
            cols = [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "key", "unit"])

    rows = df.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return map_batches(rows, run, "vec_id long, label string, key binary, unit array<double>")


def _directions(trees: int, nodes: int, size: int, stage: int) -> np.ndarray:
    """One direction a node and tree, unit length, the same in every task."""
    out = np.random.default_rng([trees, nodes, size, stage]).standard_normal((trees, nodes, size))
    return out / np.linalg.norm(out, axis=2, keepdims=True)


class Splits:
    """Some levels of all trees, in heap order: node i has the halves 2i+1 and
    2i+2."""

    def __init__(self, levels: int, trees: int, cosine: float, stage: int = 0):
        self.levels, self.trees, self.stage = levels, trees, stage
        self.nodes = (1 << levels) - 1
        self.reach = math.sqrt(2 - 2 * cosine)

    def _spill(self, size: int) -> float:
        return SPILL * self.reach / math.sqrt(size)

    def directions(self, size: int) -> np.ndarray:
        return _directions(self.trees, self.nodes, size, self.stage)

    def medians(self, units: np.ndarray, directions: np.ndarray) -> np.ndarray:
        """The median at each node of one tree."""
        spill, out, inside = self._spill(units.shape[1]), np.zeros(self.nodes), {0: units}
        for node in range(self.nodes):
            x = inside.pop(node)
            p = x @ directions[node]
            out[node] = m = np.median(p) if len(p) else 0.0
            if 2 * node + 2 < self.nodes:
                inside[2 * node + 1], inside[2 * node + 2] = x[p <= m + spill], x[p >= m - spill]
        return out

    def leaves(self, units: np.ndarray, directions: np.ndarray, medians: np.ndarray) -> np.ndarray:
        """(rows, leaves) of booleans for one tree; ``medians`` of the tree or of
        each row."""
        spill = self._spill(units.shape[1])
        p = units @ directions.T - medians
        there = np.zeros((len(units), 2 * self.nodes + 1), bool)
        there[:, 0] = True
        for node in range(self.nodes):
            there[:, 2 * node + 1] = there[:, node] & (p[:, node] <= spill)
            there[:, 2 * node + 2] = there[:, node] & (p[:, node] >= -spill)
        return there[:, self.nodes :]


def _placed(classes: DataFrame, splits: Splits, medians: np.ndarray) -> DataFrame:
    """``class_id, label, size, places`` (ascending) after the first stage."""

    def run(batches):
        for b in batches:
            unit, size = b.column(2), np.diff(b.column(2).offsets.to_numpy())
            for d in np.unique(size):
                directions = splits.directions(d)
                rows = np.flatnonzero(size == d)
                for at in range(0, len(rows), 1024):
                    some = pa.array(rows[at : at + 1024])
                    x = unit.take(some).flatten().to_numpy().reshape(-1, d)
                    there = np.stack([splits.leaves(x, directions[t], medians[t]) for t in range(splits.trees)], axis=1)
                    row, tree, leaf = np.nonzero(there)
                    offsets = np.searchsorted(row, np.arange(len(x) + 1))
                    places = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tree << TREE | leaf, pa.int64()))
                    cols = [b.column(0).take(some), b.column(1).take(some), pa.array(np.full(len(x), d), pa.int32()), places]
                    yield pa.RecordBatch.from_arrays(cols, ["class_id", "label", "size", "places"])

    return map_batches(classes.select("class_id", "label", "unit"), run, "class_id long, label string, size int, places array<long>")


def _deeper(placed: DataFrame, classes: DataFrame, splits: Splits, sample: int) -> DataFrame:
    """``placed`` one stage further down: each leaf fits its own medians on
    about ``sample`` of its vectors, and all its vectors go on by them."""

    def fit(key, table):
        place, d = (k.as_py() for k in key)
        units = table["unit"].combine_chunks().flatten().to_numpy().reshape(-1, d)
        found = splits.medians(units, splits.directions(d)[place >> TREE])
        return pa.table({"place": pa.array([place], pa.int64()), "size": pa.array([d], pa.int32()), "medians": pa.array([found], pa.list_(pa.float64()))})

    def route(batches):
        for b in batches:
            places, sizes = b.column(3).to_numpy(), b.column(2).to_numpy()
            kinds = np.stack([sizes, places >> TREE], axis=1)
            for d, tree in np.unique(kinds, axis=0):
                rows, directions = np.flatnonzero((kinds == (d, tree)).all(axis=1)), splits.directions(int(d))[tree]
                for at in range(0, len(rows), 1024):
                    some = pa.array(rows[at : at + 1024])
                    x = b.column(4).take(some).flatten().to_numpy().reshape(-1, d)
                    medians = b.column(5).take(some).flatten().to_numpy().reshape(len(x), -1)
                    row, leaf = np.nonzero(splits.leaves(x, directions, medians))
                    below = (places[rows[at : at + 1024]][row] & ((1 << TREE) - 1)) << splits.levels | leaf
                    to = pa.array(row)
                    cols = [b.column(c).take(some).take(to) for c in range(3)] + [pa.array(tree << TREE | below, pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, ["class_id", "label", "size", "place"])

    ship_package(placed.sparkSession)
    each = placed.select("class_id", "label", "size", F.explode("places").alias("place"))
    units = classes.select("class_id", "unit")
    counts = each.groupBy("place", "size").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), sample / F.col("n")) * (1 << 30)
    chosen = each.join(counts, ["place", "size"]).filter(F.pmod(F.xxhash64("class_id", "place"), F.lit(1 << 30)) < share)
    fitted = chosen.join(units, "class_id").select("place", "size", "unit").groupBy("place", "size").applyInArrow(fit, "place long, size int, medians array<double>")
    fitted = materialize(fitted, "medians")
    # a leaf whose sample is empty parts its vectors at zero
    known = each.join(fitted, ["place", "size"], "left").join(units, "class_id")
    known = known.select("class_id", "label", "size", "place", "unit", F.coalesce("medians", F.array_repeat(F.lit(0.0), splits.nodes)).alias("medians"))
    gone_on = map_batches(known, route, "class_id long, label string, size int, place long")
    return gone_on.groupBy("class_id", "label", "size").agg(F.sort_array(F.collect_list("place")).alias("places"))


def _components(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest row linked to each row, by pairs p, q and what ``root``
    says of earlier pairs."""
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _earlier(places: pa.ListArray, place: int) -> np.ndarray:
    """The places before ``place`` that two rows or more have, a bit each: words
    of 64 places, each word for all rows."""
    row = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
    of = places.flatten().to_numpy()
    row, of = row[of < place], of[of < place]
    _, bit, rows = np.unique(of, return_inverse=True, return_counts=True)
    shared = rows > 1
    row, bit = row[shared[bit]], (np.cumsum(shared) - 1)[bit[shared[bit]]]
    out = np.zeros((shared.sum() // 64 + 1, len(places)), np.uint64)
    np.bitwise_or.at(out, (bit >> 6, row), np.uint64(1) << (bit & 63).astype(np.uint64))
    return out


def _compare(ids, copies, units, places, side, place: int, within: bool, cosine: float):
    """Counts of new links for each row and a star for each set they link.
    ``side``: the rows' block, False the first.  A link is new if the two rows
    share no earlier leaf, of an earlier tree or, as both may have spilled over,
    of this one."""
    first, second = (np.arange(len(ids)),) * 2 if within else (np.flatnonzero(~side), np.flatnonzero(side))
    n_links, root, earlier = np.zeros(len(ids), np.int64), np.arange(len(ids)), None
    for at in range(0, len(first), 256):
        rows = first[at : at + 256]
        p, q = np.nonzero(units[rows] @ units[second].T >= cosine)
        p, q = rows[p], second[q]
        if within:
            p, q = p[p < q], q[p < q]
        if not len(p):
            continue
        earlier = _earlier(places, place) if earlier is None else earlier
        for word in earlier:
            new = (word[p] & word[q]) == 0
            p, q = p[new], q[new]
        np.add.at(n_links, p, copies[q])
        np.add.at(n_links, q, copies[p])
        # united chunk by chunk: pairs are never held
        root = _components(root, p, q) if len(p) else root
    linked = np.flatnonzero(n_links)
    return (ids[linked], n_links[linked], ids[root[linked]]) if len(linked) else None


def _leaf_links(batches, cosine: float):
    """Rows sorted by group: label, size, place and the two blocks compared."""
    names = ["label", "size", "place", "low", "high"]
    held: list[pa.RecordBatch] = []

    def flush():
        t = pa.Table.from_batches(held)
        d = t["size"][0].as_py()
        units = t["unit"].combine_chunks().flatten().to_numpy().reshape(-1, d)
        places = t["places"].combine_chunks()
        low, high = t["low"][0].as_py(), t["high"][0].as_py()
        found = _compare(t["class_id"].to_numpy(), t["copies"].to_numpy(), units, places, t["block"].to_numpy() == high, t["place"][0].as_py(), low == high, cosine)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["class_id", "n_links", "root"])

    for b in batches:
        keys = [b.column(b.schema.get_field_index(n)).to_pylist() for n in names]
        keys = list(zip(*keys))
        edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            if held and tuple(held[0].column(held[0].schema.get_field_index(n))[0].as_py() for n in names) != keys[a]:
                yield from flush()
                held = []
            held.append(b.slice(a, z - a))
    if held:
        yield from flush()


def near_duplicates(df: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK, sample: int = SAMPLE, stage: int = STAGE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``
    (``vec_id``, ``embedding``, ``label``)."""
    rows = materialize(_units(df), "units")
    able = rows.filter(F.col("key").isNotNull())
    classes = able.groupBy("label", "key").agg(F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies"), F.any_value("unit").alias("unit"))
    classes = materialize(classes, "vector-classes")
    most, total = classes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    depth = max(0, math.ceil(math.log2(max(1, most or 1) / leaf)))
    trees, stages = trees if depth else 1, max(1, math.ceil(depth / stage))
    levels = [depth * (i + 1) // stages - depth * i // stages for i in range(stages)]
    splits = [Splits(n, trees, cosine, i) for i, n in enumerate(levels)]
    medians = np.zeros((trees, splits[0].nodes))
    if depth:
        size = classes.groupBy(F.size("unit").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
        share = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * min(1, sample / total))
        chosen = classes.filter(share & (F.size("unit") == size)).select("class_id", "unit").orderBy("class_id").toPandas()  # about `sample` rows at most
        if len(chosen):
            units = np.stack(chosen["unit"].to_list())
            medians = np.stack([splits[0].medians(units, directions) for directions in splits[0].directions(size)])
    placed = materialize(_placed(classes, splits[0], medians), "leaves")
    for further in splits[1:]:
        placed = materialize(_deeper(placed, classes, further, sample), "leaves")
    each = placed.select("class_id", "label", "size", F.explode("places").alias("place"))
    group = ["label", "size", "place"]
    blocks = each.groupBy(*group).count().withColumn("n_blocks", F.ceil(F.col("count") / block).cast("int")).filter("count > 1").drop("count")
    split = each.join(blocks, group).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("n_blocks")).cast("int"))
    # Every pair of blocks is one comparison, and so is each block with itself.
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    split = split.select("class_id", *group, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    whole = split.join(classes.select("class_id", "copies", "unit"), "class_id").join(placed.select("class_id", "places"), "class_id")
    order = [*group, "low", "high"]
    dealt = whole.repartition(*order).sortWithinPartitions(*order, "class_id")
    found = materialize(map_batches(dealt, lambda batches: _leaf_links(batches, cosine), "class_id long, n_links long, root long"), "leaf-links")
    parts = connected_components(found.filter("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("class_id").agg(F.sum("n_links").alias("n"))
    named = classes.join(counts, "class_id", "left").join(parts, classes["class_id"] == parts["node"], "left")
    named = named.select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    result = rows.select("vec_id", "label", "key").join(named, ["label", "key"], "left")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
