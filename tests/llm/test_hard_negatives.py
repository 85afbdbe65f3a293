"""Operator 11 against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def mined(rows, scale=256, low=80, high=100):
    able = []
    for i, (vec_id, x, label) in enumerate(rows):
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(scale * c) for c in x]
        if sum(c * c for c in v) < 2**62:
            able.append((i, vec_id, label, v))
    out = []
    for i, anchor, label, v in able:
        if anchor % 100:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), vec, j, of) for j, vec, of, w in able if j != i and len(w) == len(v))
        for p, positive, _, _ in [f for f in found if f[3] == label][:5]:
            near = [f for f in found if f[3] != label and low * -p <= 100 * -f[0] <= high * -p]
            out += [(anchor, positive, rank + 1, vec, -p, -n) for rank, (n, vec, _, _) in enumerate(near[:5])]
    return sorted(out)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as row_id", "2 as bucket", "'x' as part", "3 as vector")
    found = H.mine(H.whole_vectors(df, F.col("vec_id") % 100 == 0, **kw)).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found)


def vectors(seed, n, size, labels=4):
    """Vectors around a few directions, of lengths that differ by orders."""
    rnd = np.random.default_rng(seed)
    middles = rnd.standard_normal((6, size))
    out = []
    for i in range(n):
        x = middles[i % 6] + 0.5 * rnd.standard_normal(size)
        x *= 2.0 ** rnd.integers(-6, 4) / np.linalg.norm(x)
        out.append((int(i * 20), [float(c) for c in x], int(rnd.integers(labels))))
    return out


@pytest.mark.parametrize("block,chunk", [(4096, 2048), (16, 3)])
def test_all_pairs(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "CHUNK", chunk)
    rows = vectors(1, 260, 8)
    want = mined(rows)
    assert got(spark, rows) == want and len(want) > 300


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 8)
    rows = vectors(2, 60, 3, labels=2)
    rows += [(None, [1.0, 1.0, 1.0], 1), (100, None, 1), (100, [1.0, None, 0.0], 1), (200, [float("nan"), 0.0, 0.0], 1), (300, [1.0, 0.0, float("inf")], 0), (400, [1.0, 2.0, 3.0], None)]
    rows += [(500, [0.0, 0.0, 0.0], 1), (700, [], 0), (701, [], 0), (702, [], 1), (800, [1.0], 0), (801, [0.5], 0), (802, [0.5], 1), (-100, [3.0, 1.0, 1.0], 0)]
    rows += [(900, [1.0, 2.0, 2.0], 1)] * 3 + [(901, [1.0, 2.0, 2.0], 0)] * 7  # repeated rows, ties
    rows += [(1000, [1e300, 0.0, 0.0], 0), (1001, [2.0**22, 0.0, 0.0], 0), (1100, [2.0**22, 1.0, 2.0], 1), (1200, [-1.0, -1.0, 2.0], 0)]
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == mined(rows)


def test_one_vector_in_most_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    rows = [(i, [0.6, 0.8], i % 3) for i in range(300)] + [(i, [0.8, 0.6 * (i % 5) / 4], i % 2) for i in range(300, 340)]
    assert got(spark, rows) == mined(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(7, [1.0], 1), (8, [1.0], 2)]) == []


def test_candidates_hold_all_that_reach_the_threshold():
    rnd = np.random.default_rng(4)
    near = rnd.standard_normal((20, 16))[np.arange(500) % 20] + 0.2 * rnd.standard_normal((500, 16))
    whole = np.floor(256 * near / np.linalg.norm(near, axis=1)[:, None]).astype(np.int64)  # lengths as in a bucket
    n = np.arange(500)
    rows = pa.table({"row_id": n, "vec_id": n, "label": n % 3, "vector": pa.array(whole.tolist(), pa.list_(pa.int32())), "length": np.sqrt((whole.astype(float) ** 2).sum(axis=1))})
    block = H._Block(rows, 16)
    kept = 0
    for a in whole[:100]:
        scores, length = whole @ a, math.sqrt(float(a @ a))
        low = int(np.sort(scores)[-5])
        found = block.candidates(a / length, length, low)
        assert low <= 0 or set(np.flatnonzero(scores >= low)) <= set(found)
        kept += len(found) if found is not None else 500
    assert kept < 0.5 * 100 * 500  # the ranges do prune
