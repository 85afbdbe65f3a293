"""Operator 2 at its own settings and with trees of several stages: planted
pairs just above the bound, and a dense group beyond one block."""

import numpy as np
import pytest

from sluice.llm import embeddings

SCHEMA = "vec_id long, embedding array<double>, label int"


def turned(rnd, x, cosine):
    """A vector at the given cosine to ``x``."""
    y = rnd.standard_normal(len(x))
    y -= y @ x * x
    return cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


@pytest.mark.parametrize("settings", [{}, {"leaf": 16, "stage": 3, "sample": 512}], ids=["own", "three stages"])
def test_recall_of_pairs_near_the_bound(spark, settings):
    rnd = np.random.default_rng(5)
    rows, pairs = [], {}
    for i in range(3000):
        x = rnd.standard_normal(64)
        x /= np.linalg.norm(x)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, turned(rnd, x, rnd.uniform(0.9801, 0.983)).tolist(), 0)]
        pairs[2 * i + 1] = 2 * i
    got = {r["vec_id"]: r["component_id"] for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), **settings).collect()}
    found = sum(got[a] == b for a, b in pairs.items())
    assert found >= 0.999 * len(pairs), found
    assert sum(k != v for k, v in got.items()) == found  # nothing else is linked


def test_a_dense_group_beyond_one_block(spark):
    rnd = np.random.default_rng(6)
    x = rnd.standard_normal(16)
    x /= np.linalg.norm(x)
    n = embeddings.BLOCK + 500
    rows = [(i, (x + 0.004 * rnd.standard_normal(16)).tolist(), 1) for i in range(n)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r["component_id"] for r in got} == {0} and {r["n_links"] for r in got} == {n - 1}


def test_leaves_of_a_deep_tree_stay_small(spark, monkeypatch):
    """Every further level about halves the leaves, whatever the stage."""
    rnd = np.random.default_rng(7)
    rows = [(i, rnd.standard_normal(64).tolist(), 0) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seen = {}
    keep = embeddings.materialize

    def noted(d, name):
        out = keep(d, name)
        seen[name] = out
        return out

    monkeypatch.setattr(embeddings, "materialize", noted)
    embeddings.near_duplicates(df, leaf=16, stage=3, sample=512).count()
    sizes = [r["count"] for r in seen["leaves"].selectExpr("explode(places) place").groupBy("place").count().collect()]
    assert len(sizes) >= 0.9 * embeddings.TREES * 256 and np.median(sizes) < 16 * 4, (len(sizes), np.median(sizes))
