"""Operator 13 against rebuilt texts in plain Python."""

import hashlib
import random
import zlib

import pytest

from sluice.llm import prefix_trie as P
from sluice.operators import rolling

SCHEMA = "conv_id long, turn long, role string, text string"


def trie(rows):
    stored = {}
    for c, turn, role, text in rows:
        if c is not None:
            stored.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    stored = {c: [t[2:] for t in sorted(ts)] for c, ts in stored.items()}
    members = {}
    for c, own in stored.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c - (abs(c) % 5) * (1 if c >= 0 else -1))
        rebuilt = tuple(stored.get(base, [])[:h] + own[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append((c, len(rebuilt)))
    out = []
    for node, who in members.items():
        under = [n for n in members if n[: len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(c for c, n in who if n == len(node)))
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n)
        leaves = sum(not any(m[:-1] == n for m in under if m) for n in under)
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(c for c, _ in who), len(node), parent, len(who), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as pos", "'x' as depth", "2 as tie", "3 as d0", "4 as size")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r[c] for c in cols) for r in P.nodes(df).collect())


def conversations(seed, n, kinds=3, most=12):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.randint(1, most)):
            rows.append((c, turn, ("user", "assistant")[turn % 2], f"tüx{rnd.randrange(kinds)}"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,kinds", [(1, 2), (2, 30)])
def test_nodes(spark, seed, kinds):
    rows = conversations(seed, 70, kinds)
    assert got(spark, rows) == trie(rows)


def test_odd_rows(spark):
    rows = conversations(3, 30, 2)
    rows += [(None, 0, "user", "nobody"), (1001, None, None, None), (1001, None, None, None), (1002, 3, "user", "no base"), (-7, 0, "user", "tüx0"), (-5, 0, "user", "tüx0"), (-5, 1, "assistant", "tüx1")]
    rows += [(2000, t, "user", x) for t in (None, 1, 1, 1, 2) for x in ("b", "a", "", None)]  # ties, nulls and repeats
    rows += [(2001, 1, r, "same") for r in ("user", "assistant", None)] + [(2005, 0, "user", "long " * 60_000)] * 2
    rows += [(3000 + i, t, "user", f"copy {t}") for i in range(40) for t in range(10)]
    assert got(spark, rows) == trie(rows)


def test_long_paths_are_cut(spark, monkeypatch):
    monkeypatch.setattr(rolling, "ROWS_PER_BLOCK", 20)
    for f in (rolling.running_aggregate, rolling.with_blocks):
        monkeypatch.setattr(f, "__defaults__", tuple(20 if x == 1 << 18 else x for x in f.__defaults__))
    monkeypatch.setattr(P, "IDS", 3)
    rnd = random.Random(5)
    rows = [(0, t, "user", "x" * (t % 3)) for t in range(200)] + [(c, t, "user", "x" * (t % 3) if t < 20 * c else f"{rnd.randrange(3)}") for c in range(1, 25) for t in range(20 * (c % 7) + 9)]
    rows += [(100 + i, None, "user", rnd.choice("abc")) for i in range(40) for _ in range(3)] + [(500, None, "user", f"{i}") for i in range(60)]
    assert got(spark, rows) == trie(rows)


def test_other_constants_after_a_collision(spark, monkeypatch):
    """With one small prime the fingerprints collide, are found out, and the
    next constants are tried; with none that work there is an error."""
    rows = conversations(6, 40, 30)
    monkeypatch.setattr(P, "TRIALS", 2)
    real = P.rebuilt_prefixes

    def once(products, trial=0):
        d = real(products, trial)
        return d if trial else d.withColumns({"f0": d.f0 % 7, "f1": d.f1 % 1})

    monkeypatch.setattr(P, "rebuilt_prefixes", once)
    assert got(spark, rows) == trie(rows)
    monkeypatch.setattr(P, "TRIALS", 1)
    with pytest.raises(RuntimeError):
        got(spark, rows)


def test_empty(spark):
    assert got(spark, []) == [] and got(spark, [(None, 1, "user", "x")]) == []
